"""Nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

Vectors are brought to the unit sphere so that a larger inner product is a smaller distance: x becomes
(x, sqrt(M^2 - |x|^2)) / M with the largest norm M of all rows, a query q becomes (q, 0) / |q|. Each of TABLES
tables cuts HASHES Gaussian projections into steps of WIDTH; a cell is a table's step numbers. A query visits its
own cell and perturbed ones (steps up or down by one) in the order of their estimated success, which is the same
list of ranks for every query. The candidates of all tables are merged and ranked by inner products in double
precision on the given vectors.

The number of probes is found on a bounded sample of at most SAMPLE vectors: as many as find TARGET of the
neighbours there that stand for the wanted ones (the top `k` of all rows are the top k * sample / rows of the
sample). The sample's own best also bound what a task has to return, but are no results: all rows are indexed, and
only what a visited cell holds is found. Exact scans of all rows stand in for the cells where these cannot do: for
all queries if not even PROBES find TARGET on the sample, and for queries with fewer than k found over the bound.

Cells are dealt to shards; a cell with more rows than a shard should have (there are at most as many as shards) is
spread over all shards, and its probes with it. A task returns at most k rows a query.

Defined results: vectors that are null, zero, or hold a null or non-finite component, and vectors of another
length than most, take no part; rows without vec_id are left out; rows that repeat a vec_id count as one, the
one of the largest vector; ties go to the smaller vec_id; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W

TABLES, HASHES, WIDTH = 8, 12, 2.5
SAMPLE, TARGET, PROBES = 2000, 0.95, 4096
#: scores of different matrix products differ by less, relative to the norms
SLACK = 1e-9
SHARD_ROWS = 16_384
_FOUND = "query_id long, vec_id long, score double"


def perturbations(hashes: int, n: int) -> list[tuple[int, ...]]:
    """The n likeliest sets of perturbations, as ranks of the 2 * hashes border distances in increasing order.

    The expected squared distance of each rank is known for uniform offsets; sets are visited by their sum, and
    those that would move one hash both ways are left out.
    """
    m = hashes
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost += [1 - j / (m + 1) + j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(m, 0, -1)]
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < n:
        total, ranks = heapq.heappop(heap)
        if not any(2 * m - 1 - r in ranks for r in ranks):
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    return out


class Hashing:
    """The tables' projections and cell numbers for vectors of one length and norm bound."""

    def __init__(self, length: int, bound: float) -> None:
        random = np.random.default_rng(20)
        self.bound = bound
        self.lines = random.standard_normal((TABLES, length + 1, HASHES))
        self.shift = random.random((TABLES, 1, HASHES)) * WIDTH
        self.name = W.mix(np.arange(1, TABLES * HASHES + 1, dtype=np.uint64)).reshape(TABLES, HASHES) | np.uint64(1)

    def _steps(self, x: np.ndarray) -> np.ndarray:
        return (np.einsum("nd,tdh->tnh", x, self.lines) + self.shift) / WIDTH

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Tables by rows: the cell of each indexed vector."""
        norm = (x * x).sum(axis=1)
        more = np.sqrt(np.maximum(self.bound**2 - norm, 0))
        return self._cell(np.floor(self._steps(np.column_stack([x, more]) / self.bound)))

    def _cell(self, steps: np.ndarray) -> np.ndarray:
        return (steps.astype(np.int64).view(np.uint64) * self.name[:, None, :]).sum(axis=2)

    def probes(self, q: np.ndarray, sets: list[tuple[int, ...]]) -> np.ndarray:
        """Tables by rows by sets: the cells that each query visits, in order."""
        unit = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
        steps = self._steps(np.column_stack([unit, np.zeros(len(q))]))
        low = np.floor(steps)
        home, part = self._cell(low), steps - low
        order = np.argsort(np.concatenate([part, 1 - part], axis=2), axis=2)
        move = np.concatenate([-self.name, self.name], axis=1)  # uint64: wraps
        moves = np.stack([move[t][order[t]] for t in range(TABLES)])
        out = np.repeat(home[:, :, None], len(sets), axis=2)
        for i, ranks in enumerate(sets):
            for r in ranks:
                out[:, :, i] += moves[:, :, r]
        return out


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def _wanted_probes(hashing: Hashing, x: np.ndarray, k: int, rows: int) -> int | None:
    """Probes a table with which TARGET of the sample's neighbours are found; None if PROBES do not find them."""
    near = max(1, min(len(x) - 1, round(k * len(x) / max(rows, 1))))
    some = np.arange(min(len(x), 300))
    score = x[some] @ x.T
    score[some, some] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :near]
    cells = hashing.cells(x)
    sets = perturbations(HASHES, PROBES)
    visited = hashing.probes(x[some], sets)
    first = np.full(best.shape, len(sets))  # the first set that visits the neighbour in some table
    for t in range(TABLES):
        for j in range(near):
            hit = visited[t] == cells[t][best[:, j]][:, None]
            first[:, j] = np.minimum(first[:, j], np.where(hit.any(axis=1), hit.argmax(axis=1), len(sets)))
    needed = np.sort(first.ravel())
    last = int(needed[math.ceil(TARGET * len(needed)) - 1])
    return last + 1 if last < len(sets) else None


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def _index_rows(hashing: Hashing):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = hashing.cells(_vectors(batch.column("x"))) if len(batch) else np.zeros((TABLES, 0), np.uint64)
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[t].view(np.int64)), batch.column("vec_id"), batch.column("x")],
                    ["cell", "vec_id", "x"])
    return rows


def _probe_rows(hashing: Hashing, sets: list[tuple[int, ...]], shards: int, hot: np.ndarray):
    """A row for each query and shard, with the cells to visit there and the score that a candidate must have."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                q = _vectors(batch.column("x"))
                enough = batch.column("enough").to_numpy()
                cells = hashing.probes(q, sets).transpose(1, 0, 2).reshape(len(q), -1).view(np.int64)
                row, shard, cell = [], [], []
                spread = np.isin(cells, hot)
                for i in range(len(q)):
                    own = np.unique(cells[i][~spread[i]])
                    every = np.unique(cells[i][spread[i]])
                    place = np.mod(own, shards)
                    order = np.argsort(place, kind="stable")
                    parts = np.split(own[order], np.searchsorted(place[order], np.arange(1, shards)))
                    for s, part in enumerate(parts):
                        if len(part) or len(every):
                            row.append(i)
                            shard.append(s)
                            cell.append(np.concatenate([part, every]))
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), batch.column("vec_id").take(take), batch.column("x").take(take),
                     pa.array(enough[row] if row else [], pa.float64()), pa.array(cell, pa.list_(pa.int64()))],
                    ["shard", "query_id", "x", "enough", "cells"])
    return rows


def _shard_rows(k: int):
    def rows(index: pa.Table, probes: pa.Table) -> pa.Table:
        found_q, found_v, found_s = [], [], []
        if len(index) and len(probes):
            index, probes = index.combine_chunks(), probes.combine_chunks()
            cell, vec = index.column("cell").to_numpy(), index.column("vec_id").to_numpy()
            x = _vectors(index.column("x").combine_chunks())
            order = np.argsort(cell, kind="stable")
            cell, vec, x = cell[order], vec[order], x[order]
            q, qid = _vectors(probes.column("x").combine_chunks()), probes.column("query_id").to_numpy()
            enough = probes.column("enough").to_numpy()
            lists = probes.column("cells").combine_chunks()
            want = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            order = np.argsort(want, kind="stable")
            want, owner = want[order], owner[order]
            names, first, size = np.unique(cell, return_index=True, return_counts=True)
            low, high = np.searchsorted(want, names), np.searchsorted(want, names, side="right")
            for a, n, lo, hi in zip(first, size, low, high):
                for part in range(lo, hi, 1024):
                    who = owner[part:min(part + 1024, hi)]
                    v, w = np.nonzero(x[a:a + n] @ q[who].T >= enough[who][None, :])
                    keep = vec[a + v] != qid[who[w]]
                    v, w = a + v[keep], who[w[keep]]
                    found_q.append(w)
                    found_v.append(vec[v])
                    # pair by pair, so that a pair has one score in every cell and task
                    found_s.extend(np.einsum("nd,nd->n", x[v[i:i + 65_536]], q[w[i:i + 65_536]])
                                   for i in range(0, len(v), 65_536))
        return _best(np.concatenate(found_q) if found_q else np.zeros(0, np.int64),
                     np.concatenate(found_v) if found_v else np.zeros(0, np.int64),
                     np.concatenate(found_s) if found_s else np.zeros(0), k,
                     qid if found_q else np.zeros(0, np.int64))
    return rows


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int, name: np.ndarray) -> pa.Table:
    """Of found (query, vector, score): each once, the k best of a query."""
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    fresh = np.ones(len(q), bool)  # a vector found in several tables has one score
    fresh[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])
    q, v, s = q[fresh], v[fresh], s[fresh]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    q, v, s = q[rank < k], v[rank < k], s[rank < k]
    return pa.table({"query_id": pa.array(name[q] if len(q) else [], pa.int64()),
                     "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})


def _bound_rows(sample: np.ndarray, ids: np.ndarray, k: int, bound: float):
    """Each query with the score of the sample's k-th best, which the k best of all rows reach."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                own, q = batch.column("vec_id").to_numpy(), _vectors(batch.column("x"))
                score = np.where(own[:, None] != ids[None, :], q @ sample.T, -np.inf)
                least = np.full(len(q), -np.inf)
                if k <= len(ids):
                    least = -np.partition(-score, k - 1, axis=1)[:, k - 1]
                least = least - SLACK * bound * np.sqrt((q * q).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("x"), pa.array(least)], ["vec_id", "x", "least"])
    return rows


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x as array<double>, norm) of the vectors that take part, each vec_id once."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(
        "vec_id is not null and x is not null and size(x) > 0").where(
        ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).where("norm > 0")
    return rows.groupBy("vec_id").agg(F.max(F.struct("norm", "x")).alias("one")).select("vec_id", "one.x", "one.norm")


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Of the rows whose vec_id is divisible by `every`: query_id, rank, vec_id, score of the k nearest found."""
    rows = shared.landed(usable(vectors), "vectors")
    spark = rows.sparkSession
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("bound"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("x") == common.length).select("vec_id", "x")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    x, ids = np.stack(sample["x"]).astype(np.float64), sample["vec_id"].to_numpy(np.int64)
    hashing = Hashing(common.length, common.bound)
    probes = _wanted_probes(hashing, x, k, common.n) if len(x) > 1 else 1
    sets = perturbations(HASHES, probes) if probes else []
    shards = max(1, math.ceil(common.n * TABLES / SHARD_ROWS))
    index = rows.mapInArrow(_index_rows(hashing), "cell long, vec_id long, x array<double>")
    # a shard's share of all rows is reached by at most as many cells as there are shards
    hot = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_ROWS // 2)
    hot = np.array([r.cell for r in hot.limit(2 * shards).collect()], np.int64)
    shard = F.pmod(F.col("cell"), F.lit(shards))
    if len(hot):
        marks = spark.createDataFrame([(int(c),) for c in hot], "cell long").withColumn("spread", F.lit(True))
        index = index.join(F.broadcast(marks), "cell", "left")
        shard = F.when(F.col("spread"), F.pmod(F.xxhash64("vec_id"), F.lit(shards))).otherwise(shard)
    index = index.select(shard.alias("shard"), "cell", "vec_id", "x")
    queries = shared.landed(
        rows.where(F.col("vec_id") % every == 0).mapInArrow(
            _bound_rows(x, ids, k, common.bound), "vec_id long, x array<double>, least double"), "neighbour-queries")
    best = spark.createDataFrame([], _FOUND)

    def bounded() -> DataFrame:
        """The queries, the score that a candidate must have, and the neighbours found so far."""
        own = best.groupBy("query_id").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("n"))
        enough = F.when(F.col("n") >= k, F.greatest("last", "least")).otherwise(F.col("least"))
        return queries.join(own, queries.vec_id == own.query_id, "left").select(
            "vec_id", "x", enough.alias("enough"), F.coalesce("n", F.lit(0)).alias("n"))

    def merged(index: DataFrame, visits: DataFrame) -> DataFrame:
        """The k best with what is found in the cells to visit; only what reaches the k best so far leaves a task."""
        found = index.groupBy("shard").cogroup(visits.groupBy("shard")).applyInArrow(_shard_rows(k), _FOUND)
        return shared.landed(_ranked(found.unionByName(best.select("query_id", "vec_id", "score")), k), "neighbours")

    # the likeliest cells first: what they hold bounds what the many other cells have to return
    near = max(1, len(sets) // 16)
    for some in (sets[:near], sets[near:]):
        if some:
            best = merged(index, bounded().select("vec_id", "x", "enough").mapInArrow(
                _probe_rows(hashing, some, shards, hot),
                "shard long, query_id long, x array<double>, enough double, cells array<long>"))
    short = shared.landed(bounded().where(F.col("n") < min(k, common.n - 1)), "short-queries")
    if not short.isEmpty():
        whole = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
                            F.lit(0).cast("long").alias("cell"), "vec_id", "x")
        best = merged(whole, short.select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
            F.col("vec_id").alias("query_id"), "x", "enough", F.array(F.lit(0).cast("long")).alias("cells")))
    return _ranked(best, k).select("query_id", "rank", "vec_id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, each vector once, ties to the smaller vec_id."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", order).where(F.col("rank") <= k)
