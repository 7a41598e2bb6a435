"""Near-duplicate documents by MinHash: sets of word 2-shingles with a Jaccard similarity of 0.8 or more.

Sketches are made by fast similarity sketching: in round i every element is thrown into one of `T` bins, by a hash
of its own for the round, with the value i + u, u uniform; each bin keeps its least value. After T rounds the bin
of round T + j is j, so every coordinate is filled; a set stops as soon as all its bins are, and its coordinates
agree with another's with the probability of their similarity and with the concentration of T samples without
replacement. `BANDS` bands of `ROWS` coordinates put sets into buckets; a pair at the threshold shares none with
probability (1 - 0.8 ** ROWS) ** BANDS, 3e-6.

Equal sets collapse first: one stands for all. Then each bucket's members are verified against its smallest
(a star, linear in the bucket). What a bucket still has in different components is compared in cells of two
blocks of at most `BLOCK` members, of different components only: sketches first, then sets of those that sketches
cannot rule out. Cells pass on a spanning forest of their links, never pairs. Every link is confirmed on full sets.

Defined results: A-Z count as a-z; a text of one word has one shingle; null and empty texts have none, stay alone
and are kept; repeated rows are one group, each row returned; rows without doc_id are left out; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W
from routeledger.llm.components import components
from routeledger.llm.jaccard_join import _lists, _overlaps, _unite, _whole_cells, gram_sets

SHINGLE = 2
PERCENT = 80
BANDS, ROWS = 32, 5
T = BANDS * ROWS
#: fewest agreeing coordinates of a likely pair: 0.8 less five standard deviations
LIKELY = int(T * 0.8 - 5 * (T * 0.16) ** 0.5)
BLOCK = 512
#: from so many members in a bucket on, a component has blocks of its own
LARGE = 128
#: sets sketched at once, and elements of them handled at once
_SETS, _ELEMENTS = 2048, 1 << 19

_ROUND = W.mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
_NODE = "node struct<doc_id:long,ver:int>"
_CELL = ["path", "low", "high"]
_IN_CELL = ["node", "band", "own", "root_at", *_CELL]
_CELL_ROWS = f"{_NODE}, band int, own long, root_at long, path long, low long, high long"
_LINK = f"{_NODE}, root struct<doc_id:long,ver:int>"


def sketches(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sketch of each set (elements at[i] to at[i + 1], none empty): T values of 16 bits."""
    n = len(at) - 1
    out = np.zeros((n, T), np.uint16)
    a = 0
    while a < n:
        b = min(a + _SETS, max(a + 1, int(np.searchsorted(at, at[a] + _ELEMENTS, "right")) - 1), n)
        out[a:b] = _sketch(grams[at[a]:at[b]], np.diff(at[a:b + 1]))
        a = b
    return out


def _sketch(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    # the round stands in the upper bits, so that an earlier round is always less
    best = np.full(len(sizes) * T, np.iinfo(np.uint64).max, np.uint64)
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    for i in range(2 * T):
        draw = W.mix(grams ^ _ROUND[i])
        value = np.uint64(i) << np.uint64(48) | (draw & np.uint64((1 << 48) - 1))
        if i < T:
            place = row * T + ((draw >> np.uint64(48)) * np.uint64(T) >> np.uint64(16)).astype(np.int64)
            np.minimum.at(best, place, value)
        else:
            start = np.flatnonzero(np.diff(row, prepend=-1))
            own = row[start] * T + (i - T)
            best[own] = np.minimum(best[own], np.minimum.reduceat(value, start))
        open_ = (best.reshape(-1, T) == np.iinfo(np.uint64).max).any(axis=1)
        keep = open_[row]
        if not keep.any():
            break
        if not keep.all():
            grams, row = grams[keep], row[keep]
    return (W.mix(best) >> np.uint64(48)).astype(np.uint16).reshape(-1, T)


def _shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row in ascending order, and where each row's begin."""
    grams, at = gram_sets(W.split(texts, W.SPACE, True), SHINGLE)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
    return grams[new], np.searchsorted(row[new], np.arange(len(at)))


def _print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, ver, n, key1 and key2 (equal for equal sets), sketch (null for the empty set)."""
    for batch in W.portions(batches):
        grams, at = _shingles(batch.column("text"))
        size = np.diff(at)
        some = np.flatnonzero(size)
        keys = np.zeros((2, len(batch)), np.uint64)
        for j, salt in enumerate((29, 31)):
            if len(some):
                keys[j, some] = np.add.reduceat(W.mix(grams + np.uint64(salt)), at[:-1][some])
        flat = sketches(grams, np.concatenate([at[:-1][some], at[-1:]])).tobytes()
        offsets = np.concatenate([[0], np.cumsum(size > 0)]).astype(np.int32) * (2 * T)
        sketch = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ver"), pa.array(size.astype(np.int64)),
             pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), sketch],
            ["doc_id", "ver", "n", "key1", "key2", "sketch"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, T)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketch = _matrix(batch.column("sketch")).astype(np.uint64).reshape(len(batch), BANDS, ROWS)
        key = W.mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :].repeat(len(batch), 0)
        for j in range(ROWS):
            key = W.mix(key + sketch[:, :, j])
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(pa.array(np.repeat(np.arange(len(batch)), BANDS))),
             pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(batch))), pa.array(key.ravel().view(np.int64))],
            ["node", "band", "bucket"])


def _near(both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """PERCENT % of the union or more is shared, in whole numbers."""
    return 100 * both >= PERCENT * (a + b - both)


def _likely_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        agree = (_matrix(batch.column("sketch")) == _matrix(batch.column("other"))).sum(axis=1)
        yield batch.select(["node", "root"]).filter(pa.array(agree >= LIKELY))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.portions(batches):
        grams, at = _shingles(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(grams.view(np.int64)))],
            ["node", "grams"])


def _cell_pairs(batch: pa.RecordBatch, a: int, b: int):
    """Places (i < j) of likely pairs of different components that meet first in this cell's band."""
    sketch = _matrix(batch.column("sketch").slice(a, b - a))
    own, group = (batch.column(c).to_numpy()[a:b] for c in ("own", "root_at"))
    band, low, high = (batch.column(c)[a].as_py() for c in ("band", "low", "high"))
    m = b - a
    agree, earlier = np.zeros((m, m), np.uint16), np.zeros((m, m), bool)
    for at in range(BANDS):
        whole = np.ones((m, m), bool) if at < band else None
        for c in range(at * ROWS, (at + 1) * ROWS):
            same = sketch[:, c, None] == sketch[None, :, c]
            agree += same
            if whole is not None:
                whole &= same
        if whole is not None:
            earlier |= whole
    wanted = np.triu((agree >= LIKELY) & ~earlier & (group[:, None] != group[None, :]), 1)
    if low != high:
        wanted &= own[:, None] != own[None, :]
    return np.nonzero(wanted)


def _active_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, bounds in _whole_cells(batches):
        keep = [np.zeros(0, np.int64)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 1:
                i, j = _cell_pairs(batch, a, b)
                keep.append(a + np.unique(np.concatenate([i, j])))
        yield batch.take(pa.array(np.concatenate(keep))).select(_IN_CELL)


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each cell a spanning forest of its links: node, root (the smallest place it hangs together with)."""
    for batch, bounds in _whole_cells(batches):
        sets = _lists(batch.column("grams"))
        size = np.array([len(s) for s in sets])
        root = np.arange(len(batch))
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 1:
                i, j = _cell_pairs(batch, a, b)
                if len(i):
                    both = _overlaps(sets[a:b], i, j)
                    near = _near(both, size[a + i], size[a + j])
                    _unite(root, a + i[near], a + j[near])
        keep = np.flatnonzero(root != np.arange(len(batch)))
        node = batch.column("node")
        yield pa.RecordBatch.from_arrays([node.take(pa.array(keep)), node.take(pa.array(root[keep]))], ["node", "root"])


def _sorted_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_CELL).sortWithinPartitions(*_CELL)


def _cells(members: DataFrame) -> DataFrame:
    """(bucket, band, node, root) of mixed buckets, with a cell (path, low, high) per pair of blocks to be compared.

    A block holds members of one component, or of several that are small; a block of a single component is not
    compared with itself, nor with others of the component.
    """
    per = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    total = per.groupBy("bucket").agg(F.sum(F.when(F.col("n") < LARGE, F.col("n"))).alias("small"))
    small = F.coalesce(F.ceil(F.col("small") / BLOCK), F.lit(0)).cast("int")
    blocks = per.join(total, "bucket").withColumn("large", F.col("n") >= LARGE).select(
        "bucket", "root", "large", small.alias("mixed"), F.ceil(F.col("n") / BLOCK).cast("int").alias("own_blocks"))
    # small components share the blocks 0 to mixed - 1 by hash; a large one has own_blocks of its own
    spread = F.when(F.col("large"), F.pmod(F.xxhash64("node"), F.col("own_blocks"))).otherwise(
        F.pmod(F.xxhash64("root"), F.greatest("mixed", F.lit(1))))
    name = F.when(F.col("large"), F.xxhash64("root", spread)).otherwise(spread).cast("long")
    placed = members.join(blocks, ["bucket", "root"]).withColumn("own", name).drop("mixed", "own_blocks")
    known = placed.select("bucket", "own", F.when(F.col("large"), F.col("root")).alias("only")).distinct()
    pairs = known.withColumnRenamed("own", "low").withColumnRenamed("only", "a").join(
        known.withColumnRenamed("own", "high").withColumnRenamed("only", "b"), "bucket").where(
        (F.col("low") <= F.col("high")) & ~F.coalesce(F.col("a") == F.col("b"), F.lit(False))).select("bucket", "low", "high")
    both = pairs.select("*", F.explode(F.array_distinct(F.array("low", "high"))).alias("own"))
    return placed.drop("large").join(both, ["bucket", "own"]).withColumnRenamed("bucket", "path").withColumn(
        "root_at", F.xxhash64("root")).select(*_IN_CELL)


def _confirmed(cand: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (node, root) of cand whose sets are near."""
    root_sets = sets.select(F.col("node").alias("root"), F.col("grams").alias("other"))
    both = F.size(F.array_intersect("grams", "other"))
    return cand.join(sets, "node").join(root_sets, "root").withColumn("both", both).where(
        100 * F.col("both") >= PERCENT * (F.size("grams") + F.size("other") - F.col("both"))).select("node", "root")


def near_groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, ver, n_shingles, component_id (smallest doc_id reachable), kept."""
    rows = shared.texts(docs).select("doc_id", F.hash("text").alias("ver"), "text")
    prints = shared.landed(rows.mapInArrow(
        _print_rows, "doc_id long, ver int, n long, key1 long, key2 long, sketch binary"), "prints")
    texts = shared.landed(
        prints.where("n > 0").groupBy("key1", "key2").agg(F.min(F.struct("doc_id", "ver", "sketch")).alias("one"))
        .select("key1", "key2", F.struct("one.doc_id", "one.ver").alias("node"), "one.sketch"), "texts")
    sketch = texts.select("node", "sketch")

    def sets_of(nodes: DataFrame) -> DataFrame:
        # the same plan at every size: wanted texts are joined by shuffling, never sent to all tasks
        return rows.select(F.struct("doc_id", "ver").alias("node"), "text").join(
            nodes.distinct().hint("merge"), "node").dropDuplicates(["node"]).mapInArrow(_set_rows, f"{_NODE}, grams array<long>")

    banded = sketch.mapInArrow(_band_rows, f"{_NODE}, band int, bucket long")
    head = banded.groupBy("bucket").agg(F.min("node").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = shared.landed(banded.join(head, "bucket"), "buckets")
    stars = members.where("node != root").select("node", "root").distinct()
    likely = shared.landed(
        stars.join(sketch, "node").join(sketch.select(F.col("node").alias("root"), F.col("sketch").alias("other")), "root")
        .mapInArrow(_likely_stars, _LINK), "stars")
    sets = shared.landed(sets_of(likely.select("node").unionByName(likely.select(F.col("root").alias("node")))), "sets")
    links = shared.landed(_confirmed(likely, sets), "star-links")
    first = shared.landed(components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))), "star-components")

    own = members.drop("root").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = own.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least != most").select("bucket")
    cells = shared.landed(_cells(shared.landed(own.join(mixed, "bucket"), "mixed")), "cells")
    active = shared.landed(_sorted_cells(cells.join(sketch, "node")).mapInArrow(_active_rows, _CELL_ROWS), "active")
    more = _sorted_cells(active.join(sketch, "node").join(sets_of(active.select("node")), "node")).mapInArrow(
        _link_rows, _LINK)
    links = links.unionByName(shared.landed(more, "cell-links"))
    group = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))

    of_text = texts.select("key1", "key2", "node").join(group, "node", "left").select(
        "key1", "key2", F.coalesce("root.doc_id", "node.doc_id").alias("found"))
    out = prints.where("n > 0").select("doc_id", "ver", "n", "key1", "key2").join(of_text, ["key1", "key2"]).select(
        "doc_id", "ver", "n", "found").unionByName(
        prints.where("n = 0").select("doc_id", "ver", "n", F.col("doc_id").alias("found")))
    return out.select("doc_id", "ver", F.col("n").alias("n_shingles"), F.col("found").alias("component_id"),
                      (F.col("doc_id") == F.col("found")).alias("kept"))
