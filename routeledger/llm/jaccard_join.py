"""Documents whose word 5-grams have a Jaccard similarity of 0.8 or more, by a chosen-path join.

Exact copies collapse first: one text stands for all its copies. A text's 5-gram set is embedded as `T`
smallest hashes, on which shared positions are as frequent as the Jaccard similarity. A node of the recursion
is a path of (position, value) choices; a node's texts choose each position with probability 1 / (0.8 T),
drawn from the path, so that texts choose alike. Nodes of at most `SMALL` texts, and nodes that splitting
no longer shrinks, are compared by brute force, larger ones in cells of two blocks. Roots are drawn anew
until texts at the threshold meet with the target recall (see `roots`).

Pairs are compared inside a task and never written: a pair counts in the first node that holds both, so each
text's links are exact sums. A first pass compares hashes only and keeps, per cell, the texts that have a
likely partner there; the second pass fetches these texts' sets and decides exactly.

Defined results: texts of one to four words have one gram, of all their words; null and empty texts have none
and stay alone; copies of a text, repeated rows included, count as links; rows without doc_id are left out;
extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W
from routeledger.llm.components import components

GRAM = 5
THRESHOLD = 0.8
#: positions of the embedding; likely partners agree in LIKELY of them (0.8 less four standard deviations)
T = 64
LIKELY = 38
SMALL = 256
BLOCK = 512
DEPTH = 6
RECALL = 0.999

_SEEDS = W.mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
_NODE = "node struct<doc_id:long,ver:int>"


def roots(recall: float = RECALL, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Root draws after which a pair at the threshold meets at the given depth with this probability.

    A pair's common nodes branch with a Poisson(1) number of children, so a root that both chose
    (probability: threshold) has none left after depth - 1 splits with probability q, q -> exp(q - 1) from 0.
    """
    gone = 0.0
    for _ in range(depth - 1):
        gone = math.exp(gone - 1)
    return min(T, math.ceil(math.log(1 - recall) / math.log(1 - threshold * (1 - gone))))


def gram_sets(words: W.Words, k: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The gram hashes of all rows in order, and where each row's begin (one entry more)."""
    size = np.diff(words.first)
    count = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(at[-1], np.uint64)
    long_rows = np.repeat(size >= k, count)
    out[long_rows] = W.grams(words.hash, k, 11)[W.inside(words.first, k)]
    for i in np.flatnonzero((size > 0) & (size < k)):
        own = words.hash[words.span(i)]
        out[at[i]] = W.grams(own, len(own), 13 + len(own))[0]
    return out, at


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, ver, key1, key2 (equal for copies), sketch: T smallest hashes; only rows with words."""
    for batch in W.portions(batches):
        words = W.split(batch.column("text"), W.SPACE, False)
        size = np.diff(words.first)
        some = np.flatnonzero(size)
        place = (np.arange(len(words.hash)) - np.repeat(words.first[:-1], size)).astype(np.uint64)
        keys = [np.add.reduceat(W.mix(W.mix(words.hash + np.uint64(salt)) + place * np.uint64(0xC2B2AE3D27D4EB4F)),
                                words.first[:-1][some]) if len(some) else np.zeros(0, np.uint64) for salt in (17, 19)]
        grams, at = gram_sets(words)
        sketch = np.zeros((len(some), T), np.uint32)
        for j in range(T if len(some) else 0):
            sketch[:, j] = np.minimum.reduceat(grams * _SEEDS[j], at[:-1][some]) >> np.uint64(32)
        data = pa.py_buffer(sketch.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(some)), batch.column("ver").take(pa.array(some)),
             pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
             pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * T), len(some), [None, data]).cast(pa.binary())],
            ["doc_id", "ver", "key1", "key2", "sketch"])


def _sketches(column: pa.Array) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint32)
    return data.reshape(-1, T)


def _children(parents: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and path of each child: position j of path p is chosen when a hash of (p, j) falls below 1 / (0.8 T)."""
    draw = W.mix(parents.view(np.uint64)[:, None] ^ _SEEDS[None, :])
    row, position = np.nonzero(draw < np.uint64(int(2.0**64 / (THRESHOLD * T))))
    path = W.mix(draw[row, position] + sketch[row, position].astype(np.uint64))
    return row, path.view(np.int64)


def _root_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = _sketches(batch.column("sketch"))
            path = W.mix(_SEEDS[None, :n] + sketch[:, :n].astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(np.repeat(np.arange(len(batch)), n))), pa.array(path.ravel())],
                ["node", "path"])
    return rows


def _split_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, path = _children(batch.column("path").to_numpy(), _sketches(batch.column("sketch")))
        row = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(row), pa.array(path), batch.column("n").take(row)], ["node", "path", "above"])


def _leaves(texts: DataFrame, n_roots: int) -> DataFrame:
    """(node, path, n): the nodes of the recursion to be compared, of at least two texts each."""
    level = texts.select("node", "sketch").mapInArrow(_root_rows(n_roots), f"{_NODE}, path long").withColumn(
        "above", F.lit(None).cast("long"))
    done = []
    for depth in range(1, DEPTH + 1):
        level = shared.landed(level, "paths")
        count = level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        level = level.join(count, "path")
        ready = (F.col("n") <= SMALL) | (F.col("n") >= 0.7 * F.coalesce("above", F.lit(1 << 62)))
        if depth == DEPTH:
            ready = F.lit(True)
        level = shared.landed(level.withColumn("ready", ready), "nodes")
        done.append(level.where("ready").select("node", "path", "n"))
        level = level.where("not ready").select("node", "path", "n")
        if depth == DEPTH or level.isEmpty():
            break
        level = level.join(texts.select("node", "sketch"), "node").mapInArrow(
            _split_rows, f"{_NODE}, path long, above long")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _cells(leaves: DataFrame) -> DataFrame:
    """leaves with a cell per pair of blocks: (path, low, high), and which of the two the text is in."""
    blocks = F.when(F.col("n") <= SMALL, F.lit(1)).otherwise(F.ceil(F.col("n") / BLOCK).cast("int"))
    return (
        leaves.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
        .drop("other", "n", "blocks")
    )


_CELL = ["path", "low", "high"]


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut so that no cell is divided, each with the bounds of its cells; the input is sorted by cell."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        if not len(batch):
            continue
        bounds = _bounds(batch)
        rest = batch.slice(bounds[-2])
        if len(bounds) > 2:
            yield batch.slice(0, bounds[-2]), bounds[:-1]
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _bounds(batch: pa.RecordBatch) -> np.ndarray:
    new = np.zeros(len(batch) - 1, bool)
    for c in _CELL:
        value = batch.column(c).to_numpy()
        new |= value[1:] != value[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(batch)]])


def _likely(sketch: np.ndarray, own: np.ndarray, low: int, high: int, paths: list[np.ndarray], path: int):
    """Pairs (i < j by place) of a cell that meet here first and agree in LIKELY positions."""
    if len(sketch) == 2:
        i, j = np.array([0]), np.array([1])
        if low != high and own[0] == own[1] or _common([p[p < path] for p in paths])[0, 1]:
            return i[:0], j[:0]
    else:
        fresh = np.triu(_common([p[p < path] for p in paths]) == 0, 1)
        if low != high:
            fresh &= own[:, None] != own[None, :]
        i, j = np.nonzero(fresh)
    agree = np.concatenate([(sketch[i[a:a + 50_000]] == sketch[j[a:a + 50_000]]).sum(axis=1)
                            for a in range(0, len(i), 50_000)] or [np.zeros(0, np.int64)])
    return i[agree >= LIKELY], j[agree >= LIKELY]


def _common(lists: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all lists (of distinct values), by incidence matrices in bounded slices."""
    m = len(lists)
    if m == 2:
        n = np.isin(lists[0], lists[1], assume_unique=True).sum()
        return np.array([[0, n], [n, 0]])
    total = np.zeros((m, m), np.float32)
    flat = np.concatenate(lists)
    if not len(flat):
        return total
    owner = np.repeat(np.arange(m), [len(x) for x in lists])
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    several = times > 1
    keep = several[code]
    owner, code = owner[keep], (np.cumsum(several) - 1)[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for a in range(0, int(several.sum()), 4096):
        lo, hi = np.searchsorted(code, [a, a + 4096])
        part = np.zeros((m, int(code[hi - 1]) - a + 1), np.float32)
        part[owner[lo:hi], code[lo:hi] - a] = 1
        total += part @ part.T
    return total


def _lists(column: pa.Array) -> list[np.ndarray]:
    at, flat = column.offsets.to_numpy(), column.flatten().to_numpy()
    return [flat[a - at[0]:b - at[0]] for a, b in zip(at[:-1], at[1:])]


def _cell_pairs(batch: pa.RecordBatch, bounds: np.ndarray):
    sketch = _sketches(batch.column("sketch"))
    own, low, high, path = (batch.column(c).to_numpy() for c in ("own", "low", "high", "path"))
    paths = _lists(batch.column("paths"))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            i, j = _likely(sketch[a:b], own[a:b], low[a], high[a], paths[a:b], path[a])
            if len(i):
                yield a, b, i, j


def _active_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, bounds in _whole_cells(batches):
        keep = [a + np.unique(np.concatenate([i, j])) for a, _, i, j in _cell_pairs(batch, bounds)]
        keep = pa.array(np.concatenate(keep) if keep else np.zeros(0, np.int64))
        out = batch.take(keep)
        yield out.select(["node", "own", *_CELL])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.portions(batches):
        grams, at = gram_sets(W.split(batch.column("text"), W.SPACE, False))
        sets = [np.unique(grams[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "grams"])


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets i and j, pair by pair or, for many pairs, of all at once."""
    if len(i) < 2 * len(sets):
        return np.array([np.isin(sets[a], sets[b], assume_unique=True).sum() for a, b in zip(i, j)])
    return _common(sets)[i, j].astype(np.int64)


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, links in this cell (copies counted), root: the cell's smallest node that it hangs together with."""
    for batch, bounds in _whole_cells(batches):
        copies = batch.column("copies").to_numpy()
        sets = _lists(batch.column("grams"))
        size = np.array([len(s) for s in sets])
        links, root = np.zeros(len(batch), np.int64), np.arange(len(batch))
        for a, b, i, j in _cell_pairs(batch, bounds):
            both = _overlaps(sets[a:b], i, j)
            # 5 |A & B| >= 4 |A | B|, in whole numbers
            near = 9 * both >= 4 * (size[a + i] + size[a + j])
            i, j = a + i[near], a + j[near]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            _unite(root, i, j)
        keep = np.flatnonzero(links)
        node = batch.column("node")
        yield pa.RecordBatch.from_arrays(
            [node.take(pa.array(keep)), pa.array(links[keep]), node.take(pa.array(root[keep]))],
            ["node", "links", "root"])


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Every place of i and j gets the smallest place that it is linked to, directly or not."""
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        for at in (i, j, before[i], before[j]):
            np.minimum.at(root, at, least)
        root[:] = root[root]
        if (root == before).all():
            return


def _sorted_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_CELL).sortWithinPartitions(*_CELL)


def similar(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Per document: doc_id, ver, class_id (the smallest doc_id it hangs together with), n_links."""
    rows = shared.texts(docs).select("doc_id", F.hash("text").alias("ver"), "text")
    prints = shared.landed(rows.mapInArrow(
        _prints, "doc_id long, ver int, key1 long, key2 long, sketch binary"), "prints")
    texts = shared.landed(
        prints.groupBy("key1", "key2")
        .agg(F.min(F.struct("doc_id", "ver", "sketch")).alias("one"), F.count(F.lit(1)).alias("copies"))
        .select("key1", "key2", F.struct("one.doc_id", "one.ver").alias("node"), "one.sketch", "copies"), "texts")
    leaves = _leaves(texts, roots(recall))
    about = leaves.groupBy("node").agg(F.array_sort(F.collect_set("path")).alias("paths")).join(
        texts.select("node", "sketch", "copies"), "node")
    active = shared.landed(_sorted_cells(_cells(leaves).join(about, "node")).mapInArrow(
        _active_rows, f"{_NODE}, own int, path long, low int, high int"), "active")
    wanted = active.select("node").distinct()
    # the same plan at every size: the wanted texts are joined by shuffling, never sent to all tasks
    sets = rows.withColumn("node", F.struct("doc_id", "ver")).select("node", "text").join(
        wanted.hint("merge"), "node").dropDuplicates(["node"]).mapInArrow(_set_rows, f"{_NODE}, grams array<long>")
    linked = shared.landed(_sorted_cells(active.join(about, "node").join(sets, "node")).mapInArrow(
        _link_rows, f"{_NODE}, links long, root struct<doc_id:long,ver:int>"), "links")
    total = linked.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_text = (
        texts.select("key1", "key2", "node", "copies").join(total, "node", "left").join(group, "node", "left")
        .select("key1", "key2", F.coalesce("root.doc_id", "node.doc_id").alias("class_id"),
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    of_doc = prints.select("doc_id", "ver", "key1", "key2").join(of_text, ["key1", "key2"]).select(
        "doc_id", "ver", "class_id", "n_links")
    wordless = rows.where(~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", "ver", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return of_doc.unionByName(wordless)


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs, of each class the row whose doc_id is the class's smallest; rows without doc_id stay."""
    rest = similar(docs).where("doc_id != class_id").select("doc_id", "ver").distinct()
    own, rest = docs.alias("own"), rest.alias("rest")
    same = (F.col("own.doc_id") == F.col("rest.doc_id")) & (
        F.hash(F.coalesce(F.col("own.text"), F.lit(""))) == F.col("rest.ver"))
    return own.join(rest, same, "left_anti")
