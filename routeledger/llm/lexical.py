"""Ranked lexical search: the k best documents of every item by summed term weights, exactly.

Documents are read once into postings of the items' terms (document, length, terms, frequencies). Scoring goes
through the postings in blocks. A block holds one bitmap per term; an item's bitmaps give each document the mask
of the terms it has, and documents with one mask form a group. No document of a group scores more than the
sum over the mask of the block's largest contribution of each term, so groups are evaluated by descending bound
until the next bound is below the k-th best score found so far, by the task, for that item. Terms whose bounds
together stay below it cannot carry a document alone and open no group. Ties are kept: only a lower bound ends.

Items go to the tasks in slices of at most `SLICE` distinct (item, term) rows (an item with more is a slice of its
own), so that what is sent is bounded whatever their number; each slice is a pass over the postings.

Defined results: a null or empty document has no terms and is nobody's result; items without a term, or whose
terms no document has, have no rows; repeated item rows count once, different texts under one item_id are ranked
on their own; repeated documents are ranked as the rows they are; rows without an id are left out; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger.llm import shared, words as W

TOP = 20
SLICE = 1 << 17
#: a block ends with the batch that brings it to so many postings or documents
POSTINGS, DOCUMENTS = 1 << 20, 1 << 16
#: presence bits of an item are unpacked for so many (term, document) pairs at a time
MASK_BYTES = 1 << 23
_BITS = 23


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.portions(batches):
        words = W.split(batch.column("text"), W.ALNUM, True)
        found = [np.unique(words.hash[words.span(i)], return_counts=True) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), pa.array([t.view(np.int64) for t, _ in found], pa.list_(pa.int64())),
             pa.array([n for _, n in found], pa.list_(pa.int64()))], ["item", "terms", "times"])


def item_terms(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(item, terms, times): the distinct terms of each different (id, text), as 64-bit hashes."""
    rows = items.select(F.struct(F.col(item_id).alias("id"), F.xxhash64("text").alias("ver")).alias("item"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    return rows.where("item.id is not null").dropDuplicates(["item"]).mapInArrow(
        _item_rows, f"item {kind}, terms array<long>, times array<long>")


def _slots(terms: np.ndarray) -> np.ndarray:
    return (terms.view(np.uint64) >> np.uint64(64 - _BITS)).astype(np.int64)


def _vocabulary(terms: DataFrame) -> np.ndarray:
    """One bit per slot that a term falls in: 1 MB, however many terms there are."""
    found = terms.select(F.shiftrightunsigned("term", 64 - _BITS).alias("slot")).groupBy(
        F.shiftright("slot", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (_BITS - 6), np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


def _posting_rows(vocabulary: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.ALNUM, True)
            slot = _slots(words.hash)
            known = np.flatnonzero((vocabulary[slot >> 6] >> (slot & 63)) & 1)
            row, term = words.row()[known], words.hash[known].view(np.int64)
            order = np.lexsort((term, row))
            row, term = row[order], term[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
            start = np.flatnonzero(new)
            times = np.diff(np.append(start, len(row))).astype(np.int32)
            at = pa.array(np.searchsorted(row[start], np.arange(len(batch) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(words.first).astype(np.int64)),
                 pa.ListArray.from_arrays(at, pa.array(term[start])), pa.ListArray.from_arrays(at, pa.array(times))],
                ["doc_id", "n", "terms", "tf"])
    return rows


def _frequency_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        term, df = np.unique(batch.column("terms").flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df)], ["term", "df"])


class Block:
    """The postings of some documents by term: bitmap, contributions without weight, and the largest of them."""

    def __init__(self, docs: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> None:
        self.docs, size = docs, len(docs)
        row = np.repeat(np.arange(size), sizes)
        part = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
        order = np.argsort(terms, kind="stable")
        self.row, self.part = row[order], part[order]
        self.term, start = np.unique(terms[order], return_index=True)
        self.start = np.append(start, len(terms))
        self.most = np.maximum.reduceat(self.part, start) if len(start) else np.zeros(0, np.int64)
        self.bits = np.zeros((len(self.term), -(-size // 8)), np.uint8)
        group = np.repeat(np.arange(len(self.term)), np.diff(self.start))
        np.bitwise_or.at(self.bits, (group, self.row >> 3), (128 >> (self.row & 7)).astype(np.uint8))

    def postings(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.start[i], self.start[i + 1])
        return self.row[own], self.part[own]


def _mask_groups(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of presence bits (term, document): an example document of each distinct mask, and each document's mask."""
    code = np.zeros(bits.shape[1], np.int64)
    for a in range(0, len(bits), 31):
        chunk = bits[a:a + 31]
        value = (np.int64(1) << np.arange(len(chunk), dtype=np.int64)) @ chunk.astype(np.int64)
        _, first, code = np.unique(code << 31 | value, return_index=True, return_inverse=True)
    return first, code


def best_in_block(block: Block, terms: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of documents that may be among the k best, given the k-th best score so far (0: none)."""
    at = np.minimum(np.searchsorted(block.term, terms), max(len(block.term) - 1, 0))
    here = np.flatnonzero((weight > 0) & (block.term[at] == terms)) if len(block.term) else np.zeros(0, np.int64)
    at, weight = at[here], weight[here]
    most = weight * block.most[at]
    order = np.argsort(most)
    at, weight, most = at[order], weight[order], most[order]
    floor = max(floor, 1)
    carry = np.cumsum(most) >= floor  # documents with none of these terms stay below
    found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    union = np.bitwise_or.reduce(block.bits[at[carry]], axis=0)
    rows = np.flatnonzero(np.unpackbits(union, count=len(block.docs)))
    width = max(1, MASK_BYTES // max(len(at), 1))
    for a in range(0, len(rows), width):
        floor = _evaluate(block, rows[a:a + width], at, weight, most, k, floor, found, scores)
    rows, total = np.concatenate(found), np.concatenate(scores)
    keep = total >= floor
    return rows[keep], total[keep]


def _evaluate(block, rows, at, weight, most, k, floor, found, scores) -> int:
    """Adds scored documents of these rows, groups of equal masks by descending bound; the k-th best score now."""
    bits = np.stack([np.unpackbits(block.bits[i], count=len(block.docs))[rows] for i in at])
    first, mask = _mask_groups(bits)
    bound = most @ bits[:, first].astype(np.int64)
    turn = np.argsort(-bound[mask], kind="stable")
    upper = bound[mask[turn]]
    done, step = 0, 4 * k
    while done < len(turn) and upper[done] >= floor:
        stop = min(done + step, len(turn))
        stop = int(np.searchsorted(-upper, -upper[stop - 1], "right"))  # whole groups
        some = np.sort(rows[turn[done:stop]])
        total = np.zeros(len(some), np.int64)
        for i, w in zip(at, weight):
            row, part = block.postings(i)
            spot = np.minimum(np.searchsorted(row, some), len(row) - 1)
            total += np.where(row[spot] == some, w * part[spot], 0)
        found.append(some)
        scores.append(total)
        every = np.concatenate(scores)
        if len(every) >= k:
            floor = max(floor, int(np.partition(every, len(every) - k)[len(every) - k]))
        done, step = stop, 4 * step
    return floor


def _cut(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def _blocks(batches: Iterator[pa.RecordBatch], base: int, docs: int, length: int) -> Iterator[Block]:
    def block(held: list[pa.RecordBatch]) -> Block:
        table = pa.Table.from_batches(held)
        flat = lambda c: np.concatenate([x.flatten().to_numpy() for x in table.column(c).chunks])
        n = table.column("n").to_numpy()
        sizes = np.concatenate([np.diff(x.offsets.to_numpy()) for x in table.column("terms").chunks])
        m = 100 - base + (base * n * docs) // length
        return Block(table.column("doc_id").to_numpy(), m, sizes, flat("terms"), flat("tf").astype(np.int64))

    held, postings, rows = [], 0, 0
    for whole in batches:
        offsets = whole.column("terms").offsets.to_numpy()
        at = 0
        while at < len(whole):  # parts that end with the document that fills the block
            to = int(np.searchsorted(offsets, offsets[at] + POSTINGS - postings))
            to = min(max(to, at + 1), at + DOCUMENTS - rows, len(whole))
            held.append(whole.slice(at, to - at))
            postings, rows = postings + int(offsets[to] - offsets[at]), rows + to - at
            at = to
            if postings >= POSTINGS or rows >= DOCUMENTS:
                yield block(held)
                held, postings, rows = [], 0, 0
    if held:
        yield block(held)


def _best_rows(slice_: list[tuple[int, np.ndarray, np.ndarray]], k: int, base: int, docs: int, length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {i: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for i, _, _ in slice_}
        for block in _blocks(batches, base, docs, length):
            for i, terms, weight in slice_:
                own, scores = best[i]
                found, more = best_in_block(block, terms, weight, k, int(scores[-1]) if len(scores) >= k else 0)
                if len(found):
                    best[i] = _cut(np.concatenate([own, block.docs[found]]), np.concatenate([scores, more]), k)
        at = np.repeat(np.array(list(best), np.int64), [len(x) for x, _ in best.values()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *[pa.array(np.concatenate([x[j] for x in best.values()] or [np.zeros(0, np.int64)])) for j in (0, 1)]],
            ["number", "doc_id", "score"])
    return rows


class Searcher:
    """Postings of all documents for the terms of the items, and the items' weighted terms.

    base: the share in hundredths of a document's length in what damps its term frequencies.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, item_id: str = "item_id", base: int = 25) -> None:
        self.base = base
        spark = docs.sparkSession
        terms = shared.landed(item_terms(items, item_id), "item-terms")
        vocabulary = _vocabulary(terms.select(F.explode("terms").alias("term")))
        self.postings = shared.landed(shared.texts(docs).mapInArrow(
            _posting_rows(vocabulary), "doc_id long, n long, terms array<long>, tf array<int>"), "postings")
        count = self.postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        #: documents with a term, and all their terms with repeats
        self.docs, self.length = count[0], count[1] or 0
        df = self.postings.select("terms").mapInArrow(_frequency_rows, "term long, df long").groupBy("term").agg(
            F.sum("df").alias("df"))
        #: (item, term, weight): the weight times the term's repeats in the item (0 where nearly all documents have the term)
        self.weights = shared.landed(
            terms.select("item", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("times").alias("times"))))
            .join(df, "term").select("item", "term", (F.col("times") * self._weight()).alias("weight")), "item-weights")
        sized = self.weights.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
        self.slices = -(-(sized.agg(F.sum("size")).first()[0] or 0) // (SLICE // 2)) or 1
        self.spark = spark

    def _weight(self) -> Column:
        return F.floor(1000 * F.ln(F.lit(2.0 * self.docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")

    def top(self, k: int = TOP) -> DataFrame:
        """(item, rank, doc_id, score): the k best documents of each item, equal scores by doc_id."""
        out = None
        kind = self.weights.schema["item"].dataType.simpleString()
        for s in range(self.slices):
            mine = self.weights.where(F.pmod(F.xxhash64("item"), F.lit(self.slices)) == s).groupBy("item").agg(
                F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("terms")).toArrow()
            names = mine.column("item")
            slice_ = []
            for i, row in enumerate(mine.column("terms")):
                pairs = row.values
                slice_.append((i, pairs.field("term").to_numpy(), pairs.field("weight").to_numpy()))
            ids = self.spark.createDataFrame(pa.table({"number": pa.array(range(len(mine)), pa.int64()), "item": names}),
                                             f"number long, item {kind}")
            found = self.postings.where("size(terms) > 0").mapInArrow(
                _best_rows(slice_, k, self.base, self.docs, self.length), "number long, doc_id long, score long")
            order = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
            best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(ids, "number")
            best = best.select("item", "rank", "doc_id", "score")
            out = best if out is None else out.unionByName(best)
        return out


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Per item its k best documents: item_id, rank, doc_id, score."""
    return Searcher(docs, items).top(k).select(F.col("item.id").alias("item_id"), "rank", "doc_id", "score")
