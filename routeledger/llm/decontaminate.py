"""Benchmark passages in training documents, by a positional inverted index of the documents.

Windows of `length` words of each benchmark item are looked up as phrases. All documents are counted for
the benchmark's terms; the rarest term of a window is its entry. The index holds the postings (term, document,
position) of the benchmark's terms that stand close enough to an entry term to be in one window with it. Entry postings less the term's offset give
the possible starts; a start is an exact match when the offset-adjusted postings of all the other terms meet
there. Terms are 64-bit hashes of words.

Tasks skip words that are no benchmark term by a bit map of fixed size (2**23 bits, 1 MB), whatever the
benchmark's size; what passes it wrongly goes out in the joins. Nothing else is broadcast by hand.

Defined results: a null or empty document has no words and no hits; a null or empty item has no window;
an item of fewer words than a window is one window; repeated items count once in n_items; repeated rows of a
document each get the row's result; rows without an id are left out; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W

LENGTH = 13
_BITS = 23


def _slot(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - _BITS)).astype(np.int64)


def _window_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.ALNUM, True)
            size = np.diff(words.first)
            ids = batch.column("doc_id").to_numpy()
            spans = [(ids[i], words.first[i] + j, min(length, size[i]))
                     for i in np.flatnonzero(size) for j in range(max(1, size[i] - length + 1))]
            terms = [words.hash[a:a + n] for _, a, n in spans]
            keys = [[int(W.grams(t, len(t), salt)[0].view(np.int64)) for t in terms] for salt in (5, 7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in spans], pa.int64()), pa.array(keys[0], pa.int64()),
                 pa.array(keys[1], pa.int64()), pa.array([int(x[2]) for x in spans], pa.int32()),
                 pa.array([t.view(np.int64) for t in terms], pa.list_(pa.int64()))],
                ["item_id", "key1", "key2", "size", "terms"])
    return rows


def item_windows(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """(item_id, key1, key2, size, terms) for every window of every item of (doc_id as the id, text)."""
    return shared.texts(items).mapInArrow(
        _window_rows(length), "item_id long, key1 long, key2 long, size int, terms array<long>")


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Which slots the terms fall in: at most 2**17 words of 64 bits reach the driver, however many terms."""
    slot = F.shiftrightunsigned("term", 64 - _BITS)
    rows = (
        terms.select(F.shiftright(slot, 6).cast("int").alias("word"),
                     F.expr(f"shiftleft(1L, cast(shiftrightunsigned(term, {64 - _BITS}) & 63 as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    out = np.zeros(1 << (_BITS - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def _hit(bitmap: np.ndarray, terms: np.ndarray) -> np.ndarray:
    slot = _slot(terms)
    return (bitmap[slot >> 6] >> (slot & 63)) & 1 == 1


def _count_rows(bitmap: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            terms = W.split(batch.column("text"), W.ALNUM, True).hash
            term, n = np.unique(terms[_hit(bitmap, terms)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])
    return rows


def _index_rows(vocabulary: np.ndarray, entries: np.ndarray, reach: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.ALNUM, True)
            row, size = words.row(), np.diff(words.first)
            known = np.flatnonzero(_hit(vocabulary, words.hash))
            entry = known[_hit(entries, words.hash[known])]
            change = np.zeros(len(row) + 1, np.int64)
            np.add.at(change, np.maximum(entry - reach, 0), 1)
            np.add.at(change, np.minimum(entry + reach + 1, len(row)), -1)
            known = known[np.cumsum(change)[known] > 0]
            at = np.searchsorted(known, words.first).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in
                     (words.hash[known].view(np.int64), (known - words.first[row[known]]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ver"), pa.array(size.astype(np.int64)), *lists],
                ["doc_id", "ver", "n_words", "terms", "places"])
    return rows


class Index:
    """The documents' positional index for one set of windows, landed in the shared folder.

    reach: words from an entry term up to which terms are kept; proximity() needs at least length + slop. From a
    reach of length on, windows with terms that no document has are kept for proximity().
    """

    def __init__(self, docs: DataFrame, items: DataFrame, length: int = LENGTH, reach: int | None = None) -> None:
        reach = length - 1 if reach is None else reach
        self.length, self.reach = length, reach
        rows = shared.texts(docs).select("doc_id", F.hash("text").alias("ver"), "text")
        self.of_items = shared.landed(item_windows(items, length), "benchmark-windows")
        windows = self.of_items.dropDuplicates(["key1", "key2"])
        need = windows.select("key1", "key2", "size", F.posexplode("terms").alias("offset", "term"))
        vocabulary = _bitmap(need.select("term"))
        counts = (
            rows.select("text").mapInArrow(_count_rows(vocabulary), "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n"))
        )
        ranked = need.join(counts, "term").groupBy("key1", "key2", "size").agg(
            F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("need"))
        #: windows whose every term some document has, rarest term first
        if reach >= length:
            #: windows with any term that some document has
            self.near_need = shared.landed(ranked, "benchmark-present-terms")
            self.need = self.near_need.where("size(need) = size")
        else:
            self.near_need = self.need = shared.landed(ranked.where("size(need) = size"), "benchmark-terms")
        entries = self.near_need.select(F.col("need")[0].term.alias("term"))
        #: one row per document, with the postings of benchmark terms near its entry terms
        self.docs = shared.landed(rows.mapInArrow(
            _index_rows(vocabulary, _bitmap(entries), reach),
            "doc_id long, ver int, n_words long, terms array<long>, places array<int>"), "positional-index")

    def postings(self) -> DataFrame:
        """(term, doc_id, ver, place)."""
        return self.docs.where("size(terms) > 0").select(
            "doc_id", "ver", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("places").alias("place"))),
        )

    def phrases(self) -> DataFrame:
        """(doc_id, ver, start, size, key1, key2): every exact occurrence of a window."""
        first = self.need.select("key1", "key2", "size", F.col("need")[0].term.alias("term"),
                                 F.col("need")[0].offset.alias("offset"), "need")
        starts = (
            self.postings().join(first, "term")
            .select("doc_id", "ver", (F.col("place") - F.col("offset")).alias("start"), "size", "key1", "key2",
                    F.slice("need", 2, F.size("need")).alias("rest"))
            .where("start >= 0")
        )
        short = starts.where("size = 1").drop("rest").distinct()
        others = starts.where("size > 1").select(
            "doc_id", "ver", "start", "size", "key1", "key2", F.explode("rest").alias("x")
        ).select("doc_id", "ver", "start", "size", "key1", "key2", F.col("x.term").alias("term"),
                 (F.col("start") + F.col("x.offset")).alias("place"))
        met = (
            others.join(self.postings(), ["doc_id", "ver", "term", "place"])
            .groupBy("doc_id", "ver", "start", "size", "key1", "key2")
            .agg(F.size(F.collect_set("place")).alias("n")).where("n = size - 1").drop("n")
        )
        return met.unionByName(short)

    def proximity(self, slop: int = 30, terms: int = 3) -> DataFrame:
        """(doc_id, ver, key1, key2): the rarest terms of a window all lie within slop of their places in it.

        Terms that no document has do not count; `terms` others (all, in shorter windows) must be there.
        Offset-adjusted postings are gathered on two grids of 2 * slop + 2 places, half a step apart, so any run
        of places that is no longer than slop lies whole in a cell of one of them.
        """
        if self.reach < self.length + slop:
            raise ValueError(f"proximity with slop {slop} needs an index with a reach of {self.length + slop}")
        some = self.near_need.where(F.size("need") >= F.least("size", F.lit(terms))).select("key1", "key2", F.least(F.size("need"), F.lit(terms)).alias("k"),
                                F.inline(F.slice("need", 1, terms)))
        near = self.postings().join(some, "term").select(
            "doc_id", "ver", "key1", "key2", "k", "offset", (F.col("place") - F.col("offset")).alias("start"))
        cell, half = 2 * slop + 2, slop + 1
        near = near.select("*", F.explode(F.array(F.lit(0), F.lit(half))).alias("shift")).withColumn(
            "cell", F.floor((F.col("start") + F.col("shift")) / cell))
        group = near.groupBy("doc_id", "ver", "key1", "key2", "k", "shift", "cell").agg(
            F.array_sort(F.collect_set(F.struct("start", "offset"))).alias("hits"))
        within = F.exists("hits", lambda h: F.size(F.array_distinct(F.transform(
            F.filter("hits", lambda o: (o.start >= h.start) & (o.start <= h.start + slop)),
            lambda o: o.offset))) >= F.col("k"))
        return group.where(within).select("doc_id", "ver", "key1", "key2").distinct()


def contamination(docs: DataFrame, items: DataFrame, length: int = LENGTH, share: int = 20) -> DataFrame:
    """Per document: doc_id, ver, n_words, n_hit, n_items, items_sha256, contaminated (hit words are 1/share or more)."""
    index = Index(docs, items, length)
    found = shared.landed(index.phrases(), "benchmark-phrases")
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop")))),
        F.expr("named_struct('n', 0L, 'stop', 0)"),
        lambda done, x: F.struct(
            (done.n + F.greatest(x.stop - F.greatest(x.start, done.stop), F.lit(0))).alias("n"),
            F.greatest(done.stop, x.stop).alias("stop")))
    hits = found.groupBy("doc_id", "ver").agg(covered.n.alias("n_hit"))
    items_of = (
        found.select("doc_id", "ver", "key1", "key2").distinct()
        .join(index.of_items.select("key1", "key2", "item_id").distinct(), ["key1", "key2"])
        .groupBy("doc_id", "ver")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        index.docs.select("doc_id", "ver", "n_words").join(hits, ["doc_id", "ver"], "left")
        .join(items_of, ["doc_id", "ver"], "left")
        .select("doc_id", "ver", "n_words", hit.alias("n_hit"),
                F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"))
    )


def near(docs: DataFrame, items: DataFrame, length: int = LENGTH, slop: int = 30, terms: int = 3) -> DataFrame:
    """Per document: doc_id, ver, n_near, the items that are met by proximity and by no exact phrase."""
    index = Index(docs, items, length, length + slop)
    of_items = index.of_items.select("key1", "key2", "item_id").distinct()

    def met(found: DataFrame) -> DataFrame:
        return found.join(of_items, ["key1", "key2"]).select("doc_id", "ver", "item_id").distinct()

    only = met(index.proximity(slop, terms)).join(met(index.phrases()), ["doc_id", "ver", "item_id"], "left_anti")
    counts = only.groupBy("doc_id", "ver").agg(F.count(F.lit(1)).alias("n_near"))
    return index.docs.select("doc_id", "ver").join(counts, ["doc_id", "ver"], "left").select(
        "doc_id", "ver", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))


def clean(docs: DataFrame, items: DataFrame, length: int = LENGTH, share: int = 20) -> DataFrame:
    """docs without the contaminated ones; rows without an id stay."""
    bad = contamination(docs, items, length, share).where("contaminated").select("doc_id", "ver").distinct()
    own, bad = docs.alias("own"), bad.alias("bad")
    same = (F.col("own.doc_id") == F.col("bad.doc_id")) & (
        F.hash(F.coalesce(F.col("own.text"), F.lit(""))) == F.col("bad.ver"))
    return own.join(bad, same, "left_anti")
