"""Removing word sequences that occur earlier in the corpus: winnowed anchors, extension, removal.

Seed: of every window of `length` words the smallest hash of its `seed`-word pieces is its anchor, so two
equal windows have the same anchor at the same place in them. Anchors that occur once are dropped by a
join on the anchor. Extend: an anchor's reach, to the left and to the right, is all words of the windows
that chose it. Where the whole reach also occurs earlier, all those windows are repeats. Only the first of
equal reaches, and only of anchors with several different ones (the edges of repeats), are compared window
by window, keyed by 128 bits. Overlapping repeats of a document are joined to maximal spans and removed.

No pairs of occurrences are formed: an anchor or a window that fills a third of the corpus costs one row
for each occurrence, counted before it is shuffled, and joins on it can be split.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; rows with
the same doc_id and text are one document listed twice, and do not repeat each other; rows with the same
doc_id and different texts are ordered by the place in the text and a hash. Rows without doc_id are left out.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W

LENGTH = 20
SEED = 6


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, ver, text): ver tells apart rows that share an id."""
    return shared.texts(docs).select("doc_id", _version("text").alias("ver"), "text")


def _version(text) -> Column:
    return F.hash(text).bitwiseAND(F.lit(0x7FFFFFFF))


_PLACE = ("cast(at & 4294967295 as int) as ver", "cast(shiftright(at, 32) as int) as pos")


def _at(pos: np.ndarray, ver: np.ndarray) -> np.ndarray:
    return (pos.astype(np.int64) << 32) | ver.astype(np.int64)


def _chosen(words: W.Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows' first words, the place of the anchor of each, and the hashes of all seed pieces."""
    starts = W.inside(words.first, length)
    piece = W.grams(words.hash, seed, 3)
    best = piece[starts] if len(starts) else np.zeros(0, np.uint64)
    place = starts.copy()
    for j in range(1, length - seed + 1):
        other = piece[starts + j]
        less = other <= best  # the rightmost of equal ones: the choice follows the window's words alone
        best = np.where(less, other, best)
        place = np.where(less, starts + j, place)
    return starts, place, piece


def _anchor_rows(length: int, seed: int):
    """anchor, reach (a hash of its words), doc_id, at, and the windows: back * 1024 + count, from at - back on."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.SPACE, False)
            starts, place, piece = _chosen(words, length, seed)
            whole = W.grams(words.hash, length, 5)
            begin = np.flatnonzero(np.diff(place, prepend=-1))  # windows with one anchor follow each other
            count = np.diff(np.append(begin, len(place)))
            place, first, last = place[begin], starts[begin], starts[begin] + count - 1
            back = place - first
            row = words.row()[place]
            form = (back * 1024 + count).astype(np.int32)
            reach = W.mix(whole[first] + W.mix(whole[last] + form.astype(np.uint64)))
            ids, ver = (batch.column(c).to_numpy() for c in ("doc_id", "ver"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece[place].view(np.int64)), pa.array(reach.view(np.int64)), pa.array(ids[row]),
                 pa.array(_at(place - words.first[row], ver[row])), pa.array(form)],
                ["anchor", "reach", "doc_id", "at", "form"])
    return rows


def _window_rows(length: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.SPACE, False)
            starts, place, _ = _chosen(words, length, seed)
            edges = batch.column("edges")
            owner = np.repeat(np.arange(len(batch)), np.diff(edges.offsets.to_numpy()))
            marked = np.zeros(len(words.hash) + 1, bool)
            marked[words.first[:-1][owner] + edges.flatten().to_numpy()] = True
            starts = starts[marked[place]]
            row = words.row()[starts]
            ids, ver = (batch.column(c).to_numpy() for c in ("doc_id", "ver"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.grams(words.hash, length, salt)[starts].view(np.int64)) for salt in (5, 7)]
                + [pa.array(ids[row]), pa.array(_at(starts - words.first[row], ver[row]))],
                ["key1", "key2", "doc_id", "at"])
    return rows


def _kept(words: W.Words, repeats: pa.Array, length: int) -> np.ndarray:
    """Which words lie in none of their row's repeats."""
    n = len(words.hash)
    owner = np.repeat(np.arange(len(repeats)), np.diff(repeats.offsets.to_numpy()))
    start, count = (repeats.flatten().field(c).to_numpy() for c in ("start", "count"))
    begin = words.first[:-1][owner] + start
    change = (np.bincount(begin, minlength=n + 1)[:n]
              - np.bincount(begin + count + length - 1, minlength=n + 1)[:n])
    return np.cumsum(change) == 0


def _removal(length: int):
    """Words, words removed and the digest of the kept ones."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.portions(batches):
            words = W.split(batch.column("text"), W.SPACE, False)
            keep = _kept(words, batch.column("repeats"), length)
            kept = np.concatenate([[0], np.cumsum(keep)])
            size = np.diff(words.first)
            lost = size - (kept[words.first[1:]] - kept[words.first[:-1]])
            digest = [hashlib.sha256(W.joined(words, keep, i)).hexdigest() for i in range(len(batch))]
            out = [batch.column("doc_id"), batch.column("ver"), pa.array(size.astype(np.int64)),
                   pa.array(lost.astype(np.int64)), pa.array(digest, pa.string())]
            names = ["doc_id", "ver", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(out, names)
    return rows


def _rest(words: W.Words, keep: np.ndarray, i: int) -> str:
    """Row i without its removed words; white space after a kept word stays, but at the end."""
    own = words.span(i)
    start = words.start[own]
    follow = np.append(start[1:], words.end[own][-1])
    return b"".join(words.data[a:b].tobytes() for a, b in _runs(start, follow, keep[own])).decode().strip()


def _runs(start: np.ndarray, follow: np.ndarray, keep: np.ndarray) -> list[tuple[int, int]]:
    """The byte ranges of the runs of kept words."""
    flag = np.concatenate([[False], keep, [False]])
    change = np.flatnonzero(flag[1:] != flag[:-1])
    return [(int(start[a]), int(follow[b - 1])) for a, b in zip(change[::2], change[1::2])]


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, ver, repeats): runs (start, count) of windows whose words also start earlier."""
    rows = _keyed(docs)
    anchors = rows.mapInArrow(
        _anchor_rows(length, seed), "anchor long, reach long, doc_id long, at long, form int")
    # landed, as are `first` and `earliest`: a join can be split at a hot key only if no grouping stands between it and its shuffles
    often = shared.landed(
        anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "substring-often")
    seeds = shared.landed(anchors.join(often, "anchor", "left_semi"), "substring-seeds")
    first = shared.landed(
        seeds.groupBy("anchor", "reach").agg(F.min(F.struct("doc_id", "at")).alias("one")), "substring-first")
    again = (
        seeds.join(first, ["anchor", "reach"]).where("struct(doc_id, at) != one")
        .selectExpr("doc_id", *_PLACE, "form")
        .selectExpr("doc_id", "ver", "pos - shiftright(form, 10) as start", "form & 1023 as count")
    )
    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    edges = (
        first.join(several, "anchor", "left_semi").select("one.*").selectExpr("doc_id", *_PLACE)
        .groupBy("doc_id", "ver").agg(F.collect_list("pos").alias("edges"))
    )
    windows = rows.join(edges, ["doc_id", "ver"]).dropDuplicates(["doc_id", "ver"]).mapInArrow(
        _window_rows(length, seed), "key1 long, key2 long, doc_id long, at long")
    windows = shared.landed(windows, "substring-edges")
    earliest = shared.landed(
        windows.groupBy("key1", "key2")
        .agg(F.min(F.struct("doc_id", "at")).alias("one"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("key1", "key2", "one"), "substring-earliest")
    late = (
        windows.join(earliest, ["key1", "key2"]).where("struct(doc_id, at) != one")
        .selectExpr("doc_id", *_PLACE).selectExpr("doc_id", "ver", "pos as start", "1 as count")
    )
    return again.unionByName(late).groupBy("doc_id", "ver").agg(
        F.collect_list(F.struct("start", "count")).alias("repeats"))


_DIGEST = "doc_id long, ver int, n_words long, n_removed long, kept_sha256 string"


def spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, ver, first_word, n_words): the maximal repeated spans of every document."""
    runs = F.array_sort("repeats")
    none = F.expr("cast(array() as array<struct<first_word:int,n_words:int>>)")
    last = lambda done: F.element_at(done, -1)
    end = lambda done: last(done).first_word + last(done).n_words

    def add(done, run):
        stop = run["start"] + run["count"] + F.lit(length - 1)
        grown = F.struct(last(done).first_word.alias("first_word"),
                         (F.greatest(stop, end(done)) - last(done).first_word).alias("n_words"))
        fresh = F.struct(run["start"].alias("first_word"), (stop - run["start"]).alias("n_words"))
        return F.when(
            (F.size(done) > 0) & (end(done) >= run["start"]),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown)),
        ).otherwise(F.concat(done, F.array(fresh)))

    return repeats(docs, length, seed).select("doc_id", "ver", F.inline(F.aggregate(runs, none, add)))


def removal(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    none = F.expr("cast(array() as array<struct<start:int,count:int>>)")
    plain = _keyed(docs).withColumn("repeats", none).mapInArrow(_removal(length), _DIGEST)
    cut = (
        _keyed(docs).join(repeats(docs, length, seed), ["doc_id", "ver"])
        .dropDuplicates(["doc_id", "ver"]).mapInArrow(_removal(length), _DIGEST)
        .select("doc_id", "ver", F.col("n_removed").alias("lost"), F.col("kept_sha256").alias("kept"))
    )
    return plain.join(cut, ["doc_id", "ver"], "left").select(
        "doc_id", "n_words", F.coalesce("lost", "n_removed").alias("n_removed"),
        F.coalesce("kept", "kept_sha256").alias("kept_sha256"))


def _cut_rows(names: list[str], length: int):
    """Rows of a documents table, and `repeats` after them: texts without their repeats, n_chars following."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_at = names.index("text")
        for batch in W.portions(batches, f"c{text_at}"):
            out = [batch.column(i) for i in range(len(names))]
            repeats = batch.column(len(names))
            some = np.flatnonzero(repeats.is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                part = batch.take(pa.array(some))
                words = W.split(part.column(text_at), W.SPACE, False)
                keep = _kept(words, part.column(len(names)), length)
                text, size = out[text_at].to_pylist(), None
                for k, i in enumerate(some):
                    text[i] = _rest(words, keep, k)
                out[text_at] = pa.array(text, out[text_at].type)
                if "n_chars" in names:
                    at = names.index("n_chars")
                    size = out[at].to_pylist()
                    for i in some:
                        size[i] = len(text[i])
                    out[at] = pa.array(size, out[at].type)
            yield pa.RecordBatch.from_arrays(out, names)
    return rows


def without_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """docs, with repeated words cut out of text and n_chars following; texts without repeats stay as they are.

    Texts meet their repeats in one join; the columns go through it by place, so their names do not matter.
    """
    found = repeats(docs, length, seed).select(
        F.col("doc_id").alias("cut_id"), F.col("ver").alias("cut_ver"), "repeats")
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    key, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    joined = own.join(
        found, (key == F.col("cut_id")) & (_version(F.coalesce(text, F.lit(""))) == F.col("cut_ver")), "left")
    return joined.select(*own.columns, "repeats").mapInArrow(_cut_rows(docs.columns, length), docs.schema)
