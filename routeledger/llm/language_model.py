"""A hierarchical Pitman-Yor language model: word pairs over words over letters, their tables drawn.

Restaurants: one for every word as context, whose dishes are the words that follow it (the end of a text stands
before its first word); they share one for words, whose dishes are drawn from a spelling model; the spelling model
draws each letter (byte, or the word's end) of a word in the restaurant of its two letters before. Letter
restaurants share parents: the two-letter contexts that end in one letter share that letter's restaurant, and these
share the root over a uniform base. Tables of a restaurant are the customers of its parent.

Sweeps are drawn, each from the pairs down: the tables of every pair, given the tables of its context and the words'
probabilities of the sweep before (at first the tables that a context of its size has on average, and the words'
shares); then, given all customers that these make, the number of tables of every word (Chinese-restaurant seating:
exact from its distribution for up to 256 customers, block by block beyond), and then of every letter. All pairs and
words are drawn at once, in tasks; the letters' counts, at most 258 x 258 x 257 whatever the corpus, are drawn on the
driver. The first sweeps are dropped; probabilities are averaged over the rest. Draws follow from hashes and counts
alone, so that a task that runs again, and every group that holds a pair, draws the same.

A word that no training document holds is the one unknown word, with the probability of all unseen spellings.

Counts go between groups of documents (about GROUP bytes of text each) and buckets of hashes, as many as groups. A
group and a bucket share one row, its words or pairs in the order of their hashes; answers come in the same order
without naming them. Pairs go once: the sums of their tables are made in the first group that trains on the pair. A
pair met once has one table whatever is drawn, so that a sweep draws the repeated pairs only, and only their words'
numbers go between groups and buckets; what groups and buckets keep lies bucketed by them and does not move. For the
scores every group draws the tables of its pairs again, from the same numbers.

Defined results: null and empty texts are one end token; a corpus without training documents has no counts, and
all its probability is the spelling model's; repeated rows count each; rows without doc_id are left out; extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared, words as W

SWEEPS, KEPT = 4, 2
STRENGTH, PAIR_STRENGTH = 10.0, 2.0
_EXACT = 256
#: weights of tables that are compared at once
_CELLS = 1 << 17
GROUP = 16 << 20
#: pairs whose tables and scores are worked out at once
_SLICE = 1 << 18
#: letters: bytes, END of a word, and START before it (as context only)
_END, _START = 256, 257
_LETTERS, _CONTEXTS = 257, 258
_LETTER_DISCOUNT, _LETTER_STRENGTH = 0.5, 1.0


# --- seating -------------------------------------------------------------------------------------------------

def _log_ways(discount: float) -> np.ndarray:
    """log of the number of ways (generalised Stirling numbers) to seat c customers at t tables."""
    out = np.full((_EXACT + 1, _EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(_EXACT + 1)
    for c in range(1, _EXACT):
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + out[c]
        stay[t > c] = -np.inf
        fresh = np.concatenate([[-np.inf], out[c][:-1]])
        out[c + 1] = np.logaddexp(stay, fresh)
    return out


_WAYS: dict[float, np.ndarray] = {}


def _poisson(mean: np.ndarray, key: np.ndarray, block: int) -> np.ndarray:
    """Poisson draws that follow from the keys: by inversion up to a mean of 50, by a rounded normal beyond."""
    one, two = ((W.mix(key ^ W.mix(np.full(1, 2 * block + i, np.uint64))) >> np.uint64(11)) * 2.0**-53 for i in (0, 1))
    normal = np.sqrt(-2 * np.log(1 - one)) * np.cos(2 * np.pi * two)
    out = np.maximum(np.rint(mean + np.sqrt(mean) * normal), 0).astype(np.int64)
    small = np.flatnonzero(mean <= 50)
    if len(small):
        m, left = mean[small], one[small].copy()
        p, k = np.exp(-m), np.zeros(len(small), np.int64)
        for i in range(1, 200):
            more = left >= p
            if not more.any():
                break
            left -= np.where(more, p, 0.0)
            k += more
            p = np.where(more, p * m / i, 2.0)
        out[small] = k
    return out


def tables(customers: np.ndarray, pull: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """A draw of the tables of each dish: pull is (strength + discount * all tables) * the dish's base probability."""
    return np.concatenate([
        _tables(customers[lo:lo + _SLICE], pull[lo:lo + _SLICE], discount, key[lo:lo + _SLICE], sweep)
        for lo in range(0, max(len(customers), 1), _SLICE)])


def _tables(customers: np.ndarray, pull: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    if discount not in _WAYS:
        _WAYS[discount] = _log_ways(discount)
    ways = _WAYS[discount]
    out = np.minimum(customers, 1).astype(np.int64)
    salt = np.uint64((sweep + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    draw = (W.mix(key + salt) >> np.uint64(11)) * 2.0**-53
    pull = np.maximum(pull, 1e-300)
    begin = np.minimum(customers, _EXACT)
    order = np.argsort(begin.astype(np.uint16), kind="stable")
    bounds = np.searchsorted(begin[order], np.arange(2, _EXACT + 2))
    for c, a, b in zip(range(2, _EXACT + 1), bounds[:-1], bounds[1:]):
        step = max(_CELLS // c, 1)
        for lo in range(a, b, step):
            own = order[lo:min(lo + step, b)]
            t = np.arange(1, c + 1)
            weight = ways[c, 1:c + 1][None, :] + t[None, :] * np.log(pull[own])[:, None]
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            out[own] = 1 + (weight < draw[own][:, None] * weight[:, -1:]).sum(axis=1)
    many = np.flatnonzero(customers > _EXACT)
    if len(many):
        seated, block = np.full(len(many), float(_EXACT)), 0
        while (seated < customers[many]).any():
            until = np.minimum(2 * seated, customers[many])
            busy, a = seated - discount * out[many], pull[many]
            block += 1
            out[many] += _poisson(a * np.log1p((until - seated) / (busy + a)), key[many] + salt, block)
            out[many] = np.minimum(out[many], until.astype(np.int64))
            seated = until
    return out


# --- spelling ------------------------------------------------------------------------------------------------

@dataclass
class Letters:
    """The spelling model: probabilities by (two letters before, letter) as seen part, weight and parent."""

    code: np.ndarray  # seen (context, letter) codes in order
    seen: np.ndarray  # their own probability
    rest: np.ndarray  # by context: the weight of the parent
    parent: np.ndarray  # by last letter and letter

    def log(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        own = np.where(self.code[at] == code, self.seen[at], 0.0)
        context, letter = code // _LETTERS, code % _LETTERS
        return np.log(own + self.rest[context] * self.parent[context % _CONTEXTS, letter])


def _predict(customers: np.ndarray, seats: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Probabilities of restaurants (rows) over dishes from their customers and tables."""
    d, s = _LETTER_DISCOUNT, _LETTER_STRENGTH
    total = customers.sum(axis=-1, keepdims=True)
    return (np.maximum(customers - d * seats, 0) + (s + d * seats.sum(axis=-1, keepdims=True)) * parent) / (s + total)


def _spelling(code: np.ndarray, n: np.ndarray, sweep: int, rounds: int = 3) -> Letters:
    """Letters from the counts of codes: seats drawn from the two-letter contexts down to the root, a few rounds."""
    order = np.argsort(code)
    code, n = code[order], n[order].astype(np.int64)
    context, letter = code // _LETTERS, code % _LETTERS
    last = context % _CONTEXTS
    seats = np.minimum(n, 1)
    base = np.full(_LETTERS, 1 / _LETTERS)
    d, s = _LETTER_DISCOUNT, _LETTER_STRENGTH
    key, flat = W.mix(code.astype(np.uint64)), np.arange(_CONTEXTS * _LETTERS, dtype=np.uint64)
    for r in range(rounds):
        step = sweep * rounds + r
        mid = np.bincount(last * _LETTERS + letter, seats, _CONTEXTS * _LETTERS).reshape(_CONTEXTS, _LETTERS)
        mid_seats = np.minimum(mid, 1) if r == 0 else mid_seats
        for _ in range(2):
            top = mid_seats.sum(axis=0)
            top_seats = tables(top.astype(np.int64), (s + d * (top > 0).sum()) * base, d, W.mix(flat[:_LETTERS]), step)
            root = _predict(top, top_seats, base)
            pull = (s + d * mid_seats.sum(axis=1, keepdims=True)) * root[None, :]
            mid_seats = tables(mid.ravel().astype(np.int64), pull.ravel(), d, W.mix(flat + np.uint64(1 << 20)), step
                               ).reshape(mid.shape).astype(float)
        top = mid_seats.sum(axis=0)
        root = _predict(top, np.minimum(top_seats, top), base)
        parent = _predict(mid, mid_seats, root)
        all_seats = np.bincount(context, seats, _CONTEXTS * _CONTEXTS)
        seats = tables(n, (s + d * all_seats[context]) * parent[last, letter], d, key, step)
    total, all_seats = (np.bincount(context, x, _CONTEXTS * _CONTEXTS) for x in (n, seats))
    return Letters(code, np.maximum(n - d * seats, 0) / (s + total[context]), (s + d * all_seats) / (s + total), parent)


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (context, letter) codes of the words' letters and ends, and where each word's begin."""
    raw, at = W.column(words)
    size = np.diff(at)
    first = np.concatenate([[0], np.cumsum(size + 1)])
    letter = np.full(first[-1], _END, np.int64)
    spot = np.arange(len(raw)) + np.repeat(np.arange(len(size)), size)
    letter[spot] = raw
    before = np.concatenate([[_START], letter[:-1]])
    before[first[:-1]] = _START
    older = np.concatenate([[_START], before[:-1]])
    older[first[:-1]] = _START
    return (older * _CONTEXTS + before) * _LETTERS + letter, first


# --- the word table ------------------------------------------------------------------------------------------

@dataclass
class Sweep:
    """A seating of the word restaurant: its tables, the base probability of all training words, and the spelling after it."""

    all_tables: float
    known: float
    letters: Letters


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of (word, n) with their codes, where each word's begin, and hashes."""
    for whole in batches:
        for at in range(0, len(whole), 20_000):
            batch = whole.slice(at, 20_000)
            code, first = _codes(batch.column("word"))
            power = W.mix((code + 1).astype(np.uint64) + (np.arange(len(code)) - np.repeat(
                first[:-1], np.diff(first))).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            key = np.add.reduceat(power, first[:-1]) if len(batch) else np.zeros(0, np.uint64)
            yield batch, code, first, key


def _log_base(letters: Letters, code: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(letters.log(code), first[:-1]) if len(first) > 1 else np.zeros(0)


def _seats(n: np.ndarray, base: np.ndarray, start: Sweep, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    return tables(n, (STRENGTH + discount * start.all_tables) * np.exp(base), discount, key, sweep)


def _sweep_rows(start, discount: float, sweep: int):
    """Counts of letters in the words' tables (start: none for one table each), by code; -1: tables, -2: known."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, float] = {-1: 0.0, -2: 0.0}
        for batch, code, first, key in _word_rows(_plain(batches)):
            n = batch.column("n").to_numpy()
            if start is None:
                t = np.minimum(n, 1)
            else:
                base = _log_base(start.value.letters, code, first)
                t = _seats(n, base, start.value, discount, key, sweep)
                total[-2] += float(np.exp(base[n > 0]).sum())
            some, place = np.unique(code, return_inverse=True)
            for c, m in zip(some.tolist(), np.bincount(place, np.repeat(t, np.diff(first))).tolist()):
                if m:
                    total[c] = total.get(c, 0.0) + m
            total[-1] += float(t.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.float64())], ["code", "n"])
    return rows


def _probabilities(words: Iterator[pa.RecordBatch], seatings, discount: float, n_tokens: int
                   ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(word, n) with log10 of its probability averaged over the kept sweeps, and with unknown words spelled out."""
    for batch, code, first, key in _word_rows(words):
        n = batch.column("n").to_numpy()
        total, spelled = np.zeros(len(n)), np.zeros(len(n))
        for before, after, sweep in seatings:
            base = _log_base(before.letters, code, first)
            t = _seats(n, base, before, discount, key, sweep)
            fresh = (STRENGTH + discount * after.all_tables) * np.exp(base)
            spelled += np.maximum(n - discount * t, 0) + fresh
            total += np.where(n > 0, np.maximum(n - discount * t, 0) + fresh,
                              (STRENGTH + discount * after.all_tables) * max(1 - after.known, 1e-12))
        yield batch, *(np.log10(np.maximum(x / len(seatings) / (STRENGTH + n_tokens), 1e-300)) for x in (total, spelled))


def _probability_rows(seatings, discount: float, n_tokens: int):
    """word, n, log10 of its probability averaged over the kept sweeps, and the same with unknown words spelled out."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, logp, spelled in _probabilities(batches, seatings.value, discount, n_tokens):
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(logp), pa.array(spelled)],
                                             ["word", "n", "logp", "spelled"])
    return rows


def _state(words: DataFrame, start, discount: float, sweep: int) -> Sweep:
    counts = words.mapInArrow(_sweep_rows(start, discount, sweep), "code long, n double").groupBy("code").agg(
        F.sum("n").alias("n")).toPandas()
    code, n = counts["code"].to_numpy(np.int64), counts["n"].to_numpy()
    about = {c: float(n[code == c].sum()) for c in (-1, -2)}
    code, n = code[code >= 0], n[code >= 0]
    if not len(code):  # no training word: only the end of an empty word, once
        code, n = np.array([(_START * _CONTEXTS + _START) * _LETTERS + _END]), np.array([1.0])
    return Sweep(about[-1], about[-2], _spelling(code, n, sweep))


def _swept(words: DataFrame, once: int, twice: int):
    """The kept sweeps (broadcast) and the discount of a landed table of words, plain or in buckets."""
    context = words.sparkSession.sparkContext
    discount = _discount(once, twice)
    now, kept = _state(words, None, discount, 0), []
    for sweep in range(1, SWEEPS + 1):
        after = _state(words, context.broadcast(now), discount, sweep)
        if sweep > SWEEPS - KEPT:
            kept.append((now, after, sweep))
        now = after
    return context.broadcast(kept), discount


def _discount(once: int, twice: int) -> float:
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5


def word_probabilities(words: DataFrame, n_tokens: int) -> DataFrame:
    """(word, n, logp, spelled) of a landed table (word, n): averaged predictive probabilities as log10.

    A word without training count is the unknown word in logp; in spelled it is drawn letter by letter.
    """
    kept, discount = _swept(words, *words.selectExpr("count_if(n = 1)", "count_if(n = 2)").first())
    return words.mapInArrow(
        _probability_rows(kept, discount, n_tokens), "word string, n long, logp double, spelled double")


# --- groups and buckets --------------------------------------------------------------------------------------

_GROUP = "part long, doc_id array<long>, held array<boolean>, size array<int>, token binary, words string"
_SENT = "bucket long, part long, words string, pairs binary, n binary"
#: a, b: trained tokens and words of a bucket of words, pairs met once and twice of a bucket of pairs
_COUNTED = "bucket long, part long, words string, n binary, other binary, a long, b long"
#: n, other: a group's sums of tables by second and by first word over its pairs met once; new_n, new_other: over its
#: repeated pairs, for the words of these only, at some; with bucket -1 the repeated pairs: counts, first and second words, keys
_DRAWN = "part long, bucket long, n binary, other binary, some binary, new_n binary, new_other binary, keys binary"
_REDRAWN = "part long, bucket long, n binary, other binary"
#: fixed, fixed_tables: customers and tables as context that no sweep redraws; n, tables: all of them
_SEATED = ("bucket long, words string, count binary, fixed binary, fixed_tables binary, parts array<long>, codes array<binary>, "
           "some array<binary>, n binary, tables binary, once long, twice long, total long")
_RESEATED = "bucket long, n binary, tables binary, total long"
#: with bucket -1 counts of pairs and their tables, where these are known
_ANSWER = "part long, bucket long, n binary, other binary, logp binary, unknown double, sweep long"


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """A batch of a schema's columns from tuples that may end early."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<boolean>": pa.list_(pa.bool_()), "array<binary>": pa.list_(pa.binary())}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] if i < len(r) else None for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
        [c for c, _ in fields])


def _pack(x: np.ndarray) -> bytes:
    """Numbers from 0 in the fewest whole bytes that hold the largest, after a byte that tells how many.

    All lowest bytes stand first, then the next ones: the higher ones are mostly alike and compress.
    """
    width = max((int(x.max()).bit_length() + 7) // 8, 1) if len(x) else 1
    return bytes([width]) + x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _longs(data: bytes) -> np.ndarray:
    return _unpack(data).astype(np.int64)


def _cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of ascending hashes begins (one entry more)."""
    return np.searchsorted((hashes >> np.uint64(40)).astype(np.int64) * buckets >> 24, np.arange(buckets + 1))


def _strings(words: W.Words, index: np.ndarray) -> pa.Array:
    """The words at the given places as a string column."""
    start, size = words.start[index], words.end[index] - words.start[index]
    at = np.concatenate([[0], np.cumsum(size)])
    data = words.data[np.arange(at[-1]) + np.repeat(start - at[:-1], size)]
    return pa.StringArray.from_buffers(len(index), pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))


def _joined(words: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()


def _group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for about GROUP bytes of text: its words by hash, and its documents' tokens in order as places of words.

    The end of a text is the empty word, with hash 0 and place 0.
    """
    parts, size, number = [], 0, TaskContext.get().partitionId() << 24
    for batch in W.portions(batches):
        words = W.split(batch.column("text"), W.SPACE, True)
        token = np.zeros(len(words.hash) + len(batch), np.uint64)
        token[np.arange(len(words.hash)) + words.row()] = words.hash
        names, index = np.unique(words.hash, return_index=True)
        parts.append((batch.column("doc_id").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False),
                      np.diff(words.first) + 1, token, names, _strings(words, index)))
        size += len(words.data)
        if size >= GROUP:
            yield _group(parts, number)
            parts, size, number = [], 0, number + 1
    if parts:
        yield _group(parts, number)


def _group(parts: list, number: int) -> pa.RecordBatch:
    doc_id, held, size, token, names = (np.concatenate([p[i] for p in parts]) for i in range(5))
    names, index = np.unique(names, return_index=True)
    words = _joined(pa.concat_arrays([pa.array([""], pa.string()), pa.concat_arrays([p[5] for p in parts]).take(pa.array(index))]))
    place = np.searchsorted(np.concatenate([np.zeros(1, np.uint64), names]), token)
    return _rows(_GROUP, [(number, doc_id, held, size.astype(np.int32), _pack(place), words)])


@dataclass
class Group:
    """A group's tokens as places of its words, whether each trains, its different pairs by hash and each token's pair."""

    hash: np.ndarray
    token: np.ndarray
    trains: np.ndarray
    pair: np.ndarray  # hashes
    before: np.ndarray  # by pair: the place of its first word
    word: np.ndarray  # by pair: the place of its second word
    at: np.ndarray  # by token: its pair
    n: np.ndarray  # by pair: training tokens


def _opened(group: dict) -> Group:
    # a word more than the words of the text: the end, which stands before them all
    hashes = np.concatenate([np.zeros(1, np.uint64), W.split(pa.array([group["words"]]), W.SPACE, False).hash])
    token = _longs(group["token"]).astype(np.int32)
    before = np.append(np.int32(0), token[:-1])  # the token before a text is the end of another, or of none
    trains = np.repeat(~np.array(group["held"], bool), group["size"])
    after, both = W.mix(hashes + np.uint64(0x9E3779B97F4A7C15)), np.empty(len(token), np.uint64)
    for lo in range(0, len(token), _SLICE):
        both[lo:lo + _SLICE] = W.mix(after[before[lo:lo + _SLICE]] + hashes[token[lo:lo + _SLICE]])
    order = np.argsort(both)
    both = both[order]
    new = np.append(True, both[1:] != both[:-1])[:len(both)]
    pair, first, at = both[new], order[new], np.empty(len(both), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return Group(hashes, token, trains, pair, before[first], token[first], at, np.bincount(at[trains], minlength=len(pair)))


def _sent_rows(buckets: int):
    """A row per group and bucket: words with training counts in the first buckets, hashes of pairs in the others."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _each(batches):
            g = _opened(group)
            words = pc.list_flatten(pc.split_pattern(pa.array([group["words"]]), "\n"))
            n = np.bincount(g.token[g.trains], minlength=len(g.hash))
            cuts = _cuts(g.hash, buckets)
            for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                if y > x:
                    yield _rows(_SENT, [(b, group["part"], _joined(words.slice(x, y - x)), None, _pack(n[x:y]))])
            cuts = _cuts(g.pair, buckets)
            for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]), buckets):
                if y > x:
                    steps = np.diff(g.pair[x:y], prepend=np.uint64(0))
                    first, steps[0] = int(steps[0]), 0
                    yield _rows(_SENT, [(b, group["part"], None, first.to_bytes(8, "little") + _pack(steps), _pack(g.n[x:y]))])
    return rows


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0] if "doc_id" not in batch.schema.names else {
                c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) if c in ("doc_id", "held", "size")
                else batch.column(c)[i].as_py() for c in batch.schema.names}


def _count_rows(buckets: int):
    """The bucket's totals to every group in its own order; of words also themselves, once, with part -1."""
    def rows(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        bucket, parts = table.column("bucket")[0].as_py(), table.column("part").to_pylist()
        n = [_longs(x) for x in table.column("n").to_pylist()]
        cuts = np.cumsum([0] + [len(x) for x in n])
        n = np.concatenate(n)
        if bucket < buckets:
            words = pc.list_flatten(pc.split_pattern(table.column("words").combine_chunks(), "\n")).dictionary_encode()
            at = words.indices.to_numpy()
            total = np.bincount(at, n, len(words.dictionary)).astype(np.int64)
            other = at
            out = [(bucket, -1, _joined(words.dictionary), _pack(total), None, int(total.sum()), int((total > 0).sum()))]
        else:
            pair = np.concatenate([np.cumsum(_unpack(x[8:])) + np.uint64(int.from_bytes(x[:8], "little"))
                                   for x in table.column("pairs").to_pylist()])
            pair, at = np.unique(pair, return_inverse=True)
            total = np.bincount(at, n, len(pair)).astype(np.int64)
            # a pair is owned by the first group that trains on it
            trains = np.flatnonzero(n)
            other = np.zeros(len(n), np.int64)
            other[trains[np.unique(at[trains], return_index=True)[1]]] = 1
            out = [(bucket, -1, None, None, None, int((total == 1).sum()), int((total == 2).sum()))]
        out += [(bucket, p, None, _pack(total[at[x:y]]), _pack(other[x:y]), 0, 0)
                for p, x, y in zip(parts, cuts[:-1], cuts[1:])]
        return pa.Table.from_batches([_rows(_COUNTED, out)])
    return rows


def _average_tables(customers: np.ndarray, discount: float) -> np.ndarray:
    """About the expected number of tables in a restaurant of so many customers."""
    d, s = discount, PAIR_STRENGTH
    about = (s + customers) ** d * math.gamma(s + 1) / (d * math.gamma(s + d)) - s / d
    return np.clip(about, np.minimum(customers, 1), customers)


def _answers(table: pa.Table, name: str) -> np.ndarray:
    """A column of a group's answers, in the order of its buckets."""
    return np.concatenate([_longs(x) for x in table.column(name).to_pylist()])


def _keys(pair: np.ndarray) -> np.ndarray:
    """What draws of pairs follow from."""
    return pair >> np.uint64(32)


def _shares(seats: np.ndarray, share: np.ndarray, discount: float) -> np.ndarray:
    """The pull of pairs, given the tables of their first words as contexts and the shares of their second words."""
    return (PAIR_STRENGTH + discount * seats) * share


def _draw_rows(buckets: int, discount: float, n_tokens: int):
    """The first tables of the group's own pairs, per bucket of words, and its repeated pairs for the sweeps.

    A pair met once has one table whatever is drawn, so that only repeated pairs are drawn again.
    """
    def rows(group: pa.Table, back: pa.Table) -> pa.Table:
        group = next(_each(group.to_batches()))
        g, back = _opened(group), back.sort_by("bucket")
        count = _answers(back.filter(pc.less(back.column("bucket"), buckets)), "n")
        pairs = back.filter(pc.greater_equal(back.column("bucket"), buckets))
        c, own = _answers(pairs, "n"), _answers(pairs, "other")
        once, more = np.flatnonzero((own == 1) & (c == 1)), np.flatnonzero((own == 1) & (c > 1))
        fixed, fixed_seats = (np.bincount(x[once], minlength=len(g.hash)) for x in (g.word, g.before))
        c, before, word, key = c[more], g.before[more], g.word[more], _keys(g.pair[more])
        pull = _shares(_average_tables(count, discount)[before], count[word] / max(n_tokens, 1), discount)
        t = tables(c, pull, discount, key, 0)
        new, new_seats = (np.bincount(x, t, len(g.hash)).astype(np.int64) for x in (word, before))
        some = np.unique(np.concatenate([word, before]))
        cuts = _cuts(g.hash, buckets)
        out = []
        for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
            if y > x:
                at = some[np.searchsorted(some, x):np.searchsorted(some, y)]
                out.append((group["part"], b, _pack(fixed[x:y]), _pack(fixed_seats[x:y]), _pack(at - x), _pack(new[at]),
                            _pack(new_seats[at])))
        if len(more):
            out.append((group["part"], -1, _pack(c), _pack(np.searchsorted(some, before)), _pack(np.searchsorted(some, word)),
                        None, None, _pack(np.diff(key, prepend=np.uint64(0)))))
        return pa.Table.from_batches([_rows(_DRAWN, out)])
    return rows


def _redraw_rows(discount: float, sweep: int):
    """New tables of a group's repeated pairs, given the seating of the sweep before: their sums per bucket of words."""
    def rows(group: pa.Table, back: pa.Table) -> pa.Table:
        out = []
        back = back.sort_by("bucket")
        for g in group.to_pylist():
            c, before, word = _longs(g["n"]), _longs(g["other"]), _longs(g["some"])
            seats = [_longs(x) for x in back.column("other").to_pylist()]
            logp = np.concatenate([_reals(x, len(s)) for x, s in zip(back.column("logp").to_pylist(), seats)])
            cuts = np.cumsum([0] + [len(x) for x in seats])
            pull = _shares(np.concatenate(seats)[before], 10 ** logp[word], discount)
            t = tables(c, pull, discount, np.cumsum(_unpack(g["keys"]), dtype=np.uint64), sweep - 1)
            customers, all_seats = (np.bincount(x, t, cuts[-1]).astype(np.int64) for x in (word, before))
            out += [(g["part"], b, _pack(customers[x:y]), _pack(all_seats[x:y]))
                    for b, x, y in zip(back.column("bucket").to_pylist(), cuts[:-1], cuts[1:])]
        return pa.Table.from_batches([_rows(_REDRAWN, out)])
    return rows


def _seat_rows(counted: pa.Table, drawn: pa.Table) -> pa.Table:
    """One row per bucket of words: training tokens, customers (tables of their pairs), tables of their contexts."""
    counted, drawn = counted.sort_by("part").to_pylist(), drawn.sort_by("part").to_pylist()
    whole, counted = counted[0], counted[1:]
    count = _longs(whole["n"])
    fixed, fixed_seats, customers, seats = (np.zeros(len(count), np.int64) for _ in range(4))
    some = []
    for c, d in zip(counted, drawn, strict=True):
        at = _longs(c["other"])  # a group names a word once
        fixed[at] += _longs(d["n"])
        fixed_seats[at] += _longs(d["other"])
        at = at[_longs(d["some"])]
        customers[at] += _longs(d["new_n"])
        seats[at] += _longs(d["new_other"])
        some.append(_pack(at))
    customers, seats = customers + fixed, seats + fixed_seats
    return pa.Table.from_batches([_rows(_SEATED, [(
        whole["bucket"], whole["words"], _pack(count), _pack(fixed), _pack(fixed_seats), [c["part"] for c in counted],
        [c["other"] for c in counted], some, _pack(customers), _pack(seats),
        int((customers == 1).sum()), int((customers == 2).sum()), int(customers.sum()))])])


def _reseat_rows(seated: pa.Table, drawn: pa.Table) -> pa.Table:
    """Customers and tables as context of a bucket's words after a sweep has redrawn the repeated pairs."""
    out = []
    for whole in seated.to_pylist():
        customers, seats = _longs(whole["fixed"]), _longs(whole["fixed_tables"])
        at = dict(zip(whole["parts"], whole["some"]))
        for d in drawn.to_pylist():
            place = _longs(at[d["part"]])
            customers[place] += _longs(d["n"])
            seats[place] += _longs(d["other"])
        out.append((whole["bucket"], _pack(customers), _pack(seats), int(customers.sum())))
    return pa.Table.from_batches([_rows(_RESEATED, out)])


def _bucket_words(words: str, n: bytes) -> pa.RecordBatch:
    word = pc.list_flatten(pc.split_pattern(pa.array([words]), "\n"))
    return pa.RecordBatch.from_arrays([word, pa.array(_longs(n))], ["word", "n"])


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of plain rows or of buckets."""
    for batch in batches:
        if "word" in batch.schema.names:
            yield batch
        else:
            for words, n in zip(batch.column("words"), batch.column("n")):
                yield _bucket_words(words.as_py(), n.as_py())


def _reals(data: bytes, n: int) -> np.ndarray:
    """n numbers as they were sent, in four or eight bytes each."""
    return np.frombuffer(data, f"<f{len(data) // max(n, 1) or 8}").astype(float)


def _sent_logs(words: pa.RecordBatch, seating, discount: float, total: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the probabilities of words (spelled if unknown) after a sweep, as they are sent, and of an unknown word's."""
    parts = [(x[2], x[1]) for x in _probabilities(iter([words]), [seating], discount, total)]
    return tuple(np.concatenate([p[i] for p in parts] or [np.zeros(0)]).astype("<f4") for i in (0, 1))


def _share_rows(seating, discount: float, total: int):
    """To every group, for the words of its repeated pairs: tables as context, log10 of the probability."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _each(batches):
            codes = [_longs(x) for x in bucket["some"]]
            used = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]))
            words = _bucket_words(bucket["words"], bucket["n"]).take(pa.array(used))
            logp, seats = _sent_logs(words, seating.value, discount, total)[0], _longs(bucket["tables"])
            for part, at in zip(bucket["parts"], codes):
                if len(at):
                    yield _rows(_ANSWER, [(part, bucket["bucket"], None, _pack(seats[at]),
                                           logp[np.searchsorted(used, at)].tobytes())])
    return rows


def _answer_rows(seating, discount: float, total: int, sweep: int, last: bool):
    """To every group, in its order: tables as context, log10 of the probability (spelled if unknown); training tokens once."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = _bucket_words("", _pack(np.zeros(1, np.int64)))
        unknown = float(next(_probabilities(iter([empty]), [seating.value], discount, total))[1][0])
        for bucket in _each(batches):
            words = _bucket_words(bucket["words"], bucket["n"])
            logp, count, seats = _sent_logs(words, seating.value, discount, total)[0], _longs(bucket["count"]), _longs(bucket["tables"])
            for part, codes in zip(bucket["parts"], bucket["codes"]):
                at = _longs(codes)
                yield _rows(_ANSWER, [(part, bucket["bucket"], _pack(count[at]) if last else None, _pack(seats[at]),
                                       logp[at].tobytes(), unknown, sweep)])
    return rows


@dataclass
class Seating:
    """What a group knows of its words after a sweep: tables as context and log10 of probabilities, unknown ones spelled."""

    seats: np.ndarray
    spelled: np.ndarray
    unknown: float


def _seatings(back: pa.Table) -> tuple[np.ndarray, list[Seating]]:
    """Training tokens of a group's words, which the last sweep brings, and the seatings by sweep, oldest first."""
    sweeps = sorted(set(back.column("sweep").to_pylist()), key=lambda x: x or 0)
    n, out = np.zeros(0, np.int64), []
    for sweep in sweeps:
        own = back if len(sweeps) == 1 else back.filter(pc.equal(back.column("sweep"), sweep))
        seats = [_longs(x) for x in own.column("other").to_pylist()]
        spelled = [_reals(x, len(s)) for x, s in zip(own.column("logp").to_pylist(), seats)]
        out.append(Seating(np.concatenate(seats), np.concatenate(spelled), own.column("unknown")[0].as_py()))
        if sweep == sweeps[-1]:
            n = _answers(own, "n")
    return n, out


def _score_rows(n_tokens: int, n_words: int, discount: float):
    """Scores of a group's documents, averaged over the sweeps it is told of; tables that it is not told are drawn again,
    from the seating before, so that the oldest one is told for these draws only."""
    def rows(group: pa.Table, back: pa.Table) -> pa.Table:
        group = next(_each(group.to_batches()))
        g, back = _opened(group), back.sort_by("bucket")
        of_pairs = pc.is_null(back.column("logp"))
        pairs, (n, seatings) = back.filter(of_pairs), _seatings(back.filter(pc.invert(of_pairs)))
        c = _answers(pairs, "n")
        told = _answers(pairs, "other") if pairs.column("bucket")[0].as_py() < 0 else None
        steps = list(range(1, len(seatings))) if told is None else [0]
        # probabilities of words, with all unknown ones as one, and spelled
        shares = [(10 ** np.where(n > 0, x.spelled, x.unknown), 10 ** x.spelled) for x in seatings]
        score, exact = np.empty(len(c)), np.empty(len(c))
        for lo in range(0, len(c), _SLICE):
            own = slice(lo, lo + _SLICE)
            some, before, word = c[own], g.before[own], g.word[own]
            more, p = np.flatnonzero(some > 1), np.zeros((2, len(some)))
            for i, step in enumerate(steps):
                t = np.minimum(some, 1) if told is None else told[own]
                if told is None:
                    pull = _shares(seatings[step - 1].seats[before[more]], shares[step - 1][1][word[more]], discount)
                    t[more] = tables(some[more], pull, discount, _keys(g.pair[own][more]), SWEEPS - KEPT + i)
                seen, fresh = np.maximum(some - discount * t, 0), _shares(seatings[step].seats[before], 1.0, discount)
                for k in (0, 1):
                    p[k] += seen + fresh * shares[step][k][word]
            score[own], exact[own] = np.log10(np.maximum(p / len(steps) / (PAIR_STRENGTH + n[before]), 1e-300))
        size = group["size"].astype(np.int64)
        first = np.cumsum(size) - size
        total = lambda x: np.add.reduceat(x, first)
        return pa.table({
            "doc_id": group["doc_id"], "held_out": group["held"], "n_tokens": size,
            "n_known": total((n > 0).astype(np.int64)[g.token]), "train_tokens": np.full(len(size), n_tokens),
            "base_score": total(np.log10(n + 1.0)[g.token]) - size * np.log10(n_tokens + n_words + 1.0),
            "score": total(score[g.at]), "spelled_score": total(exact[g.at])})
    return rows


def scored(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, spelled_score.

    score is the log10 probability of the text, every token after the one before it, with all unknown words as one;
    spelled_score has each unknown word spelled out.
    """
    spark = docs.sparkSession
    rows = shared.texts(docs).withColumn(
        "held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    groups = shared.landed(rows.mapInArrow(_group_rows, _GROUP), "groups", "zstd")
    buckets = max(groups.count(), 1)
    tasks = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = shared.landed(groups.mapInArrow(_sent_rows(buckets), _SENT).groupBy("bucket").applyInArrow(
        _count_rows(buckets), _COUNTED), "counted", "zstd")
    of_words = counted.where(F.col("bucket") < buckets)
    n_tokens, n_words, once, twice = counted.agg(*[
        F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0))
        for side in (F.col("bucket") < buckets, F.col("bucket") >= buckets) for c in ("a", "b")]).first()
    discount = _discount(once, twice)
    back = counted.where(F.col("part") >= 0).select(
        "part", "bucket", "n", F.when(F.col("bucket") >= buckets, F.col("other")).alias("other"))
    drawn = shared.bucketed(groups.groupBy("part").cogroup(back.groupBy("part")).applyInArrow(
        _draw_rows(buckets, discount, n_tokens), _DRAWN), "drawn", "part", tasks)
    repeated = drawn.where(F.col("bucket") < 0).select("part", "n", "other", "some", "keys")
    seated = shared.bucketed(of_words.groupBy("bucket").cogroup(
        drawn.where(F.col("bucket") >= 0).groupBy("bucket")).applyInArrow(_seat_rows, _SEATED), "seated", "bucket", tasks)
    once, twice = seated.selectExpr(*[f"coalesce(sum({c}), 0)" for c in ("once", "twice")]).first()
    below, context = _discount(once, twice), spark.sparkContext

    now, words, told = None, seated, []
    for sweep in range(1, SWEEPS + 1):
        if sweep > 1:  # pairs first, from the seating before
            shares = words.mapInArrow(_share_rows(seating, below, total), _ANSWER)
            redrawn = repeated.groupBy("part").cogroup(shares.groupBy("part")).applyInArrow(
                _redraw_rows(discount, sweep), _REDRAWN)
            reseated = shared.landed(seated.select("bucket", "fixed", "fixed_tables", "parts", "some").groupBy("bucket").cogroup(
                redrawn.groupBy("bucket")).applyInArrow(_reseat_rows, _RESEATED), "reseated", "zstd")
            words = seated.drop("n", "tables", "total").join(reseated.hint("merge"), "bucket")
        if now is None:
            now = _state(words.select("words", "n"), None, below, 0)
        after = _state(words.select("words", "n"), context.broadcast(now), below, sweep)
        total = words.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"]
        seating = context.broadcast((now, after, sweep))
        if sweep >= SWEEPS - KEPT:
            told.append(words.mapInArrow(_answer_rows(seating, below, total, sweep, sweep == SWEEPS), _ANSWER))
        now = after
    answers = back.where(F.col("bucket") >= buckets).select("part", "bucket", "n")
    for some in told:
        answers = answers.unionByName(some, allowMissingColumns=True)
    return groups.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _score_rows(n_tokens, n_words, discount),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
        "spelled_score double")
