"""Encoding texts with a public BPE vocabulary by dynamic programming, and decoding them.

For every prefix of a word exactly one token can be the last of its encoding. An automaton over the
vocabulary yields the tokens that end at each place; the token that fits the last token of the prefix before
it is stored; following the stored tokens back from the end gives the ids. Two tokens fit when merging in
rank order would never join a piece of the one with a piece of the other.

Words are encoded once per worker as long as they stay in its table of bounded size. Texts stay in their
rows; there is no shuffle.

Defined results: null is the empty text, which has no ids; the two control strings of the vocabulary are
taken as control tokens wherever they stand, as the public library does; repeated rows give repeated results;
extra columns are not read; texts of any length are encoded whole. Characters newer than Unicode 16 may be split
otherwise than by the library, whose tables are of that version.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from routeledger.llm import shared, words as W

#: What a word may be, by the vocabulary's own splitting rule (fixed values).
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_BLANKS = regex.compile(r"\p{White_Space}+")
_NOT_BLANK = regex.compile("[\x1c-\x1f]")  # str.split() takes these as blanks
_NEWER = "\U000323b0"
_TABLE = 150_000
_LONGEST_KEPT = 48


def _byte_letters() -> list[str]:
    """The visible character that stands for each byte: itself where printable in Latin-1, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in plain)}
    return [chr(rest.get(b, b)) for b in range(256)]


class Vocabulary:
    """A BPE vocabulary with word ends, from the JSON text of a tokenizer file."""

    def __init__(self, source: str) -> None:
        content = json.loads(source)
        model = content["model"]
        self.suffix = model["end_of_word_suffix"]
        self.control = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.text = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.control.items()}
        self.controls = regex.compile("(" + "|".join(map(regex.escape, self.control)) + ")")
        ids = model["vocab"]
        letters = _byte_letters()
        self.letter = [ids[x] for x in letters]
        self.last_letter = [ids[x + self.suffix] for x in letters]
        self.rank, self.halves, self.merged = {}, {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            token, pair = ids[a + b], (ids[a], ids[b])
            self.rank[token], self.halves[token], self.merged[pair] = rank, pair, rank
        self._automaton()
        self.fits: dict[int, bool] = {}
        # words and pieces met lately, and those met before the table was last full
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _symbols(self, token: int) -> list[int]:
        """The single letters of a token."""
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if t in self.halves:
                todo.extend(reversed(self.halves[t]))
            else:
                out.append(t)
        return out

    def _automaton(self) -> None:
        """next: state and letter to state; ends: the tokens that end in a state, as (length, token)."""
        self.next: list[dict[int, int]] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for token in {*self.letter, *self.last_letter, *self.rank}:
            state, symbols = 0, self._symbols(token)
            for x in symbols:
                state = self.next[state].setdefault(x, len(self.next))
                if state == len(self.next):
                    self.next.append({})
                    own.append(None)
            own[state] = (len(symbols), token)
        self.back = [0] * len(self.next)
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        queue = [(x, s, 0) for x, s in self.next[0].items()]
        for x, state, parent in queue:
            if parent or state not in self.next[0].values():
                at = self.back[parent]
                while at and x not in self.next[at]:
                    at = self.back[at]
                target = self.next[at].get(x, 0)
                self.back[state] = target if target != state else 0
            shorter = self.ends[self.back[state]]
            self.ends[state] = (own[state], *shorter) if own[state] else shorter
            queue.extend((y, s, state) for y, s in self.next[state].items())

    def fit(self, left: int, right: int) -> bool:
        """Whether the two tokens can follow each other: going back in time, no merge joins them across."""
        a, b, a_until, b_until = left, right, 1 << 60, 1 << 60
        rank, ok = self.rank, True
        while True:
            joined = self.merged.get((a, b))
            # of equal merges the left one comes first: before a's own use of its part, not before b's
            if joined is not None and joined < a_until and joined <= b_until:
                ok = False
                break
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                a_until, a = ra, self.halves[a][1]
            else:
                b_until, b = rb, self.halves[b][0]
        if len(self.fits) > 4 * _TABLE:
            self.fits.clear()
        self.fits[left << 20 | right] = ok
        return ok

    def _step(self, state: int, symbol: int) -> int:
        """The state after a symbol that a state does not name: that of its longest suffix; named from then on."""
        at = state
        while at and symbol not in self.next[at]:
            at = self.back[at]
        to = self.next[at].get(symbol, 0)
        self.next[state][symbol] = to
        return to

    def piece(self, piece: str) -> list[int]:
        """The ids of one word."""
        data = piece.encode()
        letter = self.letter
        symbols = [letter[x] for x in data]
        symbols[-1] = self.last_letter[data[-1]]
        steps, ends, fits = self.next, self.ends, self.fits
        last, size = [0] * (len(symbols) + 1), [0] * (len(symbols) + 1)
        state = i = 0
        for x in symbols:
            i += 1
            to = steps[state].get(x)
            state = self._step(state, x) if to is None else to
            for length, token in ends[state]:
                if length < i:
                    before = last[i - length]
                    ok = fits.get(before << 20 | token)
                    if ok is None:
                        ok = self.fit(before, token)
                    if not ok:
                        continue
                last[i], size[i] = token, length
                break
        out = []
        while i:
            out.append(last[i])
            i -= size[i]
        out.reverse()
        return out

    def _kept(self, word: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(word) <= _LONGEST_KEPT:
            if len(self.words) > _TABLE:
                self.older, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.words.get(piece) or self.older.get(piece)
        return ids if ids is not None else self._kept(piece, tuple(self.piece(piece)))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        ids = self.older.get(chunk)
        if ids is not None:
            return self._kept(chunk, ids)
        shape = chunk
        if chunk.isascii():
            if chunk.isalpha():
                return self._kept(chunk, tuple(self.piece(chunk)))
        else:  # the public library's character tables end before this code point
            shape = "".join("\ue000" if _NEWER <= c < "\U000e0000" else c for c in chunk)
        pieces = [chunk[m.start():m.end()] for m in _PIECES.finditer(shape)]
        if len(pieces) == 1 and pieces[0] == chunk:
            return self._kept(chunk, tuple(self.piece(chunk)))
        return self._kept(chunk, tuple(chain.from_iterable(map(self._piece, pieces))))

    def _plain(self, text: str) -> Iterator[tuple[int, ...]]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower-cased letter by letter
        text = text.lower()
        chunks = _BLANKS.split(text) if _NOT_BLANK.search(text) else text.split()
        known = self.words
        for chunk in chunks:
            ids = known.get(chunk)
            yield ids if ids is not None else self._chunk(chunk)

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        if not any(c in text for c in self.control):
            return list(chain.from_iterable(self._plain(text)))
        out: list[int] = []
        for part in self.controls.split(text):
            out.extend([self.control[part]] if part in self.control else chain.from_iterable(self._plain(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens' own strings, joined by spaces: this vocabulary file names no other decoder."""
        return " ".join(map(self.text.__getitem__, ids))


_LOADED: dict[int, Vocabulary] = {}


def vocabulary(source: str) -> Vocabulary:
    """The vocabulary of a file's text, built once per process."""
    key = hash(source)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(source)
    return _LOADED[key]


def _rows(source, real: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(source.value)
        number = {i: str(i) for i in known.text}
        for batch in W.portions(batches):
            n, ids_hash, decoded_hash, lists, decoded_texts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = known.encode(text)
                decoded = known.decode(ids)
                n.append(len(ids))
                if real:
                    lists.append(ids)
                    decoded_texts.append(decoded)
                else:
                    ids_hash.append(hashlib.sha256(" ".join(map(number.__getitem__, ids)).encode()).hexdigest())
                    decoded_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
            more = ([pa.array(lists, pa.list_(pa.int32())), pa.array(decoded_texts, pa.string())] if real
                    else [pa.array(ids_hash, pa.string()), pa.array(decoded_hash, pa.string())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), *more],
                ["doc_id", "n_tokens", *(("ids", "decoded") if real else ("ids_sha256", "decoded_sha256"))])
    return rows


def _encoded(docs: DataFrame, path: str, real: bool, schema: str) -> DataFrame:
    with open(path, encoding="utf-8") as file:  # a public vocabulary of about 2 MB, on the driver's disk
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    return shared.texts(docs).mapInArrow(_rows(source, real), schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, decoded."""
    return _encoded(docs, path, True, "doc_id long, n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by spaces), decoded_sha256."""
    return _encoded(docs, path, False,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
