"""Word boundaries and word hashes of whole Arrow columns in numpy, without a loop over rows.

A column's bytes are handled in small pieces that end between words, so memory follows
the words found and not the piece size, however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PIECE = 1 << 18
_PORTION = 1 << 21
_BASE = 0x9E3779B97F4A7C15 | 1
_ALL = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _ALL, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base and of its inverse, grown when a single word is longer than a piece."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


_TABLES = _Tables()


def separators(kind: str) -> np.ndarray:
    """Which bytes end a word. space: the six white-space bytes; alnum: all ASCII but letters and digits."""
    out = np.zeros(256, bool)
    if kind == "space":
        out[[0x20, *range(0x09, 0x0E)]] = True
    else:
        out[:128] = True
        for first, last in (("0", "9"), ("A", "Z"), ("a", "z")):
            out[ord(first):ord(last) + 1] = False
    return out


SPACE, ALNUM = separators("space"), separators("alnum")
_KEEP = np.arange(256, dtype=np.uint8)
LOWER = _KEEP.copy()
LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Words:
    """The words of a column: bytes [start, end) of data, hash, and per row its first word (one entry more)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def span(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def column(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the rows' offsets in them."""
    if values.null_count:
        values = pc.fill_null(values, "")
    values = values.cast(pa.large_string())
    if len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def portions(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about _PORTION text bytes each, at least a row: bounds a worker's arrays."""
    for batch in batches:
        _, offsets = column(batch.column(name))
        at, n = 0, len(batch)
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _PORTION)))
            yield batch.slice(at, to - at)
            at = to


def _pieces(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the bytes between words; ends marks the bytes after which a word cannot go on."""
    at, n = 0, len(data)
    while at < n:
        to, step = min(at + _PIECE, n), _PIECE
        while to < n:
            stop = np.flatnonzero(ends[to - 1:to - 1 + step])
            if len(stop):
                to += int(stop[0])
                break
            to, step = min(to + step, n), step * 2
        yield at, to
        at = to


def split(values: pa.Array, sep: np.ndarray, lower: bool) -> Words:
    """The words of every row; hashes are equal when the (lower-cased) bytes are."""
    raw, offsets = column(values)
    n = len(raw)
    fold = LOWER if lower else _KEEP
    data = fold[raw] if lower else raw
    gap = sep[data] if n else np.zeros(0, bool)
    stop = gap.copy()  # after this byte no word goes on
    inner = offsets[1:-1]
    stop[inner[inner > 0] - 1] = True
    starts, ends, hashes = [], [], []
    for a, b in _pieces(data, stop):
        word = ~gap[a:b]
        begin, finish = word.copy(), word.copy()
        begin[1:] &= stop[a:b - 1]
        finish[:-1] &= stop[a:b - 1] | gap[a + 1:b]
        s, e = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        up, down = _TABLES.get(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:b]] * up[:b - a], out=sums[1:])
        starts.append(s + a)
        ends.append(e + a)
        hashes.append(mix((sums[e] - sums[s]) * down[s]))
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    value = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, value, first)


def grams(hashes: np.ndarray, k: int, salt: int = 1) -> np.ndarray:
    """A hash of each k consecutive word hashes, rows not minded; shorter by k - 1 than its input."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = np.uint64((_BASE * (2 * salt + 1)) & _ALL | 1)
    item = mix(hashes + np.uint64(salt))
    out = item[:n].copy()
    for j in range(1, k):
        out *= base
        out += item[j:j + n]
    return mix(out)


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """The words of the rows at which k consecutive words begin."""
    length = np.diff(first)
    count = np.maximum(length - k + 1, 0)
    total = int(count.sum())
    before = np.cumsum(count) - count
    return np.arange(total) - np.repeat(before, count) + np.repeat(first[:-1], count)


def joined(words: Words, keep: np.ndarray | None, i: int) -> bytes:
    """Words of row i, those kept, joined by one space."""
    own = words.span(i)
    start, end = words.start[own], words.end[own]
    if keep is not None:
        start, end = start[keep[own]], end[keep[own]]
    if not len(start):
        return b""
    length = end - start
    place = np.cumsum(length + 1) - length - 1
    total = int(place[-1] + length[-1])
    gap = np.repeat(start - place, length + 1)[:total]
    out = words.data[np.minimum(np.arange(total) + gap, len(words.data) - 1)]
    out[place[1:] - 1] = 0x20
    return out.tobytes()
