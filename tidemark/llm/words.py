"""Words of whole texts as 64-bit hashes, for many documents at once, in numpy.

A word's bytes are taken eight at a time and mixed into its hash one after the
other, all words side by side; words over LONG bytes, of which a text can hold
few, are hashed one by one. Sequences of words are hashed by pairing shorter
ones. Where equal hashes decide what is removed, `same` compares the bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of a word beyond which it is hashed by itself.
LONG = 64
#: Texts in a block, however short they are.
MOST_TEXTS = 8192
SPACES = bytes([0x20, *range(0x09, 0x0E)])
_U = np.uint64
_SEED = _U(0x9E3779B97F4A7C15)
#: By bytes that are left of a word: which of the eight count.
_MASKS = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence made of two: order matters."""
    with np.errstate(over="ignore"):
        return mix(left * _U(0xD6E8FEB86659FD93) + right + _U(0xA0761D6478BD642F))


def delimiter_table(delimiters: bytes = SPACES) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(delimiters)] = True
    return out


_SPACE_TABLE = delimiter_table()


class Words:
    """hashes: of all words; bounds[i]:bounds[i + 1]: those of text i; begins, ends: byte places in the joined texts."""

    __slots__ = ("begins", "bounds", "data", "ends", "hashes", "offsets")

    def __init__(self, texts: list[bytes], delimiters: np.ndarray = _SPACE_TABLE):
        self.data = b" ".join(texts) + b" " + bytes(8)  # eight bytes more, so that the last word can be read in eights
        gap = delimiters[np.frombuffer(self.data, np.uint8, len(self.data) - 8)]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(gap) and not gap[0]:
            edge = np.concatenate(([0], edge))
        self.begins, self.ends = edge[0::2], edge[1::2]
        self.hashes = self._hashed()
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.bounds = np.searchsorted(self.begins, self.offsets)

    def _eights(self, begins: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Eight bytes from each place, those past the word's end as 0."""
        each = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        return each[begins] & _MASKS[np.minimum(left, 8)]

    def _hashed(self) -> np.ndarray:
        lengths = self.ends - self.begins
        out = mix(lengths.astype(_U) + _SEED)
        at, step = np.flatnonzero(lengths <= LONG), 0
        while len(at):
            with np.errstate(over="ignore"):
                out[at] = mix((out[at] + _SEED) ^ self._eights(self.begins[at] + step, lengths[at] - step))
            step += 8
            at = at[lengths[at] > step]
        view = memoryview(self.data)
        for k in np.flatnonzero(lengths > LONG).tolist():
            out[k] = xxhash.xxh3_64_intdigest(view[self.begins[k] : self.ends[k]])
        return out

    def same(self, mine: np.ndarray, other: Words, its: np.ndarray) -> np.ndarray:
        """Whether words number mine[i] here and its[i] there have the same bytes."""
        lengths = self.ends[mine] - self.begins[mine]
        out = lengths == other.ends[its] - other.begins[its]
        at, step = np.flatnonzero(out & (lengths <= LONG)), 0
        while len(at):
            left = lengths[at] - step
            out[at] &= self._eights(self.begins[mine[at]] + step, left) == other._eights(other.begins[its[at]] + step, left)
            step += 8
            at = at[out[at] & (lengths[at] > step)]
        a, b = memoryview(self.data), memoryview(other.data)
        for k in np.flatnonzero(out & (lengths > LONG)).tolist():
            out[k] = a[self.begins[mine[k]] : self.ends[mine[k]]] == b[other.begins[its[k]] : other.ends[its[k]]]
        return out


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive items, one for each place that has k left in the array; texts are told apart by the caller."""
    n = len(hashes) - k + 1
    if n <= 0:
        return hashes[:0]
    out, covered, run, width, left = None, 0, hashes, 1, k
    while left:
        if left & 1:
            part = run[covered : covered + n]
            out, covered = part if out is None else pair(out, part), covered + width
        left >>= 1
        if left:
            run, width = pair(run[:-width], run[width:]), width * 2
    return out


def window_places(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first words of windows that stay in one text, and the texts' numbers."""
    lengths = np.diff(bounds)
    text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    places = np.arange(bounds[0], bounds[-1]) if len(bounds) else np.zeros(0, np.int64)
    ok = places + k <= np.repeat(bounds[1:], lengths)
    return places[ok], text[ok]


def spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    return np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def blocks(batches: Iterator, size: int, columns: list[str]) -> Iterator[tuple]:
    """Arrow batches regrouped: yields (texts as bytes, other columns' lists) of about so many bytes and at most MOST_TEXTS rows; text comes first in columns."""
    held, total = [[] for _ in columns], 0
    for batch in batches:
        values = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
        for row in zip(*values, strict=True):
            text = (row[0] or "").encode("utf-8", "surrogatepass")
            held[0].append(text)
            for into, value in zip(held[1:], row[1:], strict=True):
                into.append(value)
            total += len(text)
            if total >= size or len(held[0]) >= MOST_TEXTS:
                yield tuple(held)
                held, total = [[] for _ in columns], 0
    if held[0]:
        yield tuple(held)
    del held
    release()


def release() -> None:
    """Gives freed memory back: a worker is kept for later tasks, and what it holds meanwhile counts against its executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
