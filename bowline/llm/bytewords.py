"""Words of many texts at once, as 64-bit hashes: numpy over the UTF-8 bytes of an Arrow column.

Memory is bounded: texts are taken in slices of about SLICE bytes, and a longer text in pieces cut between words. A
word's hash adds up one mixed number for each byte and its place in the word, so that no algebra of a base makes words
of some shape collide, and is mixed with its length at the end.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Tasks carry this module with them; the workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64


def lut(*ranges: tuple[int, int]) -> np.ndarray:
    """A table over bytes, True in the given inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


def not_spaces() -> np.ndarray:
    """Bytes of words by the rule [^\\x20\\x09-\\x0D]+."""
    return ~lut((0x20, 0x20), (0x09, 0x0D))


def alphanumerics() -> np.ndarray:
    """Bytes of words by the rule [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+, after lower-casing A-Z."""
    return ~lut((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def chain(first: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """A hash of a sequence of hashes."""
    out = mix(first)
    for x in others:
        out = mix(out * U64(BASE) + x)
    return out


class WordHasher:
    """Word boundaries and hashes of byte strings.

    ``word_bytes`` has a number for each byte: 0 is no part of a word, and a word is a run of one other number.
    """

    def __init__(self, word_bytes: np.ndarray, lower: bool):
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self.word = np.asarray(word_bytes, np.uint8)[self.fold]
        self.value = mix(np.arange(1, 257, dtype=U64) * U64(BASE))[self.fold]
        self.places = mix(np.arange(64, dtype=U64) * U64(BASE))

    def grow(self, n: int) -> None:
        if len(self.places) < n:
            self.places = mix(np.arange(1 << (n - 1).bit_length(), dtype=U64) * U64(BASE))

    def piece(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and starts of the words of ``data``; no word goes over a position in ``breaks``."""
        n = len(data)
        if not n:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        w = self.word[data]
        inside, changes = w > 0, w[1:] != w[:-1]
        first, last = inside.copy(), inside.copy()
        first[1:] &= changes
        last[:-1] &= changes
        inner = breaks[(breaks > 0) & (breaks < n)]
        first[inner] |= inside[inner]
        last[inner - 1] |= inside[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(starts):
            return np.zeros(0, U64), starts
        lengths = ends - starts
        self.grow(int(lengths.max()))
        firsts = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
        letters = mix(self.value[data[inside]] ^ self.places[place])
        return mix(np.add.reduceat(letters, firsts) ^ lengths.astype(U64)), starts

    def long_text(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the words of one text longer than a slice, piece by piece."""
        out, at, none = [], 0, np.zeros(0, np.int64)
        while at < len(data):
            end, step = min(len(data), at + SLICE), SLICE
            while end < len(data):
                gaps = np.flatnonzero(self.word[data[at:end]] == 0)
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                    break
                step *= 2  # one word fills the piece
                end = min(len(data), at + step)
            out.append(self.piece(data[at:end], none)[0])
            at = end
        return np.concatenate(out)

    def slices(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(lo, hi, hashes, firsts): the words of texts lo..hi-1; those of text i are firsts[i-lo]..firsts[i-lo+1]."""
        data, offsets = raw_bytes(column)
        lo, n = 0, len(column)
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1)
            hi = min(hi, n)
            part, bounds = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            if hi == lo + 1 and len(part) > SLICE:
                hashes = self.long_text(part)
                yield lo, hi, hashes, np.array([0, len(hashes)])
            else:
                hashes, starts = self.piece(part, bounds)
                yield lo, hi, hashes, np.searchsorted(starts, bounds)
            lo = hi


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def list_array(values: np.ndarray, firsts: np.ndarray, type_: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the first position of each list."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(firsts, np.int32)), pa.array(values, type_))


def signed(x: np.ndarray) -> np.ndarray:
    """Spark has no unsigned numbers: the same 64 bits as long."""
    return np.ascontiguousarray(x).view(np.int64)
