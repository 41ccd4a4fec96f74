"""Byte-level byte-pair encoding and decoding with a rank file, by a queue of merge ranks.

A rank file lists byte strings; a string's rank is its id, and two neighbouring symbols may merge where their bytes
together are in the file. Of all such pairs the one of the lowest rank merges first, of equal ranks the leftmost.

The symbols of a pretoken are a linked list over its byte positions. There is one bucket of positions per merge rank,
and over the buckets a hierarchical bitmap: a bit of the lower level says that a bucket is not empty, a bit of the
upper level that a word of 256 bits below it is not zero. Find-first-set, once per level, gives the lowest rank that
has positions, however many ranks and positions there are. A merge only adds the two new neighbouring pairs to their
buckets; entries that it made wrong stay where they are and are skipped when they come up, as a position knows the
rank of its present pair. So a pretoken of n bytes takes O(n log n) steps and O(n) memory, and very long ones are as
good as short ones.
"""

from __future__ import annotations

import base64
import sys
import types
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.llm.bpe import PATTERN, row_slices, spread, texts_of
from bowline.llm.bytewords import list_array
from bowline.llm.common import unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REMEMBERED = 600_000  # pretokens that a worker keeps the ids of
SHORT = 64  # characters of a pretoken that may be kept
PIECES = 1 << 16  # pretokens that are in memory together


class RankQueue:
    """Positions by rank, taken from the lowest rank and, within it, from the lowest position."""

    def __init__(self, ranks: int):
        self.top = 0  # a bit per word of ``low`` that is not zero
        self.low = [0] * ((ranks >> 8) + 1)  # a bit per bucket that is not empty, in words of 256
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        bucket.append(position)
        at = rank >> 8
        word = self.low[at]
        self.low[at] = word | 1 << (rank & 255)
        if not word:
            self.top |= 1 << at

    def pop(self) -> tuple[int, int]:
        """The next (rank, position); for a queue that is not empty."""
        top = self.top
        at = (top & -top).bit_length() - 1
        word = self.low[at]
        bit = word & -word
        rank = (at << 8) + bit.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        word ^= bit
        self.low[at] = word
        if not word:
            self.top = top & (top - 1)
        return rank, bucket.pop()


class Encoder(dict):
    """Encoder and decoder of one rank file; as a dict, the ids of the pretokens met lately.

    When half of the memory is full it becomes the older half, and the half that was older is forgotten.
    """

    def __init__(self, file: bytes):
        super().__init__()
        lines = (line.split() for line in file.splitlines())
        self.ranks = {base64.b64decode(parts[0]): int(parts[1]) for parts in lines if parts}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the rank file lacks single bytes: {missing[:5]}")
        size = max(self.ranks.values()) + 1
        self.spelled = [b""] * size
        for s, rank in self.ranks.items():
            self.spelled[rank] = s
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.pairs = [[self.ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]
        self.queue = RankQueue(size)
        self.older: dict[str, tuple[int, ...]] = {}
        self.pattern = regex.compile(PATTERN)
        self.lengths = np.array([len(s) for s in self.spelled], np.int64)
        self.spots = np.concatenate([[0], np.cumsum(self.lengths)])
        self.letters = np.frombuffer(b"".join(self.spelled), np.uint8)

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """The ids of one pretoken."""
        ranks, spelled, queue = self.ranks, self.spelled, self.queue
        whole = ranks.get(raw)
        if whole is not None:
            return (whole,)
        n = len(raw)
        single, pairs = self.single, self.pairs
        symbols = [single[b] for b in raw]
        pair = [pairs[a][b] for a, b in zip(raw, raw[1:], strict=False)]  # rank of the pair that begins here; -1: none
        pair.append(-1)
        after, before = range(1, n + 1), range(-1, n - 1)
        if n > SHORT:  # compact
            symbols, pair, after, before = (array("i", x) for x in (symbols, pair, after, before))
        else:
            after, before = list(after), list(before)
        get, push, pop = ranks.get, queue.push, queue.pop
        buckets, low = queue.buckets, queue.low
        for at, rank in enumerate(pair):
            if rank >= 0:
                bucket = buckets[rank]
                if not bucket:  # otherwise its bits are set, and positions come in order
                    word = rank >> 8
                    low[word] |= 1 << (rank & 255)
                    queue.top |= 1 << word
                bucket.append(at)
        while queue.top:
            rank, at = pop()
            if pair[at] != rank:
                continue  # stale: another merge took one of its symbols
            gone = after[at]
            behind, ahead = after[gone], before[at]
            symbols[at], symbols[gone], pair[gone], after[at] = rank, -1, -1, behind
            pair[at] = -1
            if behind < n:
                before[behind] = at
                pair[at] = following = get(spelled[rank] + spelled[symbols[behind]], -1)
                if following >= 0:
                    push(following, at)
            if ahead >= 0:
                pair[ahead] = leading = get(spelled[symbols[ahead]] + spelled[rank], -1)
                if leading >= 0:
                    push(leading, ahead)
        return tuple([s for s in symbols if s >= 0])

    def __missing__(self, pretoken: str) -> tuple[int, ...]:
        ids = self.older.get(pretoken)
        if ids is None:
            ids = self.merge(pretoken.encode("utf-8", "replace"))
        if len(pretoken) <= SHORT:
            if 2 * len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[pretoken] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text of any length."""
        found, out = self.pattern.finditer(text), [np.zeros(0, np.int32)]
        while part := [m.group() for m in islice(found, PIECES)] if len(text) > PIECES else self.pattern.findall(text):
            out.append(np.fromiter(chain.from_iterable(map(self.__getitem__, part)), np.int32))
            if len(text) <= PIECES:
                break
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids spell; ids outside the file spell nothing."""
        ids = ids[(ids >= 0) & (ids < len(self.spelled))]
        return self.letters[spread(self.spots[ids], self.lengths[ids])].tobytes()


def encoder_of(file: bytes) -> Encoder:
    """The worker's encoder for a rank file, kept from task to task."""
    state = sys.modules.setdefault("bowline_worker_state", types.ModuleType("bowline_worker_state"))
    encoders = state.__dict__.setdefault("rank_encoders", {})
    key = hash(file)
    if key not in encoders:
        encoders.clear()
        encoders[key] = Encoder(file)
    return encoders[key]


def rank_file(path: str | None = None) -> bytes:
    """The content of a rank file, read by the driver; without a path, the one for many languages."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        return f.read()


def encode_and_decode(
    docs: DataFrame, text: str = "text", path: str | None = None, packed: bool = False, decode: bool = True
) -> DataFrame:
    """``docs`` with ``token_ids`` and, from these ids, ``decoded`` (binary) in place of the text.

    ``token_ids``: array of int, or with ``packed`` the ids as little-endian unsigned 32-bit numbers in a binary. Every
    match of the pattern is encoded for itself and nothing is special: strings of control tokens are ordinary text. A
    null text counts as empty: no ids. Texts and pretokens of any length are coded whole. Repeated rows are coded
    each, an empty table gives no rows, and other columns, nulls in them too, are carried along; a new column whose
    name is taken gets underscores. No shuffle: rows stay in their partitions.
    """
    others = [c for c in docs.columns if c != text]
    file = docs.sparkSession.sparkContext.broadcast(rank_file(path))  # under a megabyte, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(file.value)
        for batch in row_slices(batches, len(others)):
            ids = [encoder.encode(t) for t in texts_of(batch.column(len(others)))]
            columns = [batch.column(i) for i in range(len(others))]
            if packed:
                columns.append(pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()))
            else:
                firsts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                columns.append(list_array(np.concatenate([np.zeros(0, np.int32), *ids]), firsts, pa.int32()))
            if decode:
                columns.append(pa.array([encoder.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    new = {"token_ids": "binary" if packed else "array<int>"} | ({"decoded": "binary"} if decode else {})
    inside = [f"c{i}" for i in range(len(others))]
    names = [*inside, *new]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"{n} {kinds[c]}" for n, c in zip(inside, others, strict=True)), *(f"{n} {t}" for n, t in new.items())])
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(others, inside, strict=True)]
    out = docs.select(*columns, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)
    return out.toDF(*others, *unused(docs.select(*[f"`{c}`" for c in others]), *new))
