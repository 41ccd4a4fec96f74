"""Byte-pair encoding and decoding with a public vocabulary file, whole texts, in Arrow batches.

A text is cut into pretokens; each pretoken starts as one symbol per byte. A segment tree stands over its adjacent
pairs: a leaf holds (rank of the pair, position), an inner node the smaller of its children. So the root is the
leftmost pair of the lowest rank; merging it changes three leaves, and their paths to the root are renewed in
logarithmic time, until the root says that no pair can be merged. The trees of many short pretokens of one size are
kept side by side in numpy arrays and take their steps together; a long pretoken has a tree of its own.

Where all white space is single spaces and line feeds, no pretoken goes over one of them: such texts are cut there,
and a worker looks up the pieces that it has met before. That memory is bounded and only saves time. All other texts
are cut into pretokens right away.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.llm.bytewords import list_array
from bowline.llm.common import unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The pretoken pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# White space other than spaces and line feeds.
OTHER_SPACE = re.compile(r"[^\S \n]")


def irregular(text: str) -> bool:
    """Whether white space is next to white space, at an end, or other than a space or a line feed."""
    return (
        "  " in text
        or "\n\n" in text
        or " \n" in text
        or "\n " in text
        or text[:1].isspace()
        or text[-1:].isspace()
        or OTHER_SPACE.search(text) is not None
    )


NONE = np.int64(1) << 62
MISSING = (1 << 17) - 1  # a symbol that is in no pair
WIDE = 64  # pretokens with more symbols get a tree of their own
REMEMBERED = 400_000  # pieces of texts
CHUNK = 1 << 20  # characters encoded at a time


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Numbered(dict):
    """Numbers strings in the order they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = at = len(self)
        self.new.append(key)
        return at


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, file: str):
        spec = json.loads(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        to_byte = byte_symbols()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()} | {
            i: s.encode() for s, i in added.items()
        }
        self.first = np.array([vocab[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])], np.int64)
        keys = np.array([(vocab[a] << 17) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(merges)), strict=True))
        self.added = added
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(added, key=len, reverse=True))) if added else None
        self.pattern = regex.compile(PATTERN)
        size = max(self.bytes_of) + 1
        self.lengths = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.spots = np.concatenate([[0], np.cumsum(self.lengths)])
        self.spelled = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.place = Numbered()
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.counts = np.zeros(1 << 14, np.int64)

    # The segment trees.

    def pair_leaves(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (left << 17) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, (self.ranks[at] << 32) | position, NONE)

    def merge_together(self, symbols: np.ndarray, leaves: int) -> np.ndarray:
        """``symbols``: a row per pretoken, padded with MISSING to ``leaves`` + 1. Merged symbols become -1."""
        rows, width = len(symbols), leaves + 1
        position = np.broadcast_to(np.arange(leaves), (rows, leaves))
        tree = np.full((rows, 2 * leaves), NONE)
        tree[:, leaves:] = self.pair_leaves(symbols[:, :-1], symbols[:, 1:], position)
        for level in range(leaves.bit_length() - 1, 0, -1):
            low = 1 << (level - 1)
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        after = np.minimum(np.arange(1, width + 1), leaves)
        before = np.arange(-1, width - 1)
        after, before = (np.tile(x, rows) for x in (after, before))
        flat, nodes = symbols.reshape(-1), tree.reshape(-1)
        live = np.arange(rows)
        while True:
            root = nodes[live * 2 * leaves + 1]
            going = root < NONE
            live, root = live[going], root[going]
            if not len(live):
                return symbols
            at, base, top = root & 0xFFFFFFFF, live * width, live * 2 * leaves
            gone = after[base + at]
            behind = after[base + gone]
            flat[base + at] = self.merged[root >> 32]
            flat[base + gone] = np.where(gone == leaves, MISSING, -1)
            after[base + at] = behind
            before[base + behind] = np.where(behind == leaves, before[base + behind], at)
            ahead = np.where(before[base + at] < 0, at, before[base + at])
            nodes[top + leaves + gone] = NONE
            for leaf in (at, ahead):
                following = np.where(after[base + leaf] == leaves, MISSING, flat[base + after[base + leaf]])
                nodes[top + leaves + leaf] = self.pair_leaves(flat[base + leaf], following, leaf)
            for leaf in (gone, at, ahead):
                node = (leaf + leaves) >> 1
                while node[0]:  # all nodes of one step are on one level
                    nodes[top + node] = np.minimum(nodes[top + 2 * node], nodes[top + 2 * node + 1])
                    node >>= 1

    def merge_alone(self, symbols: list[int]) -> list[int]:
        """One long pretoken."""
        n = len(symbols)
        leaves = 1 << max(1, (n - 1).bit_length())
        none, ranks, merged = int(NONE), self.rank_of, self.merged.tolist()
        tree = [none] * (2 * leaves)

        def leaf(a: int, b: int) -> int:
            rank = ranks.get((symbols[a] << 17) | symbols[b])
            return none if rank is None else (rank << 32) | a

        for i in range(n - 1):
            tree[leaves + i] = leaf(i, i + 1)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != none:
            at, rank = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            gone = after[at]
            behind = after[gone]
            symbols[at], symbols[gone], after[at] = merged[rank], -1, behind
            changed = [(gone, none)]
            if behind < n:
                before[behind] = at
            changed.append((at, leaf(at, behind) if behind < n else none))
            if before[at] >= 0:
                changed.append((before[at], leaf(before[at], at)))
            for i, value in changed:
                i += leaves
                tree[i] = value
                while i > 1:
                    i >>= 1
                    value = min(tree[2 * i], tree[2 * i + 1])
                    if tree[i] == value:
                        break
                    tree[i] = value
        return [s for s in symbols if s >= 0]

    def merge_all(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pretokens in order, and the number of ids of each."""
        seen = Numbered()
        where = np.fromiter(map(seen.__getitem__, pretokens), np.int64, len(pretokens))
        raw = [p.encode("utf-8", "replace") for p in seen.new]
        ids: list[np.ndarray] = [np.zeros(0, np.int32)]
        starts, counts = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        used = 0
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(raw):
            n = len(p)
            by_size.setdefault(max(2, 1 << (n - 1).bit_length()) if n <= WIDE else 0, []).append(i)
        for leaves, group in by_size.items():
            step = max(1, (1 << 18) // leaves) if leaves else 1
            for lo in range(0, len(group), step):
                part = group[lo : lo + step]
                symbols = self.first[np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)]
                if leaves:
                    lengths = np.fromiter((len(raw[i]) for i in part), np.int64, len(part))
                    rows = np.full((len(part), leaves + 1), MISSING, np.int64)
                    rows[np.arange(leaves + 1) < lengths[:, None]] = symbols
                    rows = self.merge_together(rows, leaves)
                    kept = (rows >= 0) & (rows != MISSING)
                    out, n = rows[kept].astype(np.int32), kept.sum(1)
                else:
                    out = np.array(self.merge_alone(symbols.tolist()), np.int32)
                    n = np.array([len(out)])
                ids.append(out)
                counts[part] = n
                starts[part] = used + np.cumsum(n) - n
                used += len(out)
        counts, starts = counts[where], starts[where]
        return np.concatenate(ids)[spread(starts, counts)], counts

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that got the next numbers. A piece that begins with a line feed is written so in the text,
        one that begins with a carriage return (never in a piece) begins a text, any other follows a space."""
        pretokens: list[str] = []
        ends = []
        for p in pieces:
            pretokens += self.pattern.findall(p if p[:1] == "\n" else p[1:] if p[:1] == "\r" else " " + p)
            ends.append(len(pretokens))
        ids, counts = self.merge_all(pretokens)
        counts = np.diff(np.concatenate([[0], np.cumsum(counts)])[[0, *ends]])
        n, at = len(pieces), len(self.place) - len(pieces)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while at + n > len(self.starts):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        self.pool[self.used : self.used + len(ids)] = ids
        self.counts[at : at + n] = counts
        self.starts[at : at + n] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)

    def look_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and the number of ids of each."""
        if len(self.place) > REMEMBERED:
            self.forget()
        where = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        if self.place.new:
            new, self.place.new = self.place.new, []
            self.learn(new)
        counts = self.counts[where]
        return self.pool[spread(self.starts[where], counts)], counts

    # Texts.

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between added tokens, and the added tokens themselves."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            if found.start() > at:
                yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        if at < len(text):
            yield text[at:] if at else text, False

    def encode_any(self, text: str) -> np.ndarray:
        """One text of any length and kind, some pretokens at a time."""
        out = [np.zeros(0, np.int32)]
        for piece, added in self.parts(text):
            if added:
                out.append(np.array([self.added[piece]], np.int32))
                continue
            found = self.pattern.finditer(piece)
            while part := [m.group() for m in islice(found, CHUNK // 8)]:
                out.append(self.merge_all(part)[0])
        return np.concatenate(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if len(t) > CHUNK or irregular(t) or any(a in t for a in self.added):
                out[i] = self.encode_any(t)
            else:
                plain.append(i)
        lo = 0
        while lo < len(plain):
            hi, chars = lo, 0
            while hi < len(plain) and (hi == lo or chars + len(texts[plain[hi]]) <= CHUNK):
                chars += len(texts[plain[hi]])
                hi += 1
            part = [texts[i] for i in plain[lo:hi]]
            pieces = ("\r" + " \r".join(part).replace("\n", " \n")).split(" ")
            ends = np.cumsum([t.count(" ") + t.count("\n") + 1 for t in part])
            ids, counts = self.look_up(pieces)
            bounds = np.concatenate([[0], np.cumsum(counts)])[[0, *ends]]
            for k, i in enumerate(plain[lo:hi]):
                out[i] = ids[bounds[k] : bounds[k + 1]]
            lo = hi
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids spell; ids outside the vocabulary spell nothing."""
        ids = ids[(ids >= 0) & (ids < len(self.lengths))]
        return self.spelled[spread(self.spots[ids], self.lengths[ids])].tobytes()


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[i], ..., starts[i] + counts[i] - 1 for every i, in a row."""
    if not len(counts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1])


def codec_of(file: str) -> Codec:
    """The worker's codec for a vocabulary, kept from task to task."""
    state = sys.modules.setdefault("bowline_worker_state", types.ModuleType("bowline_worker_state"))
    codecs = state.__dict__.setdefault("codecs", {})
    key = hash(file)
    if key not in codecs:
        codecs.clear()
        codecs[key] = Codec(file)
    return codecs[key]


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; a null is empty, invalid bytes are replaced as usual."""
    return [b.decode("utf-8", "replace") for b in column.cast(pa.large_binary()).fill_null(b"").to_pylist()]


def vocabulary(path: str | None = None) -> str:
    """The content of a vocabulary file, read by the driver; without a path, the 50k byte-level one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def row_slices(batches: Iterable[pa.RecordBatch], text: int, most: int = 4 * CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a part has about ``most`` bytes of text or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
        sums = np.cumsum(sizes)
        lo = 0
        while lo < batch.num_rows:
            start = sums[lo] - sizes[lo]
            hi = max(lo + 1, int(np.searchsorted(sums, start + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def encode_and_decode(docs: DataFrame, text: str = "text", path: str | None = None, decode: bool = True) -> DataFrame:
    """``docs`` with ``token_ids`` (array of int) and, from these ids, ``decoded_text``.

    Added tokens written in a text are single ids, as they are for the tokenizers library; nothing is added, cut or
    padded. A null text counts as empty: no ids. The result has the columns of ``docs`` but for the text; a new column
    whose name is taken gets underscores. Repeated rows are coded each; an empty table gives no rows.
    """
    others = [c for c in docs.columns if c != text]
    spark = docs.sparkSession
    file = spark.sparkContext.broadcast(vocabulary(path))  # a few MB, of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(file.value)
        for batch in row_slices(batches, batch_text):
            ids = codec.encode(texts_of(batch.column(batch_text)))
            firsts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            columns = [batch.column(i) for i in range(len(others))]
            columns.append(list_array(np.concatenate([np.zeros(0, np.int32), *ids]), firsts, pa.int32()))
            if decode:
                columns.append(pa.array([codec.decode(x).decode("utf-8", "replace") for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    batch_text = len(others)
    kinds = {f.name: f.dataType for f in docs.schema}
    inside = [f"c{i}" for i in range(len(others))]
    names = [*inside, "token_ids", *(["decoded_text"] if decode else [])]
    schema = ", ".join(
        [*(f"{n} {kinds[c].simpleString()}" for n, c in zip(inside, others, strict=True)), "token_ids array<int>", *(["decoded_text string"] if decode else [])]
    )
    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(others, inside, strict=True)]
    out = docs.select(*columns, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)
    return out.toDF(*others, *unused(docs.select(*[f"`{c}`" for c in others]), *names[len(others) :]))
