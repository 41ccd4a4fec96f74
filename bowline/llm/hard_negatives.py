"""Hard negatives by rotated one-bit codes: popcount estimates, residual intervals, exact integer scores.

Vectors become whole numbers and are turned by one fixed random rotation. The code of a turned vector v is a unit vector
b of equal entries with the signs of v, one bit each; stored with it is its alignment a = <v, b> and the length of what
is left, r = v - a b, which is orthogonal to b. What is left is coded the same way, for some levels. An anchor q is
rounded to a few bit planes, so that its products with codes are sums of popcounts; how far rounding moved it is known.
Then <q, v> is the sum of a <q, b> over the levels, up to the last residual, and by Cauchy and Schwarz that is at most
|r| times the part of q that is orthogonal to the last b. This interval is certain, not probable. Rows whose interval
rules them out are skipped; all others are scored exactly in whole numbers. So the result is that of comparing all.

Anchors and rows are dealt into blocks of a bounded number of rows, and each block of anchors meets each block of rows
in one group. A group returns a few rows per anchor; a ranking that drops the others before the shuffle ends the job.
One pass finds the positives, a second one the negatives next to their scores.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm.densevectors import finite, matrix, scaled
from bowline.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
LEVELS = 3  # one-bit codes of a vector, each of what those before it left over
PLANES = 6  # bits of an anchor's entries
ROWS, ANCHORS = 4096, 2048  # mean rows and anchors of a group
TOGETHER = 128  # anchors of one step within a group


def rotation(dimensions: int, seed: int = 13) -> np.ndarray:
    """A random orthogonal matrix, the same for a seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.where(np.diag(r) < 0, -1.0, 1.0)


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    raw = np.packbits(bits, axis=1, bitorder="little")
    padded = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    padded[:, : raw.shape[1]] = raw
    return padded.view(np.uint64)


def codes_of(turned: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words: rows x levels x words, alignments: rows x levels, length of the last residual)."""
    root = np.sqrt(turned.shape[1])
    left, words, aligned = turned.copy(), [], []
    for _ in range(levels):
        signs = np.where(left >= 0, 1.0, -1.0)
        a = np.abs(left).sum(1) / root
        words.append(pack(signs > 0))
        aligned.append(a)
        left -= signs * (a / root)[:, None]
    return np.stack(words, 1), np.stack(aligned, 1), np.sqrt((left * left).sum(1))


class Rounded:
    """Anchors as bit planes: entry = low + step * number, and how far each anchor is from its rounded self."""

    def __init__(self, turned: np.ndarray, planes: int = PLANES):
        self.low = turned.min(1)
        self.step = np.maximum((turned.max(1) - self.low) / ((1 << planes) - 1), 1e-300)
        numbers = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = [pack((numbers >> p) & 1 == 1) for p in range(planes)]
        self.total = numbers.sum(1)
        self.dimensions = turned.shape[1]
        self.length = np.sqrt((turned * turned).sum(1))
        moved = self.low[:, None] + self.step[:, None] * numbers - turned
        self.error = np.sqrt((moved * moved).sum(1))

    def products(self, part: slice, words: np.ndarray) -> np.ndarray:
        """<rounded anchor, b> for the anchors of a part and the codes ``words`` (rows x words)."""
        counts = np.zeros((part.stop - part.start, len(words)), np.int32)
        ones = np.bitwise_count(words).sum(1, dtype=np.int64)
        for p, plane in enumerate(self.planes):
            for w in range(words.shape[1]):
                counts += np.left_shift(np.bitwise_count(plane[part, w, None] & words[:, w]), p, dtype=np.int32)
        signed = self.step[part, None] * (2 * counts.astype(float) - self.total[part, None])
        return (signed + self.low[part, None] * (2 * ones - self.dimensions)) / np.sqrt(self.dimensions)


def intervals(
    anchors: Rounded, part: slice, words: np.ndarray, aligned: np.ndarray, left: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the products of the anchors of a part with all coded rows."""
    middle, error = 0.0, anchors.error[part, None]
    for level in range(words.shape[1]):
        product = anchors.products(part, words[:, level])
        middle = middle + product * aligned[:, level]
    along = np.maximum(np.abs(product) - error, 0.0)  # of the anchor, on the last code vector
    across = np.sqrt(np.maximum(anchors.length[part, None] ** 2 - along * along, 0.0))
    lengths = np.sqrt((aligned * aligned).sum(1) + left * left)
    radius = left * across + error * aligned.sum(1) + 1e-9 * (anchors.length[part, None] * lengths + 1.0)
    return middle - radius, middle + radius


def exact_scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers."""
    reach = int(np.abs(rows).max(initial=0)) * int(np.abs(anchor).max(initial=0)) * rows.shape[1]
    if reach < 2**53:  # doubles are exact
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    if reach < 2**63:
        return rows @ anchor
    exact = rows.astype(object) @ anchor.astype(object)
    if max(map(abs, exact), default=0) >= 2**63:
        raise ValueError("a score does not fit 64 bits")
    return exact.astype(np.int64)


class Block:
    """Coded rows of one side of a group."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        column = lambda name: table.column(name).combine_chunks()
        self.row, self.vec_id = (column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id"))
        self.label = column("label")
        self.numbers = matrix(column("numbers")).astype(np.int64)
        self.levels = matrix(column("aligned"))
        self.left = column("left").to_numpy(zero_copy_only=False)
        raw = np.frombuffer(b"".join(column("codes").to_pylist()), np.uint64)
        self.words = raw.reshape(len(self.row), self.levels.shape[1], -1)


def first_of(rows: Block, at: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """The places in ``at`` of the best rows: higher scores first, then smaller identifiers."""
    return np.lexsort((rows.row[at], rows.vec_id[at], -scores))[:count]


def same_label(anchors: Block, rows: Block) -> np.ndarray:
    """anchors x rows: whether the labels are equal."""
    both = pa.chunked_array([anchors.label, rows.label]).dictionary_encode().combine_chunks()
    numbers = both.indices.to_numpy(zero_copy_only=False)
    return numbers[: len(anchors.row), None] == numbers[len(anchors.row) :]


FOUND = "anchor long, row long, anchor_id long, other_id long, score long"


def nearest_alike(anchors: Block, rows: Block, turned: np.ndarray, count: int) -> list[np.ndarray]:
    """For every anchor its best ``count`` other rows of the same label in the block, as columns of FOUND."""
    out, rounded, alike = [], Rounded(turned), same_label(anchors, rows)
    for start in range(0, len(anchors.row), TOGETHER):
        part = slice(start, min(start + TOGETHER, len(anchors.row)))
        low, high = intervals(rounded, part, rows.words, rows.levels, rows.left)
        wanted = alike[part] & (anchors.row[part, None] != rows.row)
        low[~wanted] = -np.inf
        if len(rows.row) > count:  # so many rows are at least this good
            wanted &= high >= np.partition(low, -count, axis=1)[:, -count, None]
        for k in range(len(low)):
            at, i = np.flatnonzero(wanted[k]), start + k
            scores = exact_scores(rows.numbers[at], anchors.numbers[i])
            best = first_of(rows, at, scores, count)
            same = np.full(len(best), anchors.row[i]), rows.row[at[best]], np.full(len(best), anchors.vec_id[i])
            out.append(np.stack([*same, rows.vec_id[at[best]], scores[best]]))
    return out


def nearest_unlike(
    anchors: Block, rows: Block, turned: np.ndarray, positives: list[list[int]], count: int, low_share: int, high_share: int
) -> list[np.ndarray]:
    """For every anchor and positive score the best ``count`` rows of another label between the shares of it.

    Columns: anchor, place of the positive, anchor_id, other_id, score."""
    bounds = [[(-(-low_share * p // 100), high_share * p // 100) for p in scores] for scores in positives]
    least = np.array([min((lo for lo, _ in b), default=np.inf) for b in bounds], float)
    most = np.array([max((hi for _, hi in b), default=-np.inf) for b in bounds], float)
    out, rounded, alike = [], Rounded(turned), same_label(anchors, rows)
    for start in range(0, len(anchors.row), TOGETHER):
        part = slice(start, min(start + TOGETHER, len(anchors.row)))
        low, high = intervals(rounded, part, rows.words, rows.levels, rows.left)
        wanted = ~alike[part] & (high >= least[part, None]) & (low <= most[part, None])
        for k in range(len(low)):
            at, i = np.flatnonzero(wanted[k]), start + k
            if not len(at):
                continue
            scores = exact_scores(rows.numbers[at], anchors.numbers[i])
            order = first_of(rows, at, scores, len(at))
            falling = -scores[order]
            for place, (lo, hi) in enumerate(bounds[i], 1):
                a, b = np.searchsorted(falling, -hi, "left"), np.searchsorted(falling, -lo, "right")
                best = order[a : min(b, a + count)]
                if len(best):
                    same = [np.full(len(best), v) for v in (anchors.row[i], place, anchors.vec_id[i])]
                    out.append(np.stack([*same, rows.vec_id[at[best]], scores[best]]))
    return out


def table_of(parts: list[np.ndarray], names: list[str]) -> pa.Table:
    cells = np.concatenate([np.zeros((len(names), 0), np.int64), *parts], axis=1)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cells, strict=True)})


def encode(vectors: DataFrame, vec_id: str, label: str, vector: str, anchors: Column, levels: int) -> tuple[DataFrame, np.ndarray]:
    """The usable rows, coded and written down, each with a number of its own; and the rotation."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("v"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("v"))
    first = rows.select(F.size("v").alias("d")).first()
    turn = rotation(first["d"] if first else 1)  # its size depends on the dimensions alone
    shared = vectors.sparkSession.sparkContext.broadcast(turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = scaled(matrix(batch.column(3)), SCALE)
            if numbers.shape[1] != len(shared.value):
                raise ValueError(f"vectors of {numbers.shape[1]} and of {len(shared.value)} entries in one table")
            words, aligned, left = codes_of(numbers @ shared.value, levels)
            lists = lambda m, kind: pa.ListArray.from_arrays(
                pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32()), pa.array(m.reshape(-1), kind)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    lists(numbers, pa.int64()),
                    pa.array([w.tobytes() for w in words], pa.binary()),
                    lists(aligned, pa.float64()),
                    pa.array(left),
                ],
                names=["vec_id", "label", "anchor", "numbers", "codes", "aligned", "left"],
            )

    schema = "vec_id long, label string, anchor boolean, numbers array<bigint>, codes binary, aligned array<double>, left double"
    coded = rows.mapInArrow(run, schema).select(F.monotonically_increasing_id().alias("row"), "*")
    return stage(coded, "coded-vectors"), turn


def mine(
    vectors: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low_share: int = 80,
    high_share: int = 100,
    levels: int = LEVELS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of floor(256 * entry); higher ones come first, then smaller identifiers. The positives of
    a row for which ``anchors`` holds are its first ``positives`` other rows of the same label; for each of them the
    first ``negatives`` rows of other labels come out that score from ``low_share`` to ``high_share`` per cent of the
    positive's score. Rows without an identifier, a label, or a vector of finite entries take no part; vectors must have
    one length. Repeated rows are rows of their own. Other columns do not matter. No rows: no result.
    """
    coded, turn = encode(vectors, vec_id, label, vector, anchors, levels)
    shared = vectors.sparkSession.sparkContext.broadcast(turn)
    size = coded.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    row_blocks, anchor_blocks = (max(1, -(-n // most)) for n, most in ((size["rows"], ROWS), (size["anchors"], ANCHORS)))
    own = lambda salt, blocks: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    right = coded.select("*", own(1, row_blocks).alias("r"), every(anchor_blocks).alias("a")).groupBy("a", "r")

    def meet(left: DataFrame, per_group, schema: str) -> DataFrame:
        names = [field.split()[0] for field in schema.split(", ")]
        fresh = [F.col(c).alias(c) for c in left.columns]  # both sides come from one table
        dealt = left.select(*fresh, own(2, anchor_blocks).alias("a"), every(row_blocks).alias("r")).groupBy("a", "r")

        def run(one: pa.Table, two: pa.Table) -> pa.Table:
            if not one.num_rows or not two.num_rows:
                return table_of([], names)
            a, b = Block(one), Block(two)
            return table_of(per_group(one, a, b, a.numbers @ shared.value), names)

        return dealt.cogroup(right).applyInArrow(run, schema)

    chosen = coded.filter("anchor")
    found = meet(chosen, lambda table, a, b, turned: nearest_alike(a, b, turned, positives), FOUND)
    ranking = Window.partitionBy("anchor").orderBy(F.desc("score"), "other_id", "row")
    ranked = found.select("*", F.row_number().over(ranking).alias("place")).filter(F.col("place") <= positives)
    near = stage(ranked.select("anchor", "place", F.col("other_id").alias("positive_id"), "score"), "positives")
    listed = near.groupBy(F.col("anchor").alias("of")).agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("p"))
    wanted = chosen.join(listed.select("of", F.col("p.score").alias("scores")), F.col("row") == F.col("of")).drop("of")

    def unlike(table: pa.Table, a: Block, b: Block, turned: np.ndarray) -> list[np.ndarray]:
        scores = table.column("scores").to_pylist()
        return nearest_unlike(a, b, turned, scores, negatives, low_share, high_share)

    others = meet(wanted, unlike, "anchor long, place long, anchor_id long, other_id long, score long")
    ranking = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "other_id")
    ranked = others.select("*", F.row_number().over(ranking).alias("rank")).filter(F.col("rank") <= negatives)
    scored = near.select("anchor", "place", "positive_id", F.col("score").alias("positive_score"))
    return ranked.join(scored, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
