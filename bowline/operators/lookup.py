"""Distributed numbering of keys, and skew-proof joins against a table that is unique on its key."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bowline.staging import TableSize, size_columns, stage

# A key is hot when it holds at least one part in HOT_SHARE of the joined rows, so at most HOT_SHARE keys are.
HOT_SHARE = 10_000
# The rows of a hot key are spread over so many salts, and the table's row for it is repeated for each.
SALTS = 64

_ROW_BITS = 33  # monotonically_increasing_id() keeps the row's position in the low 33 bits


def place_rows(df: DataFrame, order: Sequence[Column | str], index: str, key: str, weight: str | None) -> tuple[DataFrame, list]:
    """Add ``index`` = 0, 1, 2, ... in ``order``; also the size columns of every partition.

    Rows are range-partitioned and sorted, each one's position in its partition is written down with it, and one
    offset per partition (a running sum of the partitions' sizes) is added. No step holds all rows in one task.
    """
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    )
    piece = F.shiftright("_place", _ROW_BITS).cast("int")
    sizes = placed.groupBy(piece.alias("piece")).agg(*size_columns(key, weight)).collect()  # one row per partition
    by_piece = {r["piece"]: r["rows"] for r in sizes}
    counts = [by_piece.get(p, 0) for p in range(max(by_piece, default=0) + 1)]
    offsets = ",".join(str(n) for n in accumulate(counts, initial=0))
    # A foldable expression: one array literal after constant folding.
    offset = F.element_at(F.split(F.lit(offsets), ",").cast("array<bigint>"), piece + 1)
    numbered = placed.withColumn(index, offset + F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    return numbered.drop("_place"), sizes


def number_rows(
    df: DataFrame, key: str, index: str = "word_index", weight: str | None = None
) -> tuple[DataFrame, TableSize]:
    """Add ``index`` = 0, 1, 2, ... in ascending order of the unique, non-null ``key``; also return the size."""
    numbered, sizes = place_rows(df, [key], index, key, weight)
    return numbered, TableSize(*(sum(r[part] for r in sizes) for part in ("rows", "key_bytes", "weight")))


def number_top(
    rows: DataFrame, order: Sequence[Column | str], k: int, key: str, index: str, weight: str | None = None
) -> tuple[DataFrame, TableSize]:
    """The first ``k`` rows in ``order``, numbered in ascending order of ``key``.

    Rows get their ordinals in ``order`` without a limit, and those below ``k`` are numbered again.
    """
    ranked, _ = place_rows(rows, order, "_ordinal", key, weight)
    return number_rows(ranked.filter(F.col("_ordinal") < k).drop("_ordinal"), key, index, weight)


def salt_hot(rows: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt``: rows of hot keys are spread, and the table's rows for them repeated.

    Hot keys are measured on ``rows`` themselves, by a hash of the key: keys that share a hash share its salts.
    """
    others = [c for c in rows.columns if c != key]
    hashed = rows.withColumn("_hash", F.xxhash64(key))
    counts = stage(hashed.groupBy("_hash").agg(F.count("*").alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    # At most HOT_SHARE rows of two numbers.
    hot = F.broadcast(counts.filter(F.col("_rows") * HOT_SHARE >= total).select("_hash", F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*others), F.lit(SALTS))).otherwise(0).cast("int")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    tagged = table.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left")
    return (
        hashed.join(hot, "_hash", "left").withColumn("_salt", spread).drop("_hash", "_hot"),
        tagged.withColumn("_salt", F.explode(every)).drop("_hash", "_hot"),
    )


def slot_join(rows: DataFrame, table: DataFrame, key: str, carry: Sequence[str], how: str) -> DataFrame:
    """Join in a shuffle, hot keys under salts, on one number made of key and salt: it sorts far faster than text does.

    The number is not a column, as its random bytes would be shuffled too. The keys themselves are compared last, as two
    bounds: Spark would sort by them too if they were a part of the key.
    """
    left, right = salt_hot(rows, table, key)
    if rows.schema[key].dataType != table.schema[key].dataType:  # equal numbers of two types have two hashes
        return left.join(right, [key, "_salt"], how)
    right = right.select(F.col("_salt").alias("_salt_"), F.col(key).alias("_key_"), *carry)
    slot = lambda k, salt: F.xxhash64(k).bitwiseXOR(F.col(salt).cast("bigint"))  # noqa: E731  one for each salt of a key
    same = (slot(key, "_salt") == slot("_key_", "_salt_")) & F.col(key).between(F.col("_key_"), F.col("_key_"))
    return left.join(right, same, how)


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, carry: Sequence[str], size: TableSize, known: str | None = None
) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (unique on ``key``), adding the ``carry`` columns.

    A table of checked size is broadcast. A larger one is shuffled, the hot keys of ``rows`` under salts. ``known``
    names a boolean column of the table; rows matching a false one are dropped.
    """
    rows = rows.filter(F.col(key).isNotNull())
    members = (table.filter(known) if known else table).select(key, *carry)
    if size.fits_broadcast:
        return rows.join(F.broadcast(members), key).select(*rows.columns, *carry)
    return slot_join(rows, members, key, carry, "inner").select(*rows.columns, *carry)


def drop_matching(rows: DataFrame, table: DataFrame, key: str, size: TableSize) -> DataFrame:
    """Rows with a non-null key that ``table`` does not hold; a large table is met as in ``lookup_join``."""
    rows = rows.filter(F.col(key).isNotNull())
    if size.fits_broadcast:
        return rows.join(F.broadcast(table.select(key)), key, "left_anti").select(*rows.columns)
    return slot_join(rows, table.select(key), key, [], "left_anti").select(*rows.columns)
