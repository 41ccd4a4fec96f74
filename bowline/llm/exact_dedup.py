"""Exact deduplication: sorted digest runs, merged in a tree of binomial rounds.

Every input partition makes one run: a digest per row, sorted and written down, equal digests folded into one row with
the smallest identifier and a count. In each round the runs whose numbers differ in the next bit are exchanged: the odd
one goes to where the even one is, the two are brought into one order of digests, and of rows that meet as neighbours
with equal digests the smallest identifier stays and the counts are added. So n runs are one after log2(n) rounds, each
written down; a larger ``fan_in`` merges more runs at once. Runs are cut into slices of the digests' range, the same for
all, and slices merge independently: even the last run is in as many tasks as its size asks for.

A digest is SHA-256 of the normalised text; at every level rows merge only if the length and a second, independent hash
agree too, so that a colliding digest never drops a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm.common import SPACES, join_split_hot, text_or_empty, unused
from bowline.staging import broadcast_if_small, measure, stage

FAN_IN = 2
SLICE_ROWS = 1 << 20  # documents per slice of the digests' range
PROOF = ("digest", "length", "second")


def proof_columns(text: str) -> dict:
    normal = F.regexp_replace(text_or_empty(text), SPACES, " ")
    return {
        "digest": F.unhex(F.sha2(normal, 256)),
        "length": F.octet_length(normal),
        "second": F.xxhash64(normal),
    }


def digest_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its digest and its run, the input partition; sorted within the run and written down."""
    columns = [F.col(doc_id).alias("doc_id"), *[c.alias(k) for k, c in proof_columns(text).items()]]
    rows = docs.select(*columns, F.spark_partition_id().alias("run"))
    return stage(rows.sortWithinPartitions("digest", "doc_id"), "digest-runs")


def merged_level(rows: DataFrame) -> DataFrame:
    """Runs of equal number as one: in the order of the digests, of equal neighbours the first, with all their counts."""
    equal = Window.partitionBy("slice", "run", *PROOF)
    first = equal.orderBy(F.col("keep_id").asc_nulls_last())
    met = rows.repartition("slice", "run").withColumns(
        {"nth": F.row_number().over(first), "group_size": F.sum("group_size").over(equal)}
    )
    return met.filter("nth = 1").drop("nth")


def merge_runs(runs: DataFrame, total: int, fan_in: int = FAN_IN) -> DataFrame:
    """One row per text: ``keep_id``, the smallest identifier (null if all are), and ``group_size``."""
    left = (runs.agg(F.max("run")).first()[0] or 0) + 1
    slices = 1 << max(0, (total // SLICE_ROWS).bit_length())
    lead = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    cut = F.floor(lead * slices / F.lit(1 << 32)).cast("int")
    # Copies inside a run are folded before anything travels.
    level = runs.withColumn("slice", cut).groupBy("slice", "run", *PROOF)
    level = stage(level.agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "digest-level")
    while left > 1:
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        level = stage(merged_level(level), "digest-level")
        left = -(-left // fan_in)
    return level.drop("run", "slice")


def decide(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: doc_id, the digest columns, keep_id, group_size and kept.

    A null text counts as empty, and empty texts equal each other. Rows without an identifier come after all others:
    they stay only in a group that has no other row. Of rows that repeat both identifier and text one stays. An
    empty table gives no rows.
    """
    runs = digest_runs(docs, text, doc_id)
    total = runs.count()
    merged = merge_runs(runs, total, fan_in)
    # Rows that repeat identifier and text are told apart only by a number.
    rows = runs.groupBy("doc_id", *PROOF).agg(F.count("*").alias("times"))
    joined = join_split_hot(rows, merged, PROOF, "group_size", total)
    numbered = joined.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return numbered.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).drop(
        "times", "nth"
    )


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the rules are those of ``decide``.

    Of rows that repeat identifier and text, the one whose other columns hash lowest stays.
    """
    decided = stage(decide(docs, text, doc_id, fan_in), "exact-decisions").groupBy("doc_id", *PROOF)
    decided = decided.agg(F.count("*").alias("times"), F.max("kept").alias("stays"))
    names = unused(docs, *PROOF, "other_columns", "place")
    marked = docs.withColumns(dict(zip(names, proof_columns(text).values(), strict=False)))

    def matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        """Few keys are sent to all tasks, so that the texts stay where they are; many meet them in a shuffle."""
        keys = stage(keys.select("doc_id", *PROOF), "exact-keys")
        same = [rows[doc_id].eqNullSafe(keys["doc_id"])]
        same += [rows[mine] == keys[theirs] for mine, theirs in zip(names, PROOF, strict=False)]
        return rows.join(broadcast_if_small(keys, measure(keys, "digest")), same, how)

    staying = matching(marked, decided.filter("NOT stays"), "left_anti")
    repeated = decided.filter("stays AND times > 1")
    if repeated.isEmpty():
        return staying.select(*docs.columns)
    single, several = matching(staying, repeated, "left_anti"), matching(staying, repeated, "left_semi")
    several = several.withColumn(names[3], F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    of_row = Window.partitionBy(doc_id, *names[:3]).orderBy(names[3])
    first = several.withColumn(names[4], F.row_number().over(of_row)).filter(F.col(names[4]) == 1)
    return single.select(*docs.columns).unionByName(first.select(*docs.columns))
