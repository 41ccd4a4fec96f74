"""Sharding by a two-pass external shuffle.

Pass one scatters the records, whole, into buckets that fit in memory: a seeded hash picks the shard, another the
bucket inside it. Pass two takes one bucket at a time, puts it in a Fisher-Yates order and gives its records their
slots. No order of the whole table is ever computed.

The shard follows the law ``key``: it depends on the identifier and the number of shards alone. Each shard draws a
hash for each identifier and the highest draw wins, so one more shard takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm.common import text_or_empty, unused
from bowline.staging import stage

# A bucket is collected by one task: its records are some 3 times as large there as their texts.
BUCKET_BYTES = 8 * 1024 * 1024
SEED = 20240607


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard, 0 to ``shards`` - 1, with the highest draw; equal draws go to the higher shard."""
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), doc_id).alias("draw"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*draws) if shards > 1 else draws[0])["s"]


def record_size(text: str) -> Column:
    return (F.octet_length(text_or_empty(text)) + 1).cast("long")


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 8,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows with their columns and ``shard``, ``slot`` (0, 1, ... in each shard) and ``grown_shard``.

    Rows without an identifier share one shard. Repeated rows are records of their own. An empty table gives no
    rows, a null text has one byte. The same rows get the same slots again. Only rows equal in identifier and text
    cannot be scattered over several buckets.
    """
    if shards < 1 or bucket_bytes < 1:
        raise ValueError("shards and bucket_bytes must be positive")
    shard, slot, grown, bucket, record, before, place = unused(
        docs, "shard", "slot", "grown_shard", "bucket", "record", "before", "place"
    )
    key = F.col(doc_id).cast("string")
    total = docs.agg(F.sum(record_size(text))).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    buckets = shards * per_shard
    scatter = F.pmod(F.xxhash64(F.lit(seed + 1), key, F.crc32(text_or_empty(text))), F.lit(per_shard))
    marked = docs.withColumns({shard: shard_of(key, shards, seed), grown: shard_of(key, shards + 1, seed)})
    marked = marked.withColumn(bucket, (F.col(shard) * per_shard + scatter).cast("int"))
    scattered = marked.repartition(buckets, bucket)
    # The number of records in each bucket, from a pass that reads no more than the bucket needs.
    counts = marked.groupBy(shard, bucket).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        counts.select(bucket, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)), "shard-offsets"
    )
    # One group per bucket, in a fixed order before the Fisher-Yates shuffle of F.shuffle.
    whole = [F.col(doc_id).alias("by_id"), F.crc32(text_or_empty(text)).alias("by_text")]
    whole += [F.struct(*[F.col(f"`{c}`") for c in (*docs.columns, shard, grown)]).alias("row")]
    groups = scattered.groupBy(bucket).agg(F.collect_list(F.struct(*whole)).alias(record))
    by_id = lambda a, b: (
        F.when(a["by_id"].eqNullSafe(b["by_id"]), F.when(a["by_text"] < b["by_text"], -1).when(a["by_text"] > b["by_text"], 1).otherwise(0))
        .when(a["by_id"].isNull() | (a["by_id"] < b["by_id"]), -1)
        .otherwise(1)
    )
    # F.shuffle draws from one stream per partition: buckets in order, so that each gets the same draws again.
    groups = groups.sortWithinPartitions(bucket).withColumn(record, F.shuffle(F.array_sort(record, by_id), seed))
    placed = groups.join(offsets, bucket).select(before, F.posexplode(record).alias(place, record))
    columns = [F.col(f"{record}.row.`{c}`").alias(c) for c in docs.columns]
    return placed.select(
        *columns,
        F.col(f"{record}.row.{shard}").alias(shard),
        (F.col(before) + F.col(place)).cast("long").alias(slot),
        F.col(f"{record}.row.{grown}").alias(grown),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the shards as folders ``shard=N`` of Parquet, records in the order of their slots within a file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
