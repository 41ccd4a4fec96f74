"""Mixing sources to target weights.

Every source gets a target, in words. Its documents stand in a seeded random order and are drawn whole, in laps: full
laps first, then, from the same order, as many as the rest of the target takes. The drawn stream of a source is cut
into blocks of about equal size; the number of its blocks is the source's exact quota. A splitting tree deals the
quotas to the output shards: a node with some shards draws, from a multivariate hypergeometric distribution, how many
blocks of each source go to the left half of its shards, and both halves are split on. Then each shard gets its number
of blocks from the permuted blocks of each source, no block twice, and its documents are shuffled inside the shard.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm.common import bind, text_or_empty, unused, words_of
from bowline.staging import broadcast_if_small, measure, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_LAPS = 2
SHARDS = 8
BLOCKS_PER_SHARD = 64
SEED = 7
# Documents of a bucket of the random order, for a source of one such bucket; the number grows with the root of the source.
BUCKET = 64


def ratio(*parts: Column | int | str) -> Column:
    """A number in [0, 1) from a hash of ``parts``."""
    columns = [F.lit(p) if isinstance(p, int | str) else p for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, laps: int = MOST_LAPS) -> DataFrame:
    """(source, source_size, docs, nth, target): the share of all words, by weight, no source above ``laps`` times its size.

    Sources in code point order, null last, take the weights in turn. What a capped source leaves is shared by weight
    among the others until none is above its cap: sources by cap per weight, lowest first, are capped as long as
    the level of the others would lift them above it. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    everything = Window.partitionBy()
    ordered = everything.orderBy(F.col("source").asc_nulls_last())
    numbered = totals.withColumn("nth", F.row_number().over(ordered) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    caps = numbered.withColumns({"weight": weight, "cap": (laps * F.col("source_size")).cast("double")})
    lowest = everything.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(lowest), F.lit(0.0))
    budget = share * F.sum("source_size").over(everything)
    # The level if the sources before this one are capped and this one and the later ones are not.
    level = (budget - before("cap")) / (F.sum("weight").over(everything) - before("weight"))
    leveled = caps.withColumn("level", level)
    free = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("level"))
    # The first source that is not capped fixes the level of all later ones; behind it the levels only fall.
    water = F.max(free).over(everything)
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * water, F.col("cap")))
    return leveled.select("source", "source_size", "docs", "nth", target.alias("target"))


def draw_documents(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``sizes`` with its source's columns, ``laps`` (times the document is drawn) and ``start``, the words before it
    in its source's order. ``sizes`` has row (a number that tells equal rows apart), doc_id, source and size."""
    small = broadcast_if_small(targets, measure(targets, "source"))
    docs = sizes.join(small, sizes["source"].eqNullSafe(small["source"])).drop(small["source"])
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    docs = docs.withColumns(
        {
            "draw": ratio(seed, F.col("doc_id").cast("string"), F.col("source"), F.col("size")),
            "buckets": F.greatest(F.floor(F.sqrt(F.col("docs") / BUCKET)), F.lit(1)),
            "full": full,
            "rest": F.col("target") - full * F.col("source_size"),
        }
    ).withColumn("bucket", F.floor(F.col("draw") * F.col("buckets")).cast("int"))
    # Two levels of running sums, so that the order of a large source is never in one task.
    per_bucket = docs.groupBy("nth", "bucket").agg(F.sum("size").alias("bucket_size"))
    by_bucket = Window.partitionBy("nth").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("offset", F.coalesce(F.sum("bucket_size").over(by_bucket), F.lit(0)))
    placed = docs.join(offsets.withColumnsRenamed({"nth": "nth_", "bucket": "bucket_"}), (F.col("nth") == F.col("nth_")) & (F.col("bucket") == F.col("bucket_"))).drop("nth_", "bucket_")
    in_bucket = Window.partitionBy("nth", "bucket").orderBy("draw", "doc_id", "row")
    placed = placed.withColumn("start", F.col("offset") + F.sum("size").over(in_bucket) - F.col("size"))
    placed = stage(placed, "mix-placed")
    chosen = placed.join(fill_targets(placed).withColumnRenamed("row", "row_"), F.col("row") == F.col("row_"), "left")
    return chosen.select(
        "row", "doc_id", "source", "size", "nth", "source_size", "target", "start", "draw",
        (F.col("full") + F.col("row_").isNotNull().cast("int")).cast("int").alias("laps"),
    )


def fill_targets(placed: DataFrame) -> DataFrame:
    """(row) of the documents that fill the rest of their source's target.

    A round takes, of the documents that fit the room left, whole buckets and, in the bucket that the room ends in,
    documents in order. What still fits then, in any bucket, is the next round's, until no document fits; the room is
    below the size of a document that was passed over, so rounds are few.
    """
    fitting = "size > 0 AND size <= room"
    left = placed.select("row", "doc_id", "nth", "bucket", "draw", "size", F.col("rest").alias("room")).filter(fitting)
    by_bucket = Window.partitionBy("nth").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_bucket = Window.partitionBy("nth", "bucket").orderBy("draw", "doc_id", "row")
    same = lambda *keys: reduce(Column.__and__, [F.col(k) == F.col(f"{k}_") for k in keys])
    picked = []
    while True:
        sums = left.groupBy("nth", "bucket").agg(F.sum("size").alias("bucket_size"))
        sums = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(by_bucket), F.lit(0)))
        sums = stage(sums.withColumnsRenamed({"nth": "nth_", "bucket": "bucket_"}), "mix-buckets")
        # One row per bucket, and per source.
        sums = broadcast_if_small(sums, measure(sums, "nth_"))
        tried = left.join(sums, same("nth", "bucket")).drop("nth_", "bucket_")
        whole = F.col("offset") + F.col("bucket_size") <= F.col("room")
        ends = tried.filter(~whole & (F.col("offset") < F.col("room")))
        ends = ends.withColumn("end", F.col("offset") + F.sum("size").over(in_bucket)).filter("end <= room")
        taken = stage(tried.filter(whole).select("row", "nth", "size").union(ends.select("row", "nth", "size")), "mix-taken")
        picked.append(taken.select("row"))
        used = taken.groupBy(F.col("nth").alias("nth_")).agg(F.sum("size").alias("used"))
        used = broadcast_if_small(used, measure(used, "nth_"))
        rest = left.join(used, same("nth"), "left").withColumn("room", F.col("room") - F.coalesce("used", F.lit(0)))
        rest = rest.drop("nth_", "used").filter(fitting)
        left = stage(rest.join(taken.select("row"), "row", "left_anti").select(*left.columns), "mix-left")
        if left.isEmpty():
            return reduce(DataFrame.union, picked)


def hypergeometric(population: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """The number of marked items among ``drawn`` of a population, by inverting the distribution at ``u``."""
    low = F.greatest(F.lit(0), drawn + marked - population).cast("long")
    high = F.least(marked, drawn).cast("long")
    upto = lambda n: F.filter(F.sequence(F.lit(0).cast("long"), n.cast("long")), lambda i: i < n)
    logs = lambda a, n: F.aggregate(  # noqa: E731  log of prod (a - i) / (population - i)
        upto(n), F.lit(0.0), lambda acc, i: acc + F.log((a - i) / (population - i))
    )
    first = F.when(low == 0, logs(population - marked, drawn)).otherwise(logs(marked, population - drawn))
    grown = lambda k: F.log(
        (marked - k) * (drawn - k) / ((k + 1) * (population - marked - drawn + k + 1)).cast("double")
    )
    state = lambda log, total, x: F.struct(log.alias("log"), total.alias("sum"), x.alias("x"))
    count = lambda start: F.aggregate(
        F.sequence(low, high),
        state(start, F.lit(0.0), F.lit(None).cast("long")),
        lambda acc, k: state(
            F.when(k < high, acc["log"] + grown(k)).otherwise(acc["log"]),
            acc["sum"] + F.exp(acc["log"]),
            F.coalesce(acc["x"], F.when(u < acc["sum"] + F.exp(acc["log"]), k)),
        ),
        lambda acc: F.coalesce(acc["x"], high),  # rounding may leave the sum below u
    )
    return bind(first.cast("double"), count)


def draw_left(seed: int, level: int) -> Callable[[Column, Column], Column]:
    """Folds the quotas of a node: of each source, given the draws before it, the blocks that go to the left half."""

    def step(acc: Column, quota: Column) -> Column:
        u = ratio(seed, 2, level, F.col("lo"), quota["nth"])
        taken = hypergeometric(acc["population"], quota["blocks"], acc["drawn"], u)
        return bind(
            taken,
            lambda t: F.struct(
                (acc["population"] - quota["blocks"]).alias("population"),
                (acc["drawn"] - t).alias("drawn"),
                F.concat(acc["out"], F.array(F.struct(quota["nth"].alias("nth"), t.alias("blocks")))).alias("out"),
            ),
        )

    return step


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """From one row ``quotas``, an array of (nth, blocks), to (shard, quotas): the splitting tree, a level at a time."""
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "quotas")
    total = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda a, x: a + x["blocks"])
    levels = max(0, (shards - 1).bit_length())
    for level in range(levels):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        # Blocks go to the halves in proportion to their shards, a remainder by a draw.
        exact = F.col("all") * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))
        left = F.floor(exact + ratio(seed, 1, level, F.col("lo"))).cast("long")
        nodes = nodes.withColumn("all", total(F.col("quotas"))).withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, left).otherwise(F.col("all")))
        empty = F.array().cast("array<struct<nth:int,blocks:bigint>>")
        start = F.struct(F.col("all").alias("population"), F.col("left").alias("drawn"), empty.alias("out"))
        halves = nodes.withColumn("first", F.aggregate("quotas", start, draw_left(seed, level), lambda acc: acc["out"]))
        second = F.zip_with(
            "quotas", "first", lambda a, b: F.struct(a["nth"].alias("nth"), (a["blocks"] - b["blocks"]).alias("blocks"))
        )
        pair = F.array(
            F.struct(F.col("lo").alias("lo"), F.greatest(mid, F.col("lo") + 1).alias("hi"), F.col("first").alias("quotas")),
            F.struct(mid.alias("lo"), F.col("hi").alias("hi"), second.alias("quotas")),
        )
        split = F.when(F.col("hi") - F.col("lo") > 1, pair).otherwise(F.slice(pair, 1, 1))
        # A level's nodes are written down: their draws are made once.
        nodes = stage(halves.select(F.inline(split)), "mix-tree")
    return nodes.select(F.col("lo").alias("shard"), "quotas")


def block_shards(drawn: DataFrame, shards: int, seed: int) -> DataFrame:
    """(nth, block, shard) for every block of the drawn streams; ``drawn`` has a row per draw with nth and block."""
    blocks = drawn.select("nth", "block").distinct()
    permuted = Window.partitionBy("nth").orderBy(ratio(seed, 3, F.col("nth"), F.col("block")), "block")
    ranked = blocks.withColumn("place", F.row_number().over(permuted) - 1)
    counted = blocks.groupBy("nth").agg(F.count("*").alias("blocks"))
    quotas = counted.agg(F.sort_array(F.collect_list(F.struct("nth", "blocks"))).alias("quotas"))
    dealt = split_quotas(quotas, shards, seed).select("shard", F.inline("quotas"))
    before = Window.partitionBy("nth").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ends = dealt.withColumn("from", F.coalesce(F.sum("blocks").over(before), F.lit(0))).filter("blocks > 0")
    places = ends.select("nth", "shard", F.explode(F.expr("sequence(from, from + blocks - 1)")).alias("place"))
    return ranked.join(places, ["nth", "place"]).select("nth", "block", "shard")


def plan_mix(
    sizes: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    laps: int = MOST_LAPS,
    shards: int = SHARDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``sizes`` (row, doc_id, source, size) with source_size, target, taken and ``shards``.

    ``shards`` has one element for each time the document is drawn: the output shard and the order in it. A document
    without words has a size of 0: it is drawn with its source's full laps and takes nothing. All reruns agree.
    """
    targets = stage(source_targets(sizes, weights, share, laps), "mix-targets")
    drawn = stage(draw_documents(sizes, targets, seed), "mix-drawn")
    words = drawn.agg(F.sum(F.col("size") * F.col("laps"))).first()[0] or 0
    block_words = max(1, -(-words // (shards * blocks_per_shard)))
    lapped = drawn.filter("laps > 0").withColumn("lap", F.explode(F.sequence(F.lit(1), F.col("laps"))))
    position = (F.col("lap") - 1) * F.col("source_size") + F.col("start")
    lapped = lapped.withColumn("block", F.floor(position / block_words).cast("long"))
    dealt = lapped.join(stage(block_shards(lapped, shards, seed), "mix-blocks"), ["nth", "block"])
    order = F.xxhash64(F.lit(seed + 1), F.col("doc_id").cast("string"), F.col("size"), F.col("lap"))
    draws = dealt.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("shard", order.alias("order")))).alias("shards"))
    out = drawn.join(draws, "row", "left")
    none = F.array().cast("array<struct<shard:int,order:bigint>>")
    return out.select(
        "row", "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * F.col("laps")).alias("taken"), F.coalesce("shards", none).alias("shards"),
    )


def number_rows(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", row: str | None = None
) -> DataFrame:
    """(row, doc_id, source, size) of every row, written down, so that ``row``, where it is numbered here, stays the same."""
    rows = docs.select(
        (F.monotonically_increasing_id() if row is None else F.col(row)).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.size(words_of(text_or_empty(text))).cast("long").alias("size"),
    )
    return stage(rows, "mix-sizes")


def file_places(docs: DataFrame) -> Column | None:
    """The place of every row of a table that is read as it lies in files: the same in every scan. None: it is not.

    Steps behind the scan may repeat rows or draw them anew, so only the scan itself counts.
    """
    plan = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if plan != "LogicalRelation" or "_metadata" in (c.lower() for c in docs.columns):
        return None
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:  # a format without places
        return None
    place = F.encode(F.col("_metadata.row_index").cast("string"), "utf-8")
    return F.concat(F.unhex(F.md5("_metadata.file_path")), place)


def mix_sources(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", placed: bool = False, **options
) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn, by output shard and in shuffled order inside it.

    With ``placed`` the columns ``mix_shard`` and ``mix_order`` are added. See ``plan_mix`` for the options and
    ``source_targets`` for the targets. Null texts have no words; null sources are a source; an empty table gives no
    rows. A table in files is not copied: file and place tell its rows apart. Other rows are written down first.
    """
    row, shard, order = unused(docs, "row", "mix_shard", "mix_order")
    place = file_places(docs)
    if place is None:
        numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    else:
        numbered = docs.withColumn(row, place)
    sizes = number_rows(numbered, text, doc_id, source, row)
    drawn = plan_mix(sizes, **options).select(F.col("row").alias(row), F.inline("shards").alias(shard, order))
    out = numbered.join(drawn, row).repartition(shard, F.pmod(order, F.lit(16))).sortWithinPartitions(shard, order)
    return out.select(*docs.columns, shard, order) if placed else out.select(*docs.columns)
