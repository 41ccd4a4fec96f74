"""A training corpus from ``documents``, in five stages; each is written as Parquet and read back by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm import bpe, exact_dedup, jaccard_join, mixing, quality_rules
from bowline.staging import release_staged, stage, staged_count

# Encoding cannot be expressed in SQL: the pipeline is tested against plain Python instead.
ORACLE_SQL = None


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffles of earlier stages go, where nothing holds their plans any more; no table is deleted."""
    release_staged(spark, since=staged_count())


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the cutoffs come from ``labels``."""
    return quality_rules.quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest identifier."""
    drop_shuffles(spark)
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: five words, 80 per cent."""
    drop_shuffles(spark)
    return jaccard_join.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them."""
    drop_shuffles(spark)
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts, and the digest of the text that they decode to."""
    drop_shuffles(spark)
    coded = bpe.encode_and_decode(docs.select("doc_id", "text", "lang", "source"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix),
    ("BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after all stages. A stage's own tables, its input too, go when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = staged_count()
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-").lower())
        release_staged(spark, since=before, keep_last=True)
    return docs
