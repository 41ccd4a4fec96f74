"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.llm import (
    bpe,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    license_scan,
    line_dedup,
    lm,
    mixing,
    quality_classifier,
    quality_rules,
    rank_bpe,
    sharding,
    whitening,
)
from bowline.staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; combined cutoffs certified by language on ``labels``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.judge(docs, labels, combined=True).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept"
    )


# The cutoff of every signal in every step of the combined rules.
GRID_SQL = ", ".join(
    f"('{signal}', {rank}, CAST({cutoffs[min(rank, len(cutoffs) - 1)]} AS DOUBLE))"
    for signal, cutoffs in quality_rules.GRID.items()
    for rank in range(max(map(len, quality_rules.GRID.values())))
)
RISK_SQL = f"CAST({quality_rules.TOTAL_RISK!r} AS DOUBLE)"

ORACLE["op1_quality_rules"] = rf"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS x FROM documents),
split AS (
    SELECT *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS words,
           list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS times FROM windows) WHERE times > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM twice) GROUP BY doc_id
), counted AS (
    SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
           length(regexp_replace(x, '[^!?]+', '', 'g')) AS n_exclaim,
           length(regexp_replace(x, '[^A-Z]+', '', 'g')) AS n_upper,
           length(regexp_replace(x, '[^A-Za-z0-9]+', '', 'g')) AS n_alnum
    FROM split LEFT JOIN covered USING (doc_id)
), based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), signals AS (
    SELECT doc_id, lang, base_failed, unnest([
        {{'signal': 'symbol_share', 'v': coalesce(n_symbols / nullif(n_words, 0), 0.0)}},
        {{'signal': 'exclaim_share', 'v': coalesce(n_exclaim / nullif(n_words, 0), 0.0)}},
        {{'signal': 'upper_share', 'v': coalesce(n_upper / nullif(n_alnum, 0), 0.0)}},
        {{'signal': 'dup_line_share', 'v': coalesce(n_dup_lines / nullif(n_lines, 0), 0.0)}},
        {{'signal': 'repeat_share', 'v': coalesce(n_repeat_words / nullif(n_words, 0), 0.0)}},
        {{'signal': 'long_words', 'v': coalesce(word_chars / nullif(n_words, 0), 0.0)}}], recursive := true)
    FROM based
), verdicts AS (
    SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id
), holdout AS (SELECT * FROM signals JOIN verdicts USING (doc_id) WHERE NOT base_failed
), grid(signal, rank, cutoff) AS (VALUES {GRID_SQL}
), steps AS (
    SELECT doc_id, lang, good, rank, bool_or(v >= cutoff) AS hit FROM holdout JOIN grid USING (signal)
    GROUP BY doc_id, lang, good, rank
), tried AS (
    SELECT lang, rank, count(*) FILTER (good) AS n, count(*) FILTER (good AND hit) AS k,
           count(*) FILTER (NOT good) AS bad, count(*) FILTER (NOT good AND hit) AS caught
    FROM steps GROUP BY lang, rank
), valued AS (
    SELECT *, CASE WHEN k <= n * {RISK_SQL} THEN list_sum(list_transform(range(0, k + 1), lambda i:
               exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK_SQL}) + (n - i) * ln(1 - {RISK_SQL}))))
               ELSE 1.0 END AS p
    FROM tried
), tested AS (
    SELECT *, sum(CAST(p > {quality_rules.ERROR} / (SELECT count(DISTINCT coalesce(lang, '-')) FROM holdout)
               AS INTEGER)) OVER (PARTITION BY lang ORDER BY rank) AS failures,
           coalesce(caught / nullif(bad, 0) - k / nullif(n, 0), 0.0) AS gain
    FROM valued
), best AS (
    SELECT lang, rank FROM tested WHERE failures = 0 AND n > 0 AND gain > 0
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY gain DESC, rank) = 1
), rejected AS (
    SELECT DISTINCT doc_id FROM signals s JOIN best b ON s.lang IS NOT DISTINCT FROM b.lang
    JOIN grid g ON g.signal = s.signal AND g.rank = b.rank AND s.v >= g.cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected WHERE doc_id IS NOT NULL) AS kept
FROM based
"""


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE["op2_exact_dedup"] = r"""
WITH normal AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of ``labels.quality``, learned on those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    weights = quality_classifier.fit(docs, labels.filter(~quality_classifier.held_out()))
    scored = quality_classifier.score(docs, weights)
    return scored.select(
        "doc_id",
        quality_classifier.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=8)
    return shuffled.select(
        "doc_id",
        sharding.record_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the lines that are boilerplate of their hosts, as counts and a digest."""
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"), keep=("page_id",))
    return cleaned.select(
        "page_id", "host", "n_lines", "n_dropped", F.sha2("clean_text", 256).alias("clean_sha256")
    )


ORACLE["op5_line_dedup"] = r"""
WITH shown AS (
    SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
           regexp_replace(regexp_replace(coalesce(html, ''),
               '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<template\b.*?</template\s*>',
               chr(10), 'g'), '(?s)<[^>]*>', chr(10), 'g') AS body
    FROM pages
), paged AS (
    SELECT page_id, host, list_filter(list_transform(string_split(body, chr(10)),
               lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS lines
    FROM shown
), hosts AS (SELECT host, count(*) AS host_pages FROM paged GROUP BY host
), counted AS (
    SELECT host, line, count(DISTINCT page_id) AS pages
    FROM (SELECT page_id, host, unnest(list_distinct(lines)) AS line FROM paged) GROUP BY host, line
), boilerplate AS (
    SELECT host, list(line) AS gone FROM counted JOIN hosts USING (host)
    WHERE pages >= 3 AND pages > host_pages * 0.2 GROUP BY host
), stay AS (
    SELECT page_id, host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS kept
    FROM paged LEFT JOIN boilerplate USING (host)
)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS clean_sha256
FROM stay
"""


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and the output shards of its draws."""
    plan = mixing.plan_mix(mixing.number_rows(table(spark, sf_dir, "documents")))
    return plan.select(
        "doc_id", "size", "source_size", "target", "taken", F.array_join("shards.shard", ",").alias("shards")
    )


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word sets are 90 per cent similar."""
    return jaccard_join.link(table(spark, sf_dir, "documents"), ngram=3, threshold=90)


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and scores of all documents."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
    )


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and, decoded from them, texts of all documents, as digests."""
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the attention model and by the unigram base."""
    scored = lm.score_documents(table(spark, sf_dir, "documents"))
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))


@query
def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by merge ranks and, decoded from them, bytes of all documents, as digests."""
    coded = rank_bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), packed=True)
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings on their first 8 components, of unit variance each."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    moved = stage(whitening.transform(vectors, model), "whitened")
    error = whitening.identity_error(moved, len(model.values))
    share = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    return moved.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, by its positives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, anchors=F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = r"""
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(CAST(c AS DOUBLE)))) = len(embedding)
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
           CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
"""
