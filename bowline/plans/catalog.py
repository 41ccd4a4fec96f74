"""The registered queries over the given tables, and the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.functions.labels import base26_code, label_from_path
from bowline.functions.vectors import split_numbers
from bowline.operators import docvectors, evaluate, selection, vocabulary, weighting
from bowline.operators.long_stages import long_pipeline
from bowline.operators.stages import CommonElementFilter, WordCountToVec
from bowline.operators.vocabulary import WordTable
from bowline.operators.trainer import Network, loss_and_gradient
from bowline.plans.classification import class_count as count_classes
from bowline.plans.classification import class_list, classify, classify_directory
from bowline.plans.preprocessing import fit_preprocessing, preprocess, preprocess_directory
from bowline.plans.training_sql import Plan, predictions_ctes, training_ctes
from bowline.sources.processed import read_processed, write_processed
from bowline.sources.raw import (
    TRAINING,
    VALIDATION,
    encode_labels,
    fit_labels,
    malformed_lines,
    parse_lines,
    raw_contents,
    raw_documents,
    read_raw,
    write_raw,
)
from bowline.sources.text import (
    bow_from_text,
    document_bow,
    ids_unique,
    labelled_bow,
    read_documents,
    read_labels,
    read_table,
)
from bowline.staging import BROADCAST_ROWS, release_staged, stage, staged_count, staged_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DROP_FREQ = 0.1
MIN_DOC_FREQ = 2
NUM_TOP_FEATURES = 8000
DIGITS = 6


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


# --- SQL building blocks -------------------------------------------------------------------------------------------

BOW_SQL = r"""
pieces AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \n\t\r]+')) AS word FROM documents),
bow AS (
  SELECT doc_id, word, CAST(count(*) AS INTEGER) AS word_count FROM pieces WHERE word <> '' GROUP BY doc_id, word)"""

KEEP_SQL = f"""
keep AS (
  SELECT word FROM bow GROUP BY word
  HAVING count(*) < CAST({DROP_FREQ} AS DOUBLE) * (SELECT count(DISTINCT doc_id) FROM bow))"""

DICTIONARY_SQL = """
dictionary AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_index FROM keep)"""

# Whole documents table, label where there is one.
FEATURES_SQL = f"""
{BOW_SQL}, {KEEP_SQL}, {DICTIONARY_SQL},
features AS (
  SELECT b.doc_id, l.quality AS label, d.word_index, CAST(sum(b.word_count) AS DOUBLE) AS value
  FROM bow b JOIN dictionary d USING (word) LEFT JOIN labels l ON l.doc_id = b.doc_id
  GROUP BY b.doc_id, l.quality, d.word_index)"""

IDF_SQL = f"""
frequencies AS (
  SELECT word_index, sum(CASE WHEN value > 0 THEN 1 ELSE 0 END) AS doc_freq FROM features GROUP BY word_index),
universe AS (SELECT count(DISTINCT doc_id) AS m FROM features),
weights AS (
  SELECT word_index, CAST(doc_freq AS BIGINT) AS doc_freq,
         CASE WHEN doc_freq < {MIN_DOC_FREQ} THEN 0.0 ELSE ln((m + 1.0) / (doc_freq + 1.0)) END AS idf
  FROM frequencies, universe)"""


def labelled_features_sql(label: str, source: str) -> str:
    """Features of the documents that ``source`` labels; vocabulary and IDF from those documents only."""
    return f"""
{BOW_SQL.replace("FROM documents", f"FROM documents WHERE doc_id IN (SELECT doc_id FROM {source})")},
{KEEP_SQL}, {DICTIONARY_SQL},
features AS (
  SELECT b.doc_id, l.{label} AS label, d.word_index, CAST(b.word_count AS DOUBLE) AS value
  FROM bow b JOIN dictionary d USING (word) JOIN {source} l ON l.doc_id = b.doc_id),
{IDF_SQL},
weighted AS (
  SELECT f.doc_id, f.label, f.word_index, w.idf * CASE WHEN f.value > 0 THEN 1.0 ELSE 0.0 END AS value
  FROM features f JOIN weights w USING (word_index)),
classes AS (SELECT label, count(DISTINCT doc_id) AS n FROM features GROUP BY label),
hits AS (SELECT word_index, label, count(*) AS present FROM weighted WHERE value <> 0 GROUP BY word_index, label),
totals AS (SELECT word_index, sum(present) AS df FROM hits GROUP BY word_index),
grid AS (
  SELECT t.word_index, t.df, c.n, u.m, coalesce(h.present, 0) AS present
  FROM totals t CROSS JOIN classes c CROSS JOIN universe u
  LEFT JOIN hits h ON h.word_index = t.word_index AND h.label = c.label),
scored AS (
  SELECT word_index, any_value(df) AS df, sum(
    pow(present - df * n / CAST(m AS DOUBLE), 2) / (df * n / CAST(m AS DOUBLE))
    + pow((n - present) - (m - df) * n / CAST(m AS DOUBLE), 2) / ((m - df) * n / CAST(m AS DOUBLE))) AS chi2
  FROM grid WHERE df < m GROUP BY word_index),
statistics AS (
  SELECT d.word_index, d.word, CAST(coalesce(t.df, 0) AS BIGINT) AS doc_freq,
         round(coalesce(s.chi2, 0.0), {DIGITS}) AS chi2
  FROM dictionary d LEFT JOIN totals t USING (word_index) LEFT JOIN scored s USING (word_index)),
chosen AS (
  SELECT word_index, word, doc_freq, chi2 FROM statistics ORDER BY chi2 DESC, word_index LIMIT {NUM_TOP_FEATURES})"""


# --- Spark building blocks -----------------------------------------------------------------------------------------


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, DIGITS) for n in names})


def all_features(spark: SparkSession, sf: str) -> tuple[DataFrame, WordTable]:
    """Features of every document, label where there is one."""
    bow = stage(labelled_bow(spark, sf, "quality", "left"), "bow")
    dictionary = vocabulary.fit_vocabulary(bow, DROP_FREQ)
    return docvectors.document_features(bow, dictionary, merged=True), dictionary


def quality_bow(spark: SparkSession, sf: str) -> DataFrame:
    return stage(labelled_bow(spark, sf, "quality"), "bow")


def lang_bow(spark: SparkSession, sf: str) -> DataFrame:
    return stage(document_bow(spark, sf, "lang").withColumnRenamed("lang", "label"), "bow")


def scored_features(bow: DataFrame) -> tuple[DataFrame, WordTable]:
    """Chi-square of every vocabulary word, by the stand-alone operators on the long feature table."""
    dictionary = vocabulary.fit_vocabulary(bow, DROP_FREQ)
    features = stage(weighting.binarize(docvectors.document_features(bow, dictionary, merged=True)), "features")
    weighted = weighting.apply_idf(features, weighting.fit_idf(features, MIN_DOC_FREQ, dictionary.size))
    totals = selection.fit_class_totals(features)
    scores = selection.chi2_statistics(selection.presence_by_class(weighted), totals)
    return scores.withColumn("chi2", F.round("chi2", DIGITS)), dictionary


# --- loading and words ---------------------------------------------------------------------------------------------


@query(f"WITH {BOW_SQL} SELECT doc_id, word, word_count FROM bow")
def bow_load(spark: SparkSession, sf: str) -> DataFrame:
    return document_bow(spark, sf)


@query(r"""
WITH texts AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
numbered AS (
  SELECT doc_id, word || ' ' || CAST(count(*) AS VARCHAR) AS line
  FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \n\t\r]+')) AS word FROM documents)
  WHERE word <> '' GROUP BY doc_id, word),
lines AS (SELECT * FROM texts UNION ALL SELECT * FROM numbered),
fields AS (SELECT doc_id, string_split(line, ' ') AS f FROM lines)
SELECT doc_id, nullif(trim(lower(f[1]), ' '), '') AS word, TRY_CAST(f[2] AS INTEGER) AS word_count FROM fields
WHERE len(f) = 2 AND regexp_full_match(f[2], '[+-]?[0-9]+') AND TRY_CAST(f[2] AS INTEGER) IS NOT NULL""")
def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The line rule of the raw scan on lines made from the documents: "word count" lines and plain prose."""
    docs = read_documents(spark, sf, "doc_id", "text")
    prose = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    unique = ids_unique(read_table(spark, sf, "documents", "doc_id"), "doc_id")
    counted = bow_from_text(docs, unique=unique, lower=False)
    lines = prose.unionByName(counted.select("doc_id", F.concat_ws(" ", "word", "word_count").alias("line")))
    # A third field is enough to leave a line out.
    return parse_lines(lines.select("doc_id", F.split("line", " ", 3).alias("fields")))


@query(f"WITH {BOW_SQL} SELECT count(DISTINCT doc_id) AS num_docs FROM bow")
def doc_count(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.document_count(document_bow(spark, sf))


@query(f"WITH {BOW_SQL} SELECT count(DISTINCT doc_id) AS num_docs, true AS within FROM bow")
def doc_count_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of two slices of the documents, merged; whether the estimate is within its bound of the exact count."""
    bow = stage(document_bow(spark, sf), "bow")
    slices = [vocabulary.document_sketch(bow.filter(f"doc_id % 2 = {n}")) for n in (0, 1)]
    merged = vocabulary.merge_document_sketches(slices[0].unionByName(slices[1]))
    exact = vocabulary.document_count(bow)
    error = F.abs(F.col("estimate") - F.col("num_docs")) / F.col("num_docs")
    bound = vocabulary.SKETCH_DEVIATIONS * vocabulary.sketch_error()
    return exact.select("*", merged.select("estimate").scalar().alias("estimate")).select("num_docs", (error <= bound).alias("within"))


@query(f"WITH {BOW_SQL} SELECT word, count(*) AS num_docs FROM bow GROUP BY word")
def word_doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.word_frequencies(document_bow(spark, sf))


@query(f"WITH {BOW_SQL}, {KEEP_SQL} SELECT word FROM keep")
def keep_words(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.keep_words(stage(document_bow(spark, sf), "bow"), DROP_FREQ)


COMMON_SQL = f"""WITH {BOW_SQL}, {KEEP_SQL}
SELECT doc_id, word, word_count FROM bow WHERE word IN (SELECT word FROM keep)"""


@query(COMMON_SQL)
def common_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted and applied on the same table: a broadcast anti-join with the few common words."""
    return vocabulary.drop_common(stage(document_bow(spark, sf), "bow"), DROP_FREQ)


@query(COMMON_SQL)
def keep_words_join(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted keep-words applied by a join, as for a second data set."""
    bow = stage(document_bow(spark, sf), "bow")
    return vocabulary.filter_common(bow, vocabulary.fit_common_words(bow, DROP_FREQ))


def as_if_large(words: WordTable) -> WordTable:
    """The table with a measured size beyond the broadcast limit, so that it is joined in a shuffle."""
    return replace(words, size=replace(words.size, rows=BROADCAST_ROWS + 1))


@query(COMMON_SQL)
def keep_words_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The same join as a shuffle, hot words under salts."""
    bow = stage(document_bow(spark, sf), "bow")
    return vocabulary.filter_common(bow, as_if_large(vocabulary.fit_common_words(bow, DROP_FREQ)))


@query(f"WITH {BOW_SQL}, {KEEP_SQL}, {DICTIONARY_SQL} SELECT word, word_index FROM dictionary")
def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    bow = stage(document_bow(spark, sf), "bow")
    return vocabulary.fit_vocabulary(bow, DROP_FREQ).table.select("word", "word_index")


# --- vectors -------------------------------------------------------------------------------------------------------


@query(f"WITH {FEATURES_SQL} SELECT doc_id, label, word_index, value FROM features")
def doc_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return all_features(spark, sf)[0]


@query(f"WITH {FEATURES_SQL} SELECT doc_id, label, word_index, value FROM features")
def doc_vectors_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary join as a shuffle."""
    bow = stage(labelled_bow(spark, sf, "quality", "left"), "bow")
    dictionary = as_if_large(vocabulary.fit_vocabulary(bow, DROP_FREQ))
    return docvectors.document_features(bow, dictionary, merged=True)


CSV_SQL = f"""WITH {FEATURES_SQL},
size AS (SELECT CAST(count(*) AS INTEGER) AS num_features FROM dictionary)
SELECT {{columns}} num_features,
  string_agg(CAST(word_index AS VARCHAR), ',' ORDER BY word_index) AS word_indices_str,
  string_agg(CAST(value AS VARCHAR), ',' ORDER BY word_index) AS word_counts_str,
  label
FROM features, size GROUP BY doc_id, label, num_features"""


def csv_ready(spark: SparkSession, sf: str) -> DataFrame:
    features, dictionary = all_features(spark, sf)
    packed = docvectors.pack_documents(features, scattered=not dictionary.size.fits_broadcast)
    return docvectors.to_csv_columns(packed, dictionary.size.rows, keys=["doc_id"])


@query(CSV_SQL.format(columns="doc_id,"))
def doc_vectors_csv(spark: SparkSession, sf: str) -> DataFrame:
    return csv_ready(spark, sf)


@query(CSV_SQL.format(columns=""))
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Written as CSV, read back, parsed to arrays, wrapped as ML vectors, unwrapped and joined again."""
    folder = staged_folder(spark, "csv")
    write_processed(csv_ready(spark, sf), folder)
    arrays = docvectors.from_csv_columns(read_processed(spark, folder))
    size = docvectors.feature_count(arrays)
    vectors = docvectors.with_vector(arrays.select("label", "indices", "values"), size, "word_vector")
    return docvectors.to_csv_columns(docvectors.from_vector(vectors, "word_vector"), size)


@query(f"""WITH {FEATURES_SQL}
SELECT doc_id, label, word_index, CAST(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value FROM features""")
def binarized(spark: SparkSession, sf: str) -> DataFrame:
    return weighting.binarize(all_features(spark, sf)[0])


@query(f"WITH {FEATURES_SQL}, {IDF_SQL} SELECT word_index, doc_freq, round(idf, {DIGITS}) AS idf FROM weights")
def idf_weights(spark: SparkSession, sf: str) -> DataFrame:
    features = stage(weighting.binarize(all_features(spark, sf)[0]), "features")
    return weighting.idf_weights(features, MIN_DOC_FREQ).withColumn("idf", F.round("idf", DIGITS))


@query(f"""WITH {FEATURES_SQL}, {IDF_SQL}
SELECT f.doc_id, f.label, f.word_index,
  round(w.idf * CASE WHEN f.value > 0 THEN 1.0 ELSE 0.0 END, {DIGITS}) AS value
FROM features f JOIN weights w USING (word_index)""")
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    features, fitted = all_features(spark, sf)
    features = stage(weighting.binarize(features), "features")
    weighted = weighting.apply_idf(features, weighting.fit_idf(features, MIN_DOC_FREQ, fitted.size))
    return weighted.withColumn("value", F.round("value", DIGITS))


# --- selection -----------------------------------------------------------------------------------------------------


@query(f"WITH {labelled_features_sql('quality', 'labels')} SELECT word_index, doc_freq, chi2 FROM statistics")
def chi2_stat(spark: SparkSession, sf: str) -> DataFrame:
    return scored_features(quality_bow(spark, sf))[0]


@query(f"""WITH {labelled_features_sql('lang', 'documents')}
SELECT word_index, doc_freq, chi2, row_number() OVER (ORDER BY word_index) - 1 AS feature FROM chosen""")
def chi2_topk_operators(spark: SparkSession, sf: str) -> DataFrame:
    """Four classes, every document labelled; one stand-alone operator after the other."""
    return selection.fit_selection(scored_features(lang_bow(spark, sf))[0], NUM_TOP_FEATURES).table


TOPK_COLUMNS_SQL = f"""
SELECT c.word, w.doc_freq, round(w.idf, {DIGITS}) AS idf, c.chi2,
  row_number() OVER (ORDER BY c.word_index) - 1 AS feature FROM chosen c JOIN weights w USING (word_index)"""


def selected_features(bow: DataFrame) -> DataFrame:
    """The same selection by the one-plan fit, which needs neither a dictionary nor a feature table."""
    model = fit_preprocessing(bow, "doc_id", "label", DROP_FREQ, MIN_DOC_FREQ, NUM_TOP_FEATURES)
    return rounded(model.selected.table.select("word", "doc_freq", "idf", "chi2", "feature"), "idf", "chi2")


@query(f"WITH {labelled_features_sql('quality', 'labels')} {TOPK_COLUMNS_SQL}")
def chi2_topk(spark: SparkSession, sf: str) -> DataFrame:
    return selected_features(quality_bow(spark, sf))


@query(f"WITH {labelled_features_sql('lang', 'documents')} {TOPK_COLUMNS_SQL}")
def chi2_topk_lang(spark: SparkSession, sf: str) -> DataFrame:
    return selected_features(lang_bow(spark, sf))


# --- labels --------------------------------------------------------------------------------------------------------


def lettered_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One class name of three letters per document: its language and a letter from its length."""
    docs = read_table(spark, sf, "documents", "doc_id", "lang", "source", "n_chars")
    letter = F.char(F.lit(65) + F.col("n_chars") % 26)
    return docs.select("doc_id", "source", F.concat(F.upper("lang"), letter).alias("letters"))


LETTERS_SQL = """
lettered AS (
  SELECT doc_id, source, upper(lang) || chr(CAST(65 + n_chars % 26 AS INTEGER)) AS letters FROM documents)"""


@query(f"""WITH {LETTERS_SQL}
SELECT doc_id, letters, CAST(
  (ascii(letters[1]) - 65) + (ascii(letters[2]) - 65) * 26 + (ascii(letters[3]) - 65) * 676 AS INTEGER) AS label
FROM lettered""")
def label_base26(spark: SparkSession, sf: str) -> DataFrame:
    return lettered_documents(spark, sf).select("doc_id", "letters", base26_code("letters").alias("label"))


@query(f"""WITH {LETTERS_SQL} SELECT doc_id, letters AS label_str FROM lettered""")
def label_from_directory(spark: SparkSession, sf: str) -> DataFrame:
    """The class is the parent directory, whatever other directories above it are called."""
    docs = lettered_documents(spark, sf)
    path = F.concat(F.lit("/myclass/"), "source", F.lit("/class"), "letters", F.lit("/"), "doc_id", F.lit(".res"))
    return docs.select("doc_id", label_from_path(path, strict=True).alias("label_str"))


@query(f"""WITH {LETTERS_SQL}
SELECT letters AS label_str, CAST(row_number() OVER (ORDER BY letters) - 1 AS INTEGER) AS label
FROM (SELECT DISTINCT letters FROM lettered)""")
def label_dense(spark: SparkSession, sf: str) -> DataFrame:
    return fit_labels(lettered_documents(spark, sf), "letters")


@query("""SELECT lang AS label_str, CAST(CASE lang WHEN 'en' THEN 0 WHEN 'es' THEN 1 WHEN 'fr' THEN 2 ELSE -1 END AS INTEGER) AS label,
  count(*) AS num_docs FROM documents GROUP BY lang""")
def label_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Class ids from documents without the German ones, given to all: a class that was not seen is -1."""
    docs = read_table(spark, sf, "documents", "doc_id", F.col("lang").alias("label_str"), F.lit(None).cast("int").alias("label"))
    encoded = encode_labels(docs, fit_labels(docs.filter("label_str <> 'de'")))
    return encoded.groupBy("label_str", "label").agg(F.count("*").alias("num_docs"))


@query(f"WITH {BOW_SQL} SELECT doc_id, quality AS label, word, word_count FROM bow JOIN labels USING (doc_id)")
def repeated_labels(spark: SparkSession, sf: str) -> DataFrame:
    """A label table that says everything twice changes no count."""
    labels = read_table(spark, sf, "labels", "doc_id", "quality")
    return labelled_bow(spark, sf, labels=labels.unionByName(labels))


@query("SELECT count(DISTINCT quality) AS num_classes FROM documents JOIN labels USING (doc_id)")
def class_count(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", "doc_id")
    return count_classes(docs.join(read_labels(spark, sf, "quality"), "doc_id"), "quality")


@query(f"WITH {FEATURES_SQL} SELECT max(word_index) + 1 AS dictionary_size FROM features")
def feature_count(spark: SparkSession, sf: str) -> DataFrame:
    _, fitted = all_features(spark, sf)
    return vocabulary.dictionary_size(fitted.table)


# --- evaluation ----------------------------------------------------------------------------------------------------

PAIRS_SQL = "pairs AS (SELECT quality AS label, toxic AS prediction, count(*) AS num_docs FROM labels GROUP BY ALL)"

REPORT_SQL = f"""
{PAIRS_SQL},
classes AS (SELECT label AS class FROM pairs UNION SELECT prediction FROM pairs),
sums AS (
  SELECT class,
    coalesce((SELECT sum(num_docs) FROM pairs WHERE label = class), 0) AS support,
    coalesce((SELECT sum(num_docs) FROM pairs WHERE prediction = class), 0) AS predicted,
    coalesce((SELECT sum(num_docs) FROM pairs WHERE label = class AND prediction = class), 0) AS correct
  FROM classes),
ratios AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE correct / CAST(predicted AS DOUBLE) END AS p,
    CASE WHEN support = 0 THEN 0.0 ELSE correct / CAST(support AS DOUBLE) END AS r FROM sums),
report AS (
  SELECT class, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted,
    CAST(correct AS BIGINT) AS correct, p, r, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM ratios)"""


def toxic_as_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """A rule SQL can repeat stands in for a classifier, so that the metrics themselves are checked."""
    labels = read_table(spark, sf, "labels", F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    return evaluate.confusion(labels)


@query(f"WITH {PAIRS_SQL} SELECT label, prediction, num_docs FROM pairs")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return toxic_as_prediction(spark, sf)


@query(f"""WITH {REPORT_SQL}
SELECT class, support, predicted, correct, round(p, {DIGITS}) AS precision, round(r, {DIGITS}) AS recall,
  round(f, {DIGITS}) AS f1 FROM report""")
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluate.class_report(toxic_as_prediction(spark, sf)), "precision", "recall", "f1")


@query(f"""WITH {REPORT_SQL}
SELECT CAST(sum(support) AS BIGINT) AS num_docs, round(sum(correct) / CAST(sum(support) AS DOUBLE), {DIGITS}) AS accuracy,
  round(sum(p * support) / sum(support), {DIGITS}) AS precision,
  round(sum(r * support) / sum(support), {DIGITS}) AS recall,
  round(sum(f * support) / sum(support), {DIGITS}) AS f1 FROM report""")
def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluate.metrics(toxic_as_prediction(spark, sf)), "accuracy", "precision", "recall", "f1")


# --- jobs ----------------------------------------------------------------------------------------------------------


def split_bow(spark: SparkSession, sf: str, label: str = "quality") -> tuple[DataFrame, DataFrame]:
    """Training and validation, every fifth document, with a class from ``labels`` or, ``lang``, the table itself."""
    docs = read_documents(spark, sf, "doc_id", "lang", "text")
    unique = ids_unique(read_table(spark, sf, "documents", "doc_id"), "doc_id")
    if label == "lang":
        docs = docs.withColumnRenamed("lang", "label")
    else:
        docs = docs.join(read_labels(spark, sf, label).withColumnRenamed(label, "label"), "doc_id")
    bow = stage(bow_from_text(docs, keep=["label"], unique=unique), "bow")
    return bow.filter("doc_id % 5 <> 0"), bow.filter("doc_id % 5 = 0")


def job_tables_sql(labels: str = "labels") -> str:
    """The job's chosen features, the documents that are ``known``, and their ``hit`` features; classes in ``quality``."""
    return f"""{labelled_features_sql('quality', f'(SELECT * FROM {labels} WHERE doc_id % 5 <> 0)')},
numbered AS (
  SELECT c.word, w.idf, row_number() OVER (ORDER BY c.word_index) - 1 AS feature
  FROM chosen c JOIN weights w USING (word_index)),
every AS (
  SELECT DISTINCT l.doc_id, l.quality, p.word FROM {labels} l JOIN (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \\n\\t\\r]+')) AS word FROM documents) p USING (doc_id)),
known AS (SELECT DISTINCT doc_id, quality FROM every JOIN dictionary USING (word)),
hit AS (SELECT e.doc_id, n.feature, n.idf FROM every e JOIN numbered n USING (word))"""


JOB_SQL = f"""
WITH {job_tables_sql()}
SELECT CASE WHEN k.doc_id % 5 <> 0 THEN 'training' ELSE 'validation' END AS split, k.doc_id, k.quality AS label,
  CAST((SELECT count(*) FROM numbered) AS INTEGER) AS num_features,
  coalesce(string_agg(CAST(h.feature AS VARCHAR), ',' ORDER BY h.feature), '') AS word_indices_str,
  round(coalesce(sum(h.idf), 0.0), {DIGITS}) AS value_sum
FROM known k LEFT JOIN hit h USING (doc_id) GROUP BY k.doc_id, k.quality"""


@query(JOB_SQL)
def job_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    """Fit on the training set, transform both; the values are compared by their sum."""
    model, *sets = preprocess(*split_bow(spark, sf))
    parts = [
        docvectors.to_csv_columns(
            packed.withColumn("split", F.lit(name)), model.num_features, keys=["split", "doc_id", "values"]
        )
        for name, packed in zip(("training", "validation"), sets)
    ]
    total = F.round(F.aggregate("values", F.lit(0.0), lambda total, v: total + v), DIGITS).alias("value_sum")
    return parts[0].unionByName(parts[1]).select(
        "split", "doc_id", "label", "num_features", "word_indices_str", total
    )


def trained(spark: SparkSession, sf: str, kind: str, epochs: int, label: str = "quality", **options):
    model, training, validation = preprocess(*split_bow(spark, sf, label), num_top_features=NUM_TOP_FEATURES)
    return classify(training, validation, model.num_features, kind, epochs, **options)


@query()
def train_softmax(spark: SparkSession, sf: str) -> DataFrame:
    return trained(spark, sf, "softmax", 10).metrics()


@query()
def train_softmax_mlp(spark: SparkSession, sf: str) -> DataFrame:
    return trained(spark, sf, "softmax", 10, solver="mlp").metrics()


@query()
def train_softmax_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return trained(spark, sf, "softmax", 10, sparse=True).metrics()


# Training from separable weights, which SQL repeats step by step.
BY_QUALITY, BY_LANG = "labels", "(SELECT doc_id, lang AS quality FROM documents)"
SHALLOW, DEEP, AVERAGE = (
    Plan(epochs=5),
    Plan(epochs=2, hidden="n_features // 2"),
    Plan(epochs=3, workers=8, batches=4, average_every=2),
)
AVERAGE_OPTIONS = {"workers": AVERAGE.workers, "batches": AVERAGE.batches, "average_every": AVERAGE.average_every}


def training_sql(plan: Plan, labels: str, report: str) -> str:
    """``report`` may read ``predicted`` and, with epoch and loss, ``losses``."""
    ctes, last, losses = training_ctes(plan)
    return f"""WITH {job_tables_sql(labels)},
entries AS MATERIALIZED (SELECT doc_id, CAST(feature AS BIGINT) AS feature, idf AS value FROM hit),
docs AS MATERIALIZED (
  SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN 'training' ELSE 'validation' END AS split, quality AS label FROM known),
width AS (SELECT count(*) AS n_features FROM numbered),
{ctes},
{predictions_ctes(last, 3 if plan.hidden else 2)},
losses AS ({losses})
{report}"""


CONFUSION_SQL = "SELECT split, label, prediction, count(*) AS num_docs FROM predicted WHERE label IS NOT NULL GROUP BY ALL"

METRICS_SQL = f"""
, pairs AS ({CONFUSION_SQL}),
named AS (SELECT split, label AS class FROM pairs UNION SELECT split, prediction FROM pairs),
sums AS (
  SELECT n.split, n.class, coalesce(sum(num_docs) FILTER (p.label = n.class), 0) AS support,
    coalesce(sum(num_docs) FILTER (p.prediction = n.class), 0) AS predicted,
    coalesce(sum(num_docs) FILTER (p.label = n.class AND p.prediction = n.class), 0) AS correct
  FROM named n JOIN pairs p USING (split) GROUP BY n.split, n.class),
ratios AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE correct / CAST(predicted AS DOUBLE) END AS p,
    CASE WHEN support = 0 THEN 0.0 ELSE correct / CAST(support AS DOUBLE) END AS r FROM sums)
SELECT split, CAST(sum(support) AS BIGINT) AS num_docs, round(sum(correct) / CAST(sum(support) AS DOUBLE), {DIGITS}) AS accuracy,
  round(sum(p * support) / sum(support), {DIGITS}) AS precision, round(sum(r * support) / sum(support), {DIGITS}) AS recall,
  round(sum(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END * support) / sum(support), {DIGITS}) AS f1
FROM ratios GROUP BY split"""


GRADIENT_SQL = f"""WITH {job_tables_sql(BY_LANG)},
classes_of AS (SELECT quality, row_number() OVER (ORDER BY quality) - 1 AS j FROM (SELECT DISTINCT quality FROM known WHERE doc_id % 5 <> 0)),
sizes AS (SELECT (SELECT count(*) FROM numbered) AS n_features, (SELECT count(*) FROM classes_of) AS k,
  (SELECT count(*) FROM known WHERE doc_id % 5 <> 0) AS n_docs),
weights_of AS (
  SELECT i.range AS i, j.range AS j, 3.0 * sqrt(2.0 / (SELECT n_features + k FROM sizes))
    * (((i.range * 7 + 3) % 16 + 0.5) / 8.0 - 1.0) * (((j.range * 5 + 1) % 16 + 0.5) / 8.0 - 1.0) AS w
  FROM range((SELECT n_features FROM sizes)) i, range((SELECT k FROM sizes)) j),
entries AS (SELECT doc_id, feature AS i, idf AS value FROM hit WHERE doc_id % 5 <> 0),
z AS (
  SELECT t.doc_id, c.j, t.j AS class_id, coalesce(s.z, 0.0) AS z
  FROM (SELECT k.doc_id, c.j FROM known k JOIN classes_of c USING (quality) WHERE k.doc_id % 5 <> 0) t CROSS JOIN classes_of c
  LEFT JOIN (SELECT doc_id, j, sum(value * w) AS z FROM entries JOIN weights_of USING (i) GROUP BY doc_id, j) s
    ON s.doc_id = t.doc_id AND s.j = c.j),
p AS (SELECT doc_id, j, class_id, z - ln(sum(exp(z)) OVER (PARTITION BY doc_id)) AS logp FROM z),
deltas AS (SELECT doc_id, j, exp(logp) - CASE WHEN j = class_id THEN 1.0 ELSE 0.0 END AS d FROM p),
parts AS (
  SELECT i, j, sum(value * d) AS g FROM entries JOIN deltas USING (doc_id) GROUP BY i, j
  UNION ALL SELECT i, j, 0.0 FROM weights_of UNION ALL SELECT -1, j, sum(d) FROM deltas GROUP BY j),
total AS (SELECT -sum(logp) / (SELECT n_docs FROM sizes) + (SELECT 0.5 * 0.0001 * sum(w * w) FROM weights_of) AS loss FROM p WHERE j = class_id)
SELECT CAST(i AS INTEGER) AS feature, CAST(j AS INTEGER) AS class_id,
  round(sum(g) / any_value(n_docs) + coalesce(any_value(0.0001 * w), 0.0), {DIGITS}) AS gradient, round(any_value(loss), {DIGITS}) AS loss
FROM parts LEFT JOIN weights_of USING (i, j), sizes, total GROUP BY i, j"""


@query(GRADIENT_SQL)
def softmax_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """Loss and gradient of softmax regression at separable weights; feature -1 is the bias."""
    model, training, _ = preprocess(*split_bow(spark, sf, "lang"), num_top_features=NUM_TOP_FEATURES)
    classes = class_list(training)
    ids = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, i)])
    rows = stage(training.select("indices", "values", F.element_at(ids, F.col("label")).alias("class_id")), "rows")
    network = Network((model.num_features, len(classes)), start="separable")
    loss, gradient = loss_and_gradient(rows, network, network.initial())
    # Weights and gradient of the one layer are on the driver anyway: numbers in order, the bias last.
    cells = spark.createDataFrame(pa.table({"at": np.arange(len(gradient)), "gradient": gradient}))
    feature = F.floor(F.col("at") / len(classes)).cast("int")
    return cells.select(
        F.when(feature == model.num_features, -1).otherwise(feature).alias("feature"),
        (F.col("at") % len(classes)).cast("int").alias("class_id"),
        F.round("gradient", DIGITS).alias("gradient"),
        F.lit(round(loss, DIGITS)).alias("loss"),
    )


def rounded_metrics(found) -> DataFrame:
    return rounded(found.metrics(), "accuracy", "precision", "recall", "f1")


@query(training_sql(SHALLOW, BY_QUALITY, METRICS_SQL))
def train_shallow(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_metrics(trained(spark, sf, "shallow", SHALLOW.epochs, start="separable"))


@query(training_sql(AVERAGE, BY_QUALITY, METRICS_SQL))
def train_average(spark: SparkSession, sf: str) -> DataFrame:
    """Eight learners, four batches of each per epoch, averaged after every second one."""
    return rounded_metrics(trained(spark, sf, "average", AVERAGE.epochs, start="separable", **AVERAGE_OPTIONS))


@query(training_sql(DEEP, BY_QUALITY, METRICS_SQL))
def train_deep(spark: SparkSession, sf: str) -> DataFrame:
    """All selected features, and a middle layer of half as many."""
    return rounded_metrics(trained(spark, sf, "deep", DEEP.epochs, start="separable"))


@query(training_sql(SHALLOW, BY_LANG, CONFUSION_SQL))
def train_languages(spark: SparkSession, sf: str) -> DataFrame:
    """Four classes."""
    return trained(spark, sf, "shallow", SHALLOW.epochs, label="lang", start="separable").confusion()


LOSSES_SQL = f"SELECT epoch, round(loss, {DIGITS}) AS loss FROM losses"
PREDICTIONS_SQL = "SELECT split, doc_id, label, prediction FROM predicted"


def epoch_losses(spark: SparkSession, found) -> DataFrame:
    """One row per epoch."""
    return rounded(spark.createDataFrame(list(enumerate(found.model.losses, 1)), "epoch int, loss double"), "loss")


@query(training_sql(AVERAGE, BY_LANG, LOSSES_SQL))
def losses_average(spark: SparkSession, sf: str) -> DataFrame:
    found = trained(spark, sf, "average", AVERAGE.epochs, label="lang", start="separable", **AVERAGE_OPTIONS)
    return epoch_losses(spark, found)


@query(training_sql(SHALLOW, BY_LANG, LOSSES_SQL))
def losses_shallow(spark: SparkSession, sf: str) -> DataFrame:
    return epoch_losses(spark, trained(spark, sf, "shallow", SHALLOW.epochs, label="lang", start="separable"))


@query(training_sql(AVERAGE, BY_LANG, PREDICTIONS_SQL))
def predict_average(spark: SparkSession, sf: str) -> DataFrame:
    return predictions(trained(spark, sf, "average", AVERAGE.epochs, label="lang", start="separable", **AVERAGE_OPTIONS))


def predictions(found) -> DataFrame:
    parts = [
        df.select(F.lit(name).alias("split"), "doc_id", "label", "prediction")
        for name, df in (("training", found.training), ("validation", found.validation))
    ]
    return parts[0].unionByName(parts[1])


@query()
def predict_softmax(spark: SparkSession, sf: str) -> DataFrame:
    return predictions(trained(spark, sf, "softmax", 10))


@query(training_sql(SHALLOW, BY_QUALITY, CONFUSION_SQL))
def job_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Processed CSV files of both sets, classified from their directory; the report is the confusion table."""
    model, *sets = preprocess(*split_bow(spark, sf))
    folder = staged_folder(spark, "job")
    for name, packed in zip((TRAINING, VALIDATION), sets):
        write_processed(docvectors.to_csv_columns(packed, model.num_features), f"{folder}/{name}")
    return classify_directory(spark, folder, "shallow", SHALLOW.epochs, start="separable").confusion()


@query(CSV_SQL.format(columns="doc_id,"))
def stage_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The two ML stages in a pipeline, and their vectors taken apart again."""
    bow = stage(labelled_bow(spark, sf, "quality", "left").withColumn("doc_id", F.col("doc_id").cast("string")), "bow")
    columns = {"fileCol": "doc_id"}
    stages = [CommonElementFilter(dropFreq=DROP_FREQ, **columns), WordCountToVec(**columns)]
    fitted = Pipeline(stages=stages).fit(bow)
    packed = docvectors.from_vector(fitted.transform(bow)).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return docvectors.to_csv_columns(packed, fitted.stages[1].getDictionarySize(), keys=["doc_id"])


@query(JOB_SQL)
def pipeline_idf_chi2(spark: SparkSession, sf: str) -> DataFrame:
    """The preprocessing job as a pipeline of five stages on the long table, saved and loaded before use."""
    training, validation = (df.withColumn("doc_id", F.col("doc_id").cast("string")) for df in split_bow(spark, sf))
    folder = staged_folder(spark, "pipeline")
    long_pipeline(DROP_FREQ, MIN_DOC_FREQ, NUM_TOP_FEATURES, fileCol="doc_id").fit(training).save(folder)
    model = PipelineModel.load(folder)
    parts = [
        model.transform(df).select(F.lit(name).alias("split"), F.col("doc_id").cast("bigint"), "label", "num_features", "indices", "values")
        for name, df in (("training", training), ("validation", validation))
    ]
    total = F.round(F.aggregate("values", F.lit(0.0), lambda total, v: total + v), DIGITS).alias("value_sum")
    return parts[0].unionByName(parts[1]).select(
        "split", "doc_id", "label", "num_features", F.array_join("indices", ",").alias("word_indices_str"), total
    )


# --- directories of raw files --------------------------------------------------------------------------------------

# Every 11th document is in a directory that names no class, every 13th in one whose class has no letters.
FOLDER_SQL = "CASE WHEN doc_id % 11 = 0 THEN 'other' WHEN doc_id % 13 = 0 THEN 'class' ELSE 'class' || upper(lang) END"
CLASS_FILES, ALL_FILES = "class[A-Z]*/*.txt", "*/*.txt"
BY_FOLDER = "(SELECT doc_id, upper(lang) AS quality FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 13 <> 0)"


def write_documents(spark: SparkSession, sf: str, marked: bool, sets: bool) -> str:
    """``documents`` as raw files, one for each; the directory. ``marked``: a line says which document a file is, and
    lines that are not ``word count`` follow. ``sets``: below Training and Validation."""
    folder = F.expr(FOLDER_SQL)
    if sets:
        folder = F.concat(F.when(F.col("doc_id") % 5 != 0, TRAINING).otherwise(VALIDATION), F.lit("/"), folder)
    docs = read_documents(spark, sf, "doc_id", folder.alias("folder"), "text")
    number = F.col("doc_id").cast("string")
    extra = F.concat(F.lit("doc#"), number, F.lit(" 1"), F.expr(BAD_LINES)) if marked else None
    if ids_unique(read_table(spark, sf, "documents", "doc_id"), "doc_id"):
        documents = raw_contents(docs, extra=extra)
    else:
        documents = raw_documents(bow_from_text(docs, keep=["folder"], unique=False), extra=extra)
    directory = staged_folder(spark, "raw-files")
    since = staged_count()
    write_raw(stage(documents, "raw-content"), directory)
    release_staged(spark, since)  # the contents are in the files now
    return directory


# Three kinds of bad lines, and a blank one, which does not count.
BAD_LINES = """concat(if(doc_id % 3 = 0, '\\ntwo words 1', ''), if(doc_id % 5 = 0, '\\nword x', ''),
  if(doc_id % 7 = 0, '\\nword 99999999999\\n', ''))"""

MARKED_SQL = f"""
WITH {BOW_SQL},
marked AS (SELECT doc_id, word, word_count FROM bow UNION ALL SELECT DISTINCT doc_id, 'doc#' || doc_id, 1 FROM bow)"""


@query(f"""{MARKED_SQL}
SELECT doc_id, CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN NULL ELSE upper(lang) END AS label_str,
  CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN NULL
    ELSE CAST(ascii(upper(lang)) - 65 + 26 * (ascii(substr(upper(lang), 2, 1)) - 65) AS INTEGER) END AS label,
  count(*) AS num_words, CAST(sum(word_count) AS BIGINT) AS total
FROM marked JOIN documents USING (doc_id) GROUP BY doc_id, lang""")
def dir_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Many small files read back, by file: what a file says its document is, its class, its words."""
    rows = read_raw(spark, write_documents(spark, sf, marked=True, sets=False), files=ALL_FILES)
    return rows.groupBy("input_file", "label_str", "label").agg(
        F.max(F.when(F.col("word").startswith("doc#"), F.substring("word", 5, 20))).cast("bigint").alias("doc_id"),
        F.count("*").alias("num_words"),
        F.sum("word_count").alias("total"),
    ).select("doc_id", "label_str", "label", "num_words", "total")


@query("""
SELECT doc_id, CAST(sum(bad) AS BIGINT) AS num_lines FROM (
  SELECT doc_id, (doc_id % 3 = 0)::INT + (doc_id % 5 = 0)::INT + (doc_id % 7 = 0)::INT AS bad FROM documents
  WHERE regexp_matches(text, '[^ \n\t\r]')) WHERE bad > 0 GROUP BY doc_id""")
def dir_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """How many lines of each file the scan leaves out."""
    directory = write_documents(spark, sf, marked=True, sets=False)
    marks = read_raw(spark, directory, files=ALL_FILES, merge=False).filter(F.col("word").startswith("doc#"))
    marks = marks.select("input_file", F.substring("word", 5, 20).cast("bigint").alias("doc_id"))
    return malformed_lines(spark, directory, files=ALL_FILES).join(marks, "input_file").select("doc_id", "num_lines")


DENSE_SQL = "(SELECT quality, row_number() OVER (ORDER BY quality) - 1 AS id FROM (SELECT DISTINCT quality FROM known WHERE doc_id % 5 <> 0))"


@query(f"""
WITH {job_tables_sql(BY_FOLDER)}
SELECT CASE WHEN k.doc_id % 5 <> 0 THEN 'training' ELSE 'validation' END AS split,
  CAST(coalesce(c.id, -1) AS INTEGER) AS label,
  CAST((SELECT count(*) FROM numbered) AS INTEGER) AS num_features,
  coalesce(string_agg(CAST(h.feature AS VARCHAR), ',' ORDER BY h.feature), '') AS word_indices_str,
  round(coalesce(sum(h.idf), 0.0), {DIGITS}) AS value_sum
FROM known k LEFT JOIN hit h USING (doc_id) LEFT JOIN {DENSE_SQL} c USING (quality) GROUP BY k.doc_id, c.id""")
def dir_preprocess(spark: SparkSession, sf: str) -> DataFrame:
    """Directories of raw files to processed CSV files, which are read back."""
    output = staged_folder(spark, "processed")
    preprocess_directory(spark, write_documents(spark, sf, marked=False, sets=True), output, files=CLASS_FILES)
    total = F.aggregate(split_numbers("word_counts_str", "double"), F.lit(0.0), lambda total, v: total + v)
    parts = [
        read_processed(spark, f"{output}/{name}").select(F.lit(name.lower()).alias("split"), "*")
        for name in (TRAINING, VALIDATION)
    ]
    rows = parts[0].unionByName(parts[1]).withColumn("word_indices_str", F.coalesce("word_indices_str", F.lit("")))
    return rows.select("split", "label", "num_features", "word_indices_str", F.round(total, DIGITS).alias("value_sum"))


@query(training_sql(SHALLOW, BY_FOLDER, f"""
SELECT split, CAST(a.id AS INTEGER) AS label, CAST(b.id AS INTEGER) AS prediction, count(*) AS num_docs
FROM predicted p JOIN {DENSE_SQL} a ON a.quality = p.label JOIN {DENSE_SQL} b ON b.quality = p.prediction GROUP BY ALL"""))
def dir_classify(spark: SparkSession, sf: str) -> DataFrame:
    """From directories of raw files to a trained classifier's confusion table."""
    output = staged_folder(spark, "processed")
    preprocess_directory(spark, write_documents(spark, sf, marked=False, sets=True), output, files=CLASS_FILES)
    return classify_directory(spark, output, "shallow", SHALLOW.epochs, start="separable").confusion()
