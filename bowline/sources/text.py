"""Text tables: one row per document, turned into bag-of-words rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.functions.words import split_words


def read_table(spark: SparkSession, directory: str, name: str, *columns: str | Column) -> DataFrame:
    table = spark.read.parquet(f"{directory}/{name}.parquet")
    return table.select(*columns) if columns else table


# A table of one large row group is scanned by one task. Tables up to SPREAD_TABLE bytes are small enough to be dealt
# again, by document, to a task per SPREAD_TASK bytes; larger ones have row groups enough and stay where they are.
SPREAD_TABLE, SPREAD_TASK = 1 << 30, 2 << 20


def read_documents(
    spark: SparkSession, directory: str, *columns: str | Column, doc: str = "doc_id", tasks: int | None = None
) -> DataFrame:
    """Columns of ``documents``, dealt by document to ``tasks``, by default as many as the bytes of its files ask for.

    Only the plan depends on the number of tasks, no result does. With ``tasks=0`` the scan stays as it is.
    """
    table = read_table(spark, directory, "documents")
    picked = table.select(*columns) if columns else table
    if tasks is None:
        size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        tasks = -(-size // SPREAD_TASK) if SPREAD_TASK < size <= SPREAD_TABLE else 0
    return picked.repartition(tasks, doc) if tasks else picked


def ids_unique(table: DataFrame, doc: str) -> bool:
    """Whether every document has one row. Reads the id column only."""
    return table.groupBy(doc).count().filter("count > 1").isEmpty()


def read_labels(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    """One row per document from ``labels``; rows that repeat a document must agree, or the query fails."""
    labels = read_table(spark, directory, "labels", "doc_id", *columns)
    return one_label(labels)


def one_label(labels: DataFrame) -> DataFrame:
    def same(name: str) -> Column:
        message = F.concat(F.lit("labels disagree on document "), F.col("doc_id").cast("string"))
        agreed = F.min(name).eqNullSafe(F.max(name))
        return F.when(agreed, F.min(name)).otherwise(F.raise_error(message).cast(labels.schema[name].dataType))

    return labels.groupBy("doc_id").agg(*[same(c).alias(c) for c in labels.columns if c != "doc_id"])


def bow_from_text(
    table: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
    unique: bool | None = None,
    lower: bool = True,
) -> DataFrame:
    """``(doc, *keep, word, word_count)``, one row per document and distinct word.

    When each id has one row, which is checked unless ``unique`` says so, a document is counted inside its row
    and nothing is shuffled: its words are sorted and the length of each run of equal words is its count.
    Otherwise rows are grouped by (document, word), which splits even one hot document.
    """
    table = table.select(doc, *keep, text)
    if unique is None:
        unique = ids_unique(table, doc)
    if unique:
        return word_runs(table, doc, text, keep, lower).select(doc, *keep, "words", "starts", F.posexplode("starts").alias("run", "start")).select(
            doc,
            *keep,
            F.expr("words[start]").alias("word"),
            F.expr("coalesce(get(starts, run + 1), size(words)) - start").alias("word_count"),
        )
    words = table.select(doc, *keep, F.explode(split_words(text, lower)).alias("word"))
    counted = words.groupBy(doc, *keep, "word").agg(F.count("*").alias("word_count"))
    return counted.withColumn("word_count", F.col("word_count").cast("int"))


def word_runs(table: DataFrame, doc: str, text: str, keep: Sequence[str], lower: bool = True) -> DataFrame:
    """``(doc, *keep, words, starts)``: each row's words in order, and where each run of equal ones begins; rows without
    a word are left out."""
    # inline() of a one-element array keeps the optimizer from copying the sort into each later use of it.
    ordered = table.select(
        doc, *keep, F.inline(F.array(F.struct(F.sort_array(split_words(text, lower)).alias("words"))))
    )
    starts = F.expr("filter(sequence(0, size(words) - 1), i -> i = 0 or words[i] <> words[i - 1])")
    return ordered.filter(F.size("words") > 0).select(
        doc, *keep, "words", F.inline(F.array(F.struct(starts.alias("starts"))))
    )


def document_bow(spark: SparkSession, directory: str, *keep: str) -> DataFrame:
    """Bag of words of the whole ``documents`` table."""
    docs = read_documents(spark, directory, "doc_id", *keep, "text")
    return bow_from_text(docs, keep=keep, unique=ids_unique(read_table(spark, directory, "documents", "doc_id"), "doc_id"))


def labelled_bow(
    spark: SparkSession, directory: str, label: str = "quality", how: str = "inner", labels: DataFrame | None = None
) -> DataFrame:
    """Bag of words of ``documents`` with the class from a column of ``labels``, by default the table of that name.

    Labels are joined to whole documents, before their words are unfolded: one per document, however often the label
    table repeats it. ``how="left"`` keeps unlabelled ones.
    """
    docs = read_documents(spark, directory, "doc_id", "text")
    found = read_table(spark, directory, "labels") if labels is None else labels
    found = one_label(found.select("doc_id", F.col(label).alias("label")))
    return bow_from_text(docs.join(found, "doc_id", how), keep=["label"], unique=ids_unique(read_table(spark, directory, "documents", "doc_id"), "doc_id"))
