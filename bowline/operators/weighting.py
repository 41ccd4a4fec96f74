"""Binarization and inverse document frequency on the long feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bowline.operators.lookup import lookup_join
from bowline.operators.vocabulary import WordTable
from bowline.staging import TableSize, measure, stage


def binarize(features: DataFrame, threshold: float = 0.0, value: str = "value") -> DataFrame:
    """1.0 for values above the threshold, else 0.0."""
    return features.withColumn(value, F.when(F.col(value) > threshold, 1.0).otherwise(0.0))


def idf(doc_freq: Column | str, num_docs: int | Column, min_doc_freq: int = 0) -> Column:
    """ln((num_docs + 1) / (doc_freq + 1)), and 0 below ``min_doc_freq``."""
    doc_freq = F.col(doc_freq) if isinstance(doc_freq, str) else doc_freq
    num_docs = F.lit(num_docs) if isinstance(num_docs, int) else num_docs
    return F.when(doc_freq >= min_doc_freq, F.ln((num_docs + 1.0) / (doc_freq + 1.0))).otherwise(0.0)


def idf_weights(
    features: DataFrame,
    min_doc_freq: int = 2,
    doc: str = "doc_id",
    index: str = "word_index",
    value: str = "value",
    num_docs: int | Column | None = None,
) -> DataFrame:
    """``(word_index, doc_freq, idf)``; a document counts for a word when its value is positive.

    ``num_docs`` defaults to the documents present in ``features``.
    """
    if num_docs is None:
        num_docs = features.agg(F.count_distinct(doc)).scalar()
    frequencies = features.groupBy(index).agg(F.count_if(F.col(value) > 0).alias("doc_freq"))
    return frequencies.withColumn("idf", idf("doc_freq", num_docs, min_doc_freq))


def fit_idf(
    features: DataFrame,
    min_doc_freq: int = 2,
    bound: TableSize | None = None,
    index: str = "word_index",
    **columns: str,
) -> WordTable:
    """The weights with their size: ``bound`` where it is known, such as the dictionary's, else measured.

    They are written once unless they are small enough to broadcast, which needs them only once.
    """
    weights = idf_weights(features, min_doc_freq, index=index, **columns)
    if bound is not None and bound.fits_broadcast:
        return WordTable(weights, bound)
    weights = stage(weights, "idf")
    return WordTable(weights, measure(weights, index, "doc_freq"))


def apply_idf(
    features: DataFrame, weights: WordTable, index: str = "word_index", value: str = "value"
) -> DataFrame:
    """Values multiplied by the weight of their index."""
    joined = lookup_join(features, weights.table, index, ["idf"], weights.size)
    return joined.withColumn(value, F.col(value) * F.col("idf")).select(*features.columns)
