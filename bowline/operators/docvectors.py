"""Document vectors: the long table ``features(doc, label, word_index, value)`` and one row per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.functions.vectors import join_numbers, split_numbers, to_vector, vector_parts
from bowline.operators.vocabulary import WordTable, add_word_index

MAX_VECTOR_SIZE = 2**31 - 1  # fixed value: vector indices are 32-bit


def check_vector_size(size: int) -> int:
    if size > MAX_VECTOR_SIZE:
        raise ValueError(f"{size} words do not fit in a vector of at most {MAX_VECTOR_SIZE} entries")
    return size


def document_features(
    bow: DataFrame,
    dictionary: WordTable,
    keys: Sequence[str] = ("doc_id", "label"),
    word: str = "word",
    count: str = "word_count",
    index: str = "word_index",
    merged: bool = False,
) -> DataFrame:
    """``(*keys, word_index, value)``: counts per document and index, repeated ones added up.

    ``merged=True`` promises one row per document and word, and saves the aggregation. Otherwise, after a shuffled join,
    rows are brought together by document, so that ``pack_documents`` needs no shuffle of its own.
    """
    indexed = add_word_index(bow, dictionary, word, index)
    if merged:
        return indexed.select(*keys, index, F.col(count).cast("double").alias("value"))
    if not dictionary.size.fits_broadcast:
        indexed = indexed.repartition(*keys)
    return indexed.groupBy(*keys, index).agg(F.sum(F.col(count).cast("double")).alias("value"))


def pack_documents(
    features: DataFrame,
    keys: Sequence[str] = ("doc_id", "label"),
    index: str = "word_index",
    value: str = "value",
    scattered: bool = False,
) -> DataFrame:
    """One row per document: ``(*keys, indices, values)`` sorted by index.

    A null index adds nothing to the arrays but keeps its document. An array holds at most one entry per
    dictionary word, and entries are gathered before the shuffle already. ``scattered``: not so, as the rows of a
    document lie far apart, such as after a shuffled join by word, where an array per row would be all that is gathered.
    """
    if scattered:
        features = features.repartition(*keys)
    pair = F.struct(F.col(index).cast("int").alias("i"), F.col(value).cast("double").alias("v"))
    pairs = features.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col(index).isNotNull(), pair))).alias("_pairs")
    )
    return pairs.select(*keys, F.col("_pairs.i").alias("indices"), F.col("_pairs.v").alias("values"))


def unpack_documents(
    packed: DataFrame, keys: Sequence[str] = ("doc_id", "label"), index: str = "word_index", value: str = "value"
) -> DataFrame:
    """Inverse of ``pack_documents``; a document with empty arrays has no rows."""
    return packed.select(*keys, F.inline(F.arrays_zip("indices", "values"))).toDF(*keys, index, value)


def empty_documents(bow: DataFrame, packed: DataFrame, keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """Documents of ``bow`` that lost all their words, with empty arrays."""
    missing = bow.select(*keys).distinct().join(packed.select(keys[0]), keys[0], "left_anti")
    return missing.select(
        *keys, F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values")
    )


def with_vector(packed: DataFrame, size: int, vector: str = "raw_word_vector") -> DataFrame:
    """Replace the arrays by a sparse ML vector column."""
    check_vector_size(size)
    rest = [c for c in packed.columns if c not in ("indices", "values")]
    return packed.select(*rest, to_vector(F.lit(size), F.col("indices"), F.col("values")).alias(vector))


def from_vector(df: DataFrame, vector: str = "raw_word_vector") -> DataFrame:
    """Replace an ML vector column, sparse or dense, by ``num_features``, ``indices`` and ``values``."""
    rest = [c for c in df.columns if c != vector]
    parts = df.select(*rest, F.inline(F.array(vector_parts(vector))))
    return parts.withColumnRenamed("size", "num_features")


def to_csv_columns(packed: DataFrame, size: int, label: str | None = "label", keys: Sequence[str] = ()) -> DataFrame:
    """``(*keys, num_features, word_indices_str, word_counts_str, label)``; the size comes from the fitted model."""
    return packed.select(
        *keys,
        F.lit(size).cast("int").alias("num_features"),
        join_numbers("indices").alias("word_indices_str"),
        join_numbers("values").alias("word_counts_str"),
        (F.col(label) if label else F.lit(None)).cast("int").alias("label"),
    )


def from_csv_columns(processed: DataFrame) -> DataFrame:
    """Arrays from the two strings; every other column, such as a document id, is kept."""
    rest = [c for c in processed.columns if c not in ("word_indices_str", "word_counts_str")]
    return processed.select(
        *rest,
        split_numbers("word_indices_str", "int").alias("indices"),
        split_numbers("word_counts_str", "double").alias("values"),
    )


def feature_count(processed: DataFrame) -> int:
    """The one ``num_features`` of a processed table; 0 for an empty table, an error when rows disagree."""
    low, high = processed.agg(F.min("num_features"), F.max("num_features")).first()
    if low != high:
        raise ValueError(f"rows disagree on the number of features: {low} to {high}")
    return high or 0
