"""Document counts, the common-word filter, and the dictionary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bowline.operators.lookup import drop_matching, lookup_join, number_rows
from bowline.staging import TableSize, measure, stage


def document_count(bow: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row: ``num_docs``, the number of distinct documents."""
    return bow.agg(F.count_distinct(doc).alias("num_docs"))


SKETCH_BITS = 12  # 2 ** 12 registers
SKETCH_DEVIATIONS = 4.0  # a bound that an estimate misses once in some 16,000 times


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """The relative standard error of a count by sketch."""
    return 1.04 / 2 ** (bits / 2)


def document_sketch(bow: DataFrame, doc: str = "doc_id", bits: int = SKETCH_BITS) -> DataFrame:
    """One row: ``sketch``, a HyperLogLog sketch of the distinct documents, of fixed size however many there are.

    Keep it with a slice of the data: sketches of later slices are merged into it without reading this one again.
    """
    key = F.col(doc) if bow.schema[doc].dataType.typeName() in ("long", "integer", "string") else F.col(doc).cast("string")
    return bow.agg(F.hll_sketch_agg(key, bits).alias("sketch"))


def merge_document_sketches(sketches: DataFrame) -> DataFrame:
    """One row: ``sketch`` of all slices together, and ``estimate``, its number of distinct documents."""
    merged = sketches.agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("sketch", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("bigint").alias("estimate"))


def word_frequencies(
    bow: DataFrame, word: str = "word", doc: str = "doc_id", count_mode: str = "rows"
) -> DataFrame:
    """``(word, num_docs)``. Rows per word, equal to documents per word when (document, word) is unique.

    ``count_mode="docs"`` counts distinct documents whatever the input.
    """
    if count_mode not in ("rows", "docs"):
        raise ValueError("count_mode must be 'rows' or 'docs'")
    rows = bow.select(doc, word).distinct() if count_mode == "docs" else bow
    return rows.groupBy(word).agg(F.count("*").alias("num_docs"))


def is_rare(frequency: Column | str, drop_freq: float, num_docs: int | Column) -> Column:
    """The keep rule: strictly fewer than ``drop_freq`` of all documents."""
    frequency = F.col(frequency) if isinstance(frequency, str) else frequency
    return frequency < F.lit(float(drop_freq)) * num_docs


def keep_words(
    bow: DataFrame, drop_freq: float = 0.2, word: str = "word", doc: str = "doc_id", count_mode: str = "rows"
) -> DataFrame:
    """``(word)``: the words that are not over-common, as one lazy plan."""
    num_docs = document_count(bow, doc).scalar()
    return word_frequencies(bow, word, doc, count_mode).filter(is_rare("num_docs", drop_freq, num_docs)).select(word)


@dataclass(frozen=True)
class WordTable:
    """A staged table unique on its word column, with its measured size."""

    table: DataFrame
    size: TableSize


def fit_common_words(
    bow: DataFrame, drop_freq: float = 0.2, word: str = "word", doc: str = "doc_id", count_mode: str = "rows"
) -> WordTable:
    """``(word, num_docs, keep)`` for every word of ``bow``, written once. Null words are no words."""
    num_docs = document_count(bow, doc).first()[0]
    counted = word_frequencies(bow, word, doc, count_mode).filter(F.col(word).isNotNull())
    table = stage(counted.withColumn("keep", is_rare("num_docs", drop_freq, num_docs)), "words")
    return WordTable(table, measure(table, word, "num_docs"))


def filter_common(bow: DataFrame, words: WordTable, word: str = "word") -> DataFrame:
    """Rows whose word is a keep-word of ``words``; words it never saw are dropped too."""
    return lookup_join(bow, words.table, word, [], words.size, known="keep")


def narrowed(words: WordTable, rows: DataFrame, word: str = "word") -> WordTable:
    """A large table cut to the words of ``rows`` when those are few; its size is a bound then. ``rows`` is read twice."""
    if words.size.fits_broadcast:
        return words
    asked = stage(rows.select(word).distinct(), "asked")
    size = measure(asked, word)
    if not size.fits_broadcast:
        return words
    return WordTable(words.table.join(F.broadcast(asked), word, "left_semi"), size)


def drop_common(
    bow: DataFrame, drop_freq: float = 0.2, word: str = "word", doc: str = "doc_id", count_mode: str = "rows"
) -> DataFrame:
    """``filter_common`` for the very table the words come from.

    There, keeping the rare words is dropping the common ones, and those are few however large the table is: each
    is in ``drop_freq`` of the documents, so there are at most (distinct words per document) / ``drop_freq``.
    """
    num_docs = document_count(bow, doc).first()[0]
    frequencies = word_frequencies(bow, word, doc, count_mode).filter(F.col(word).isNotNull())
    common = stage(frequencies.filter(~is_rare("num_docs", drop_freq, num_docs)), "common")
    return drop_matching(bow, common, word, measure(common, word))


def fit_dictionary(
    bow: DataFrame, word: str = "word", index: str = "word_index"
) -> WordTable:
    """``(word, num_docs, word_index)``: distinct non-null words, numbered from 0 in code-point order."""
    words = word_frequencies(bow, word).filter(F.col(word).isNotNull())
    table, size = number_rows(words, word, index, "num_docs")
    return WordTable(table, size)


def fit_vocabulary(
    bow: DataFrame, drop_freq: float = 0.1, word: str = "word", doc: str = "doc_id", index: str = "word_index"
) -> WordTable:
    """The dictionary of the keep-words: the common-word filter and ``fit_dictionary`` in one pass over the words."""
    num_docs = document_count(bow, doc).first()[0]
    words = word_frequencies(bow, word).filter(F.col(word).isNotNull())
    table, size = number_rows(words.filter(is_rare("num_docs", drop_freq, num_docs)), word, index, "num_docs")
    return WordTable(table, size)


def dictionary_size(dictionary: DataFrame, index: str = "word_index") -> DataFrame:
    """One row: ``dictionary_size`` = largest index + 1, 0 for an empty dictionary."""
    return dictionary.agg((F.coalesce(F.max(index), F.lit(-1)) + 1).alias("dictionary_size"))


def add_word_index(bow: DataFrame, dictionary: WordTable, word: str = "word", index: str = "word_index") -> DataFrame:
    """Rows with their word's index; rows of unknown words are dropped."""
    return lookup_join(bow, dictionary.table, word, [index], dictionary.size)
