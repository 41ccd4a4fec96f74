"""The preprocessing job: common-word filter, vocabulary, binarize, IDF, chi-square top-k, sparse vectors.

The chain is written as one plan over word statistics instead of one pass per stage. Everything the stages need is
a function of "documents per (word, class)", so the bag of words is read for the document count, for those counts,
for the class totals, and to build the vectors; it is never shuffled by word. Only two tables are sent to every
task, both small by construction and both measured: the common words and the selected features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass, replace
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.operators.docvectors import (
    check_vector_size,
    empty_documents,
    pack_documents,
    to_csv_columns,
)
from bowline.operators.lookup import drop_matching, lookup_join
from bowline.operators.selection import chi2_from_cells, fit_class_totals, fit_selection, with_class_docs
from bowline.operators.vocabulary import WordTable, filter_common, is_rare, narrowed
from bowline.operators.weighting import idf
from bowline.sources.processed import write_processed
from bowline.sources.raw import TRAINING, VALIDATION, encode_labels, fit_labels, read_raw
from bowline.staging import TableSize, broadcast_if_small, measure, size_columns, stage

# So many classes are counted side by side; so few common words are a part of the plan.
FEW_CLASSES = 32
FEW_WORDS, FEW_WORD_BYTES = 2_000, 64 * 1024


@dataclass(frozen=True)
class PreprocessModel:
    """``words``: (word, num_docs, keep). ``selected``: (word, doc_freq, idf, chi2, feature)."""

    words: WordTable
    selected: WordTable
    labels: DataFrame | None = None

    @property
    def num_features(self) -> int:
        return self.selected.size.rows

    def transform(
        self, bow: DataFrame, doc: str = "doc_id", label: str | None = "label", keep_empty: bool = False
    ) -> DataFrame:
        """``(doc, [label], indices, values)``, one row per document that has a vocabulary word.

        A document with vocabulary words but none selected gets empty arrays. One without any vanishes, unless
        ``keep_empty``. ``bow`` is read more than once: pass a written table.
        """
        keys = [doc] + ([label] if label and label in bow.columns else [])
        rows = bow.select(*keys, "word", "word_count")
        selected = self.selected.table.select("word", "feature", "idf")
        seen = F.col("word_count") > 0
        if self.selected.size.fits_broadcast:
            matched = rows.join(F.broadcast(selected), "word", "left")
            matched = matched.withColumn("feature", F.when(seen, F.col("feature")))
            packed = stage(pack_documents(matched, keys, "feature", "idf"), "vectors")
        else:
            matched = lookup_join(
                rows.filter(seen), self.selected.table, "word", ["feature", "idf"], self.selected.size
            )
            packed = stage(pack_documents(matched, keys, "feature", "idf", scattered=True), "vectors")
            packed = packed.unionByName(empty_documents(rows, packed, keys))
        if keep_empty:
            return packed
        bare = packed.filter(F.size("indices") == 0)
        size = measure(bare, doc)
        if not size.rows:
            return packed
        # Only documents without a selected word need the full vocabulary, and of that only their own words.
        doubtful = rows.join(broadcast_if_small(bare.select(doc), size), doc, "left_semi").select(doc, "word")
        doubtful = stage(doubtful, "doubtful")
        known = filter_common(doubtful, narrowed(self.words, doubtful)).select(doc).distinct()
        kept = stage(bare.join(known, doc, "left_semi"), "bare")
        return packed.filter(F.size("indices") > 0).unionByName(kept)

    def save(self, path: str) -> None:
        self.words.table.write.mode("overwrite").parquet(f"{path}/words")
        self.selected.table.write.mode("overwrite").parquet(f"{path}/selected")
        if self.labels is not None:
            self.labels.write.mode("overwrite").parquet(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str, labels: bool = False) -> PreprocessModel:
        words = spark.read.parquet(f"{path}/words")
        selected = spark.read.parquet(f"{path}/selected")
        return cls(
            WordTable(words, measure(words, "word", "num_docs")),
            WordTable(selected, measure(selected, "word", "doc_freq")),
            spark.read.parquet(f"{path}/labels") if labels else None,
        )


def fit_preprocessing(
    bow: DataFrame,
    doc: str = "doc_id",
    label: str = "label",
    drop_freq: float = 0.1,
    min_doc_freq: int = 2,
    num_top_features: int = 8000,
) -> PreprocessModel:
    """Fit on a bag of words with one row per (document, word); rows without a label are left out.

    ``bow`` is read four times, for the documents, the classes, the words, and the class totals: pass a written table.
    """
    bow = bow.filter(F.col(label).isNotNull())
    num_docs = bow.select(doc).distinct().count()
    counted = count_by_class(bow.filter("word is not null"), label, few_classes(bow, label))
    statistics = stage(counted.withColumn("keep", is_rare("num_docs", drop_freq, num_docs)), "words")
    sizes = {
        row["keep"]: TableSize(*row[1:])
        for row in statistics.groupBy("keep").agg(*size_columns("word", "num_docs")).collect()
    }
    common = sizes.get(False, TableSize(0, 0))
    survivors = drop_common_words(bow, statistics.filter("not keep"), common) if common.rows else bow
    totals = fit_class_totals(survivors.filter("word is not null"), label, doc)
    if not totals:
        raise ValueError("no words are left to select features from")
    scored = score_words(statistics.filter("keep"), totals, min_doc_freq)
    selected = fit_selection(scored, num_top_features, "word")
    check_vector_size(selected.size.rows)
    every = TableSize(*(sum(parts) for parts in zip(*(astuple(size) for size in sizes.values()), strict=True)))
    return PreprocessModel(WordTable(statistics.select("word", "num_docs", "keep"), every), selected)


def few_classes(rows: DataFrame, label: str) -> list | None:
    """The classes in order, or None when there are more than ``FEW_CLASSES``."""
    found = rows.select(label).distinct().limit(FEW_CLASSES + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= FEW_CLASSES else None


def drop_common_words(rows: DataFrame, common: DataFrame, size: TableSize) -> DataFrame:
    """Rows with a word that is not one of ``common``. A few words are compared in place, without a join."""
    if size.rows <= FEW_WORDS and size.key_bytes <= FEW_WORD_BYTES:
        words = common.select("word", F.is_valid_utf8("word")).collect()
        if all(valid for _, valid in words):  # others would change on their way through Python
            return rows.filter(~F.col("word").isin([word for word, _ in words]))
    return drop_matching(rows, common, "word", size)


def count_by_class(rows: DataFrame, label: str, classes: Sequence | None = None) -> DataFrame:
    """``(word, num_docs, doc_freq, cells)``: rows, documents, and documents per class, of every word.

    Counted by word, with a count for each of ``classes``, if these are given: all that there are. Otherwise counted by
    (word, class) and then by word; ``cells`` holds at most one entry per class.
    """
    if classes:
        present = [F.count_if((F.col(label) == F.lit(c)) & (F.col("word_count") > 0)) for c in classes]
        by_word = rows.groupBy("word").agg(
            F.count("*").alias("num_docs"), *[p.alias(f"_present{i}") for i, p in enumerate(present)]
        )
        counts = [F.col(f"_present{i}") for i in range(len(classes))]
        names = [F.lit(c).cast(rows.schema[label].dataType) for c in classes]
        cells = F.array(
            *[F.struct(c.alias("label"), n.alias("present")) for c, n in zip(names, counts, strict=True)]
        )
        return by_word.select(
            "word",
            "num_docs",
            reduce(add, counts).alias("doc_freq"),
            F.filter(cells, lambda c: c["present"] > 0).alias("cells"),
        )
    by_class = rows.groupBy("word", label).agg(
        F.count("*").alias("rows"), F.count_if(F.col("word_count") > 0).alias("present")
    )
    cell = F.when(F.col("present") > 0, F.struct(F.col(label).alias("label"), "present"))
    return by_class.groupBy("word").agg(
        F.sum("rows").alias("num_docs"), F.sum("present").alias("doc_freq"), F.collect_list(cell).alias("cells")
    )


def score_words(words: DataFrame, totals: dict[object, int], min_doc_freq: int) -> DataFrame:
    """``(word, doc_freq, idf, chi2)`` from ``(word, doc_freq, cells)`` and the documents per class.

    Runs row by row, without a shuffle. A word whose weight is 0 is a constant feature: it scores 0.
    """
    num_docs = sum(totals.values())
    cells = with_class_docs("cells", totals)
    weighted = words.withColumn("idf", idf("doc_freq", num_docs, min_doc_freq))
    chi2 = F.when(F.col("idf") != 0, chi2_from_cells(cells, F.col("doc_freq"), num_docs)).otherwise(0.0)
    return weighted.select("word", "doc_freq", "idf", chi2.alias("chi2"))


def preprocess(
    training: DataFrame,
    validation: DataFrame,
    doc: str = "doc_id",
    label: str = "label",
    keep_empty: bool = False,
    **options: float,
) -> tuple[PreprocessModel, DataFrame, DataFrame]:
    """Fit on ``training`` and transform both sets."""
    model = fit_preprocessing(training, doc, label, **options)
    return (
        model,
        model.transform(training, doc, label, keep_empty),
        model.transform(validation, doc, label, keep_empty),
    )


def preprocess_directory(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    encoding: str = "dense",
    formats: Sequence[str] = ("csv",),
    files: str | None = None,
    **options: float,
) -> PreprocessModel:
    """Raw files under ``input_dir/{Training,Validation}`` to processed files under ``output_dir``.

    ``encoding="dense"`` numbers the sorted training classes; ``"base26"`` keeps the letters' code. Validation
    documents of a class unknown to training have the label -1. With several ``formats`` each gets a subfolder.
    ``files``: a pattern below each set's directory for files that do not end in ``.res``.
    """
    if encoding not in ("dense", "base26"):
        raise ValueError("encoding must be 'dense' or 'base26'")
    # Files are read once; the classes join the written rows, in a broadcast unless there are very many.
    training = stage(read_raw(spark, f"{input_dir}/{TRAINING}", files=files), "training")
    validation = stage(read_raw(spark, f"{input_dir}/{VALIDATION}", files=files), "validation")
    labels = fit_labels(training) if encoding == "dense" else None
    if labels is not None:
        training, validation = encode_labels(training, labels), encode_labels(validation, labels)
    model, *sets = preprocess(training, validation, doc="input_file", **options)
    for name, packed in zip((TRAINING, VALIDATION), sets, strict=True):
        for fmt in formats:
            folder = f"{output_dir}/{name}" if len(formats) == 1 else f"{output_dir}/{fmt}/{name}"
            write_processed(to_csv_columns(packed, model.num_features), folder, fmt)
    return replace(model, labels=labels)
