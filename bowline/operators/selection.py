"""Chi-square scores of two-valued features against the class, and the top-k selection.

After binarization and IDF a feature has at most two values, absent or one weight, so its table against C classes
has C - 1 degrees of freedom (or the feature is constant and scores 0). Ranking by the statistic is then the same as
ranking by p-value, without the ties at 0 that p-values of large statistics run into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bowline.operators.lookup import number_top
from bowline.operators.vocabulary import WordTable
from bowline.staging import stage


def class_totals(docs: DataFrame, label: str = "label", doc: str = "doc_id") -> DataFrame:
    """``(label, class_docs)``: distinct documents per class, null labels left out."""
    present = docs.filter(F.col(label).isNotNull()).select(doc, label).distinct()
    return present.groupBy(label).agg(F.count("*").alias("class_docs"))


def presence_by_class(
    features: DataFrame, index: str = "word_index", label: str = "label", value: str = "value"
) -> DataFrame:
    """``(word_index, label, present)``: documents of a class in which the feature is not zero."""
    labelled = features.filter(F.col(label).isNotNull())
    return labelled.groupBy(index, label).agg(F.count_if(F.col(value) != 0).alias("present"))


def chi2_from_cells(cells: Column, present: Column, num_docs: int) -> Column:
    """Pearson's statistic of a 2 x C table from its observed cells, ``array<struct<present, class_docs>>``.

    With d docs holding the feature out of m, the rows "present" and "absent" of a class deviate from their
    expectation by the same amount, so each class adds (present - d*n/m)^2 * m^2 / (n * d * (m - d)). Classes that
    never hold the feature add n * d / (m - d) each and need no row of their own. A constant feature scores 0.
    """
    num_docs = F.lit(num_docs)
    expected_share = present / num_docs
    observed = F.aggregate(
        F.sort_array(cells),
        F.lit(0.0),
        lambda total, c: total
        + F.pow(c["present"] - c["class_docs"] * expected_share, F.lit(2.0)) / c["class_docs"],
    )
    seen_docs = F.aggregate(cells, F.lit(0).cast("bigint"), lambda total, c: total + c["class_docs"])
    unobserved = F.pow(expected_share, F.lit(2.0)) * (num_docs - seen_docs)
    scale = num_docs / present * (num_docs / (num_docs - present))
    return F.when((present > 0) & (present < num_docs), (observed + unobserved) * scale).otherwise(0.0)


def fit_class_totals(docs: DataFrame, label: str = "label", doc: str = "doc_id") -> dict[object, int]:
    """Documents per class, as a dictionary: one entry per class, as in the classifier that is to follow."""
    return {row[label]: row["class_docs"] for row in class_totals(docs, label, doc).collect()}


def with_class_docs(cells: Column | str, totals: dict[object, int]) -> Column:
    """``array<struct<label, present>>`` to ``array<struct<present, class_docs>>``."""
    class_docs = F.create_map(*[F.lit(x) for pair in totals.items() for x in pair])
    return F.transform(
        cells,
        lambda c: F.struct(c["present"].alias("present"), F.element_at(class_docs, c["label"]).alias("class_docs")),
    )


def chi2_statistics(
    presence: DataFrame, totals: dict[object, int], index: str = "word_index", label: str = "label"
) -> DataFrame:
    """``(word_index, doc_freq, chi2)`` for every feature of ``presence``.

    The cells gathered per feature are at most one per class.
    """
    cell = F.struct(F.col(label).alias("label"), F.col("present"))
    by_feature = presence.groupBy(index).agg(
        F.sum("present").alias("doc_freq"), F.collect_list(cell).alias("_cells")
    )
    if not totals:
        return by_feature.select(index, "doc_freq", F.lit(0.0).alias("chi2"))
    cells = with_class_docs("_cells", totals)
    statistic = chi2_from_cells(cells, F.col("doc_freq"), sum(totals.values()))
    return by_feature.select(index, "doc_freq", statistic.alias("chi2"))


def rank_order(index: str = "word_index") -> list[Column]:
    """Highest rounded score, in ``_rank``, first; lowest index among equals."""
    return [F.col("_rank").desc(), F.col(index).asc()]


def rank_features(scores: DataFrame, index: str = "word_index", score: str = "chi2", digits: int = 6) -> DataFrame:
    """The features in the order in which they are selected."""
    # Rounded in a column of its own: a sort evaluates its expressions at every comparison.
    return scores.withColumn("_rank", F.round(score, digits)).orderBy(*rank_order(index)).drop("_rank")


# Levels that a score passes while it grows e-fold.
LEVELS = 64
_TOP = 2**63 - 1


def level_of(rank: Column) -> Column:
    """A step function of the rank, which orders as the rank does: in a descending order NaN is first and null is last."""
    rank = rank.cast("double")
    level = F.floor(F.signum(rank) * F.log1p(F.abs(rank)) * LEVELS)
    return F.when(F.isnan(rank), _TOP).otherwise(F.coalesce(level, F.lit(-_TOP)))


def leading(ranked: DataFrame, k: int) -> DataFrame:
    """The rows of the highest levels, as many as it takes to have the first ``k`` rows among them, ties included."""
    counts = {r["_level"]: r["count"] for r in ranked.groupBy("_level").count().collect()}  # a row per level
    seen = 0
    for lowest in sorted(counts, reverse=True):
        seen += counts[lowest]
        if seen >= k:
            return ranked.filter(F.col("_level") >= lowest)
    return ranked


def fit_selection(
    scores: DataFrame, k: int = 8000, index: str = "word_index", score: str = "chi2", weight: str = "doc_freq"
) -> WordTable:
    """The ``k`` best rows with ``feature`` = 0, 1, ... in ascending order of their index."""
    # Written, as scores are costly and are read for their levels, for the bounds of the sort, and for the sort.
    ranked = scores.withColumn("_rank", F.round(score, 6))
    ranked = stage(ranked.withColumn("_level", level_of(F.col("_rank"))), "scores")
    table, size = number_top(leading(ranked, k).drop("_level"), rank_order(index), k, index, "feature", weight)
    return WordTable(table.drop("_rank"), size)
