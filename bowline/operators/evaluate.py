"""Classification metrics from a confusion table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, num_docs)`` for the pairs that occur; rows without a label are left out."""
    labelled = predictions.filter(F.col(label).isNotNull())
    return labelled.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("num_docs")
    )


def class_report(pairs: DataFrame) -> DataFrame:
    """Per class that is a label or a prediction: support, predicted, correct, precision, recall, F1."""
    as_label = pairs.select(
        F.col("label").alias("class"),
        F.col("num_docs").alias("support"),
        F.lit(0).alias("predicted"),
        F.when(F.col("label") == F.col("prediction"), F.col("num_docs")).otherwise(0).alias("correct"),
    )
    as_prediction = pairs.select(
        F.col("prediction").alias("class"),
        F.lit(0).alias("support"),
        F.col("num_docs").alias("predicted"),
        F.lit(0).alias("correct"),
    )
    sums = as_label.unionByName(as_prediction).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("correct").alias("correct")
    )
    ratios = sums.withColumns(
        {
            "precision": F.coalesce(F.try_divide("correct", "predicted"), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide("correct", "support"), F.lit(0.0)),
        }
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), both), F.lit(0.0))
    return ratios.withColumn("f1", f1)


def metrics(pairs: DataFrame) -> DataFrame:
    """One row: ``num_docs``, ``accuracy``, and the support-weighted ``precision``, ``recall`` and ``f1``."""
    report = class_report(pairs)
    share = lambda name: (F.sum(F.col(name) * F.col("support")) / F.sum("support")).alias(name)
    return report.agg(
        F.sum("support").alias("num_docs"),
        (F.sum("correct") / F.sum("support")).alias("accuracy"),
        share("precision"),
        share("recall"),
        share("f1"),
    )
