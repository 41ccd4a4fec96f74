"""Processed vectors: headerless CSV or Parquet of ``num_features, word_indices_str, word_counts_str, label``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Fixed value: the columns of a processed file, in order.
PROCESSED_SCHEMA = StructType(
    [
        StructField("num_features", IntegerType(), False),
        StructField("word_indices_str", StringType(), False),
        StructField("word_counts_str", StringType(), False),
        StructField("label", IntegerType(), True),
    ]
)


def write_processed(processed: DataFrame, directory: str, format: str = "csv") -> None:
    """Replace ``directory`` by the processed columns as CSV without a header, or as Parquet."""
    writer = processed.select(*PROCESSED_SCHEMA.names).write.mode("overwrite").format(format)
    (writer.option("header", "false") if format == "csv" else writer).save(directory)


def read_processed(spark: SparkSession, directory: str, format: str = "csv") -> DataFrame:
    """The rows of a processed directory; the schema is fixed, nothing is inferred."""
    if format == "csv":
        return spark.read.schema(PROCESSED_SCHEMA).option("header", "false").csv(f"{directory.rstrip('/')}/*.csv")
    return spark.read.schema(PROCESSED_SCHEMA).format(format).load(directory)
