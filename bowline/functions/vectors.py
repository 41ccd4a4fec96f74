"""Conversions between arrays, comma-joined strings and ML vectors, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Tags of the two layouts inside an ML vector.
SPARSE, DENSE = 0, 1

_WRAPPED = StructType([StructField("v", VectorUDT())])


def vector_struct(size: Column, indices: Column, values: Column) -> Column:
    """The storage layout of a sparse ML vector."""
    return F.struct(
        F.lit(SPARSE).cast("tinyint").alias("type"),
        size.cast("int").alias("size"),
        indices.cast("array<int>").alias("indices"),
        values.cast("array<double>").alias("values"),
    )


def to_vector(size: Column, indices: Column, values: Column) -> Column:
    """A sparse ML vector from parallel arrays sorted by index.

    Spark has no expression that wraps a struct as a vector; a JSON round trip does it without Python.
    """
    return F.from_json(F.to_json(F.struct(vector_struct(size, indices, values).alias("v"))), _WRAPPED)["v"]


def vector_parts(vector: Column | str) -> Column:
    """``struct(size, indices, values)`` of a sparse or dense ML vector, zeros of a dense one left out."""
    raw = F.unwrap_udt(vector)
    dense = F.filter(
        F.transform(raw["values"], lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda p: p["v"] != 0.0
    )
    is_dense = raw["type"] == DENSE
    return F.when(
        F.unwrap_udt(vector).isNotNull(),
        F.struct(
            F.when(is_dense, F.size(raw["values"])).otherwise(raw["size"]).alias("size"),
            F.when(is_dense, dense["i"]).otherwise(raw["indices"]).alias("indices"),
            F.when(is_dense, dense["v"]).otherwise(raw["values"]).alias("values"),
        ),
    )


def join_numbers(numbers: Column | str) -> Column:
    """Array of numbers to a comma-joined string; an empty array gives an empty string."""
    numbers = F.col(numbers) if isinstance(numbers, str) else numbers
    return F.array_join(numbers.cast("array<string>"), ",")


def split_numbers(text: Column | str, element: str) -> Column:
    """Comma-joined string to an array of ``element``; null and empty text give an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    empty = F.array().cast(f"array<{element}>")
    return F.when(F.length(text) > 0, F.split(text, ",").cast(f"array<{element}>")).otherwise(empty)
