"""Intermediate tables in shared storage, and the size checks that gate a broadcast."""

from __future__ import annotations

import gc
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only when both of its measured sizes are within these limits.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_local_root: str | None = None
_staged: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only in local mode without a setting."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="bowline-")
    return _local_root


def staged_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted by ``release_staged``."""
    path = f"{staging_root(spark)}/bowline-{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the table read back.

    Cuts the lineage, so that later passes scan the result and a lost executor costs no recomputation.
    """
    path = staged_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession, since: int = 0, keep_last: bool = False) -> int:
    """Delete every table this process has staged; DataFrames and models built on them become unreadable.

    ``since``: only those after the first so many (``staged_count``). ``keep_last``: all but the last one, the result of
    a step whose own tables are not needed any more. Shuffle files of plans that nobody holds go as well: Spark drops
    them when the driver's garbage is collected.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = _staged[-1:] if keep_last and len(_staged) > since else []
    gone = _staged[since : len(_staged) - len(kept)]
    for name in gone:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    _staged[since:] = kept
    gc.collect()
    jvm.java.lang.System.gc()
    return len(gone)


def staged_count() -> int:
    return len(_staged)


@dataclass(frozen=True)
class TableSize:
    """Measured size of a lookup table: its rows, the bytes of its text key, and the weight of all its rows."""

    rows: int
    key_bytes: int
    weight: int = 0

    @property
    def fits_broadcast(self) -> bool:
        # 64 bytes per row cover the fixed-width columns and the hash-table entry.
        return self.rows <= BROADCAST_ROWS and self.key_bytes + 64 * self.rows <= BROADCAST_BYTES


def size_columns(key: str, weight: str | None = None) -> list[Column]:
    """Aggregates for the fields of ``TableSize``."""
    total = F.coalesce(F.sum(weight), F.lit(0)) if weight else F.lit(0)
    return [
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)).alias("key_bytes"),
        total.alias("weight"),
    ]


def measure(df: DataFrame, key: str, weight: str | None = None) -> TableSize:
    return TableSize(*df.agg(*size_columns(key, weight)).first())


def broadcast_if_small(df: DataFrame, size: TableSize) -> DataFrame:
    return F.broadcast(df) if size.fits_broadcast else df
