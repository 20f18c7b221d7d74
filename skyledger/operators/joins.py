"""Broadcasts that are measured before they are asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session setting for the largest side to broadcast, in bytes, and its default.
BROADCAST_BYTES_CONF = "skyledger.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

# Row header, hash-table slot and per-column word of a row held for a hash join.
ROW_OVERHEAD_BYTES = 32
COLUMN_BYTES = 16


def size_in_memory(df: DataFrame) -> Column:
    """The aggregate of ``df`` that tells its size in memory, as ``bytes``."""
    fixed = ROW_OVERHEAD_BYTES + COLUMN_BYTES * len(df.columns)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    row = " + ".join(
        [f"{fixed}L", *(f"coalesce(octet_length(`{name}`), 0)" for name in texts)]
    )
    return F.expr(f"coalesce(sum({row}), 0L)").alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df``, from one aggregate that returns a single row."""
    return df.agg(size_in_memory(df)).first()["bytes"]


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df``, read in full, is within the session's broadcast limit."""
    limit = broadcast_limit(df.sparkSession)
    return limit > 0 and measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint when it fits; otherwise Spark shuffles it."""
    return F.broadcast(df) if fits_broadcast(df) else df
