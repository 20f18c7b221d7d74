"""Column and key checks over any table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per(df: DataFrame, *keys: str, alias: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column of ``df``."""
    return df.agg(
        *(F.count(F.when(F.col(name).isNull(), 1)).alias(name) for name in df.columns)
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur more than once, with their row counts."""
    return rows_per(df, key).filter(F.col("n") > 1)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``, nulls being equal.

    One aggregate over both sides instead of an anti-join: a single shuffle, before
    which every repeated row has already been reduced to one per task.
    """
    both = left.withColumn("in_right", F.lit(False)).unionByName(
        right.withColumn("in_right", F.lit(True))
    )
    return (
        both.groupBy(*left.columns)
        .agg(F.bool_or("in_right").alias("in_right"))
        .filter(~F.col("in_right"))
        .drop("in_right")
    )
