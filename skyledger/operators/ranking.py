"""Top rows per group, with and without ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_within(
    df: DataFrame, group: str, value: str, n: int, *, descending: bool = True
) -> DataFrame:
    """Rows of ``df`` whose ``rank()`` by ``value`` within ``group`` is at most ``n``.

    All ties are kept, so a group may return any number of rows. The rank depends only
    on how many rows share each value: the window therefore runs over at most ``n``
    values per group, and the rows take their rank from a join on (group, value)
    instead of being gathered in one task per group.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    by_group = Window.partitionBy(group).orderBy(order)
    before = by_group.rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("tied"))
        .withColumn("position", F.row_number().over(by_group))
        .filter(F.col("position") <= n)
        .withColumn("rank", F.coalesce(F.sum("tied").over(before), F.lit(0)) + 1)
        .filter(F.col("rank") <= n)
        .select(
            F.col(group).alias("ranked_group"),
            F.col(value).alias("ranked_value"),
            F.col("rank").cast("int").alias("rank"),
        )
    )
    same_group = F.col(group).eqNullSafe(F.col("ranked_group"))
    same_value = F.col(value) == F.col("ranked_value")
    return df.join(ranks, same_group & same_value).select(*df.columns, "rank")


def first_within(
    df: DataFrame, group: str, order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, numbered from 1 as ``rank``."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
