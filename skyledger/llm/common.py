"""Helpers the operators share: stored intermediate tables and linked components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import scratch_path

# White space as the contracts count it: space, tab, line feed to carriage return.
# ``bytes.split()`` without arguments separates at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


# Spark's own setting that removes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """``df`` written to the shared scratch folder, with the writer's ``options``, and read
    again.

    It cuts the lineage: a lost executor costs a read, not the work before it. The
    shuffle files of the work are removed as soon as its result is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is made once however often ``then`` names it: the
    optimiser puts a column's expression wherever the column stands, in lambdas too."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def file_order(df: DataFrame) -> list[Column]:
    """Columns that sort ``df``, read from files that a job wrote, in the order of the
    writing tasks and of their rows; none if it is no such read."""
    name = F.col("_metadata.file_name")
    # Numbers of tasks have five digits, or more.
    order = [F.length(F.substring_index(name, "-", 2)), name, F.col("_metadata.row_index")]
    try:
        df.select(*order)
    except AnalysisException:
        return []
    return order


def _checksum(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id of every id in ``links`` (a, b), as (id, component).

    Alternating stars: every node points its larger neighbours, then its smaller ones,
    at the smallest of them, until nothing changes. The rounds are aggregates and
    joins, so a hub is split like any hot join key; their number grows with the
    logarithm of the longest chain. Each round is written to the scratch folder.
    Links with a null end or of a node to itself say nothing and are ignored.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = links.filter(F.col("a") != F.col("b")).select(low, high).distinct()
    links = stored(links, "links")
    before = _checksum(links)
    while before[0]:
        reverse = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = (
            links.unionByName(reverse)
            .groupBy("a")
            .agg(F.min("b").alias("m"))
            .select("a", F.least("a", "m").alias("m"))
        )
        large = links.join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        large = stored(large, "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        inner = (
            large.join(least, "b")
            .filter(F.col("a") != F.col("m"))
            .select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        links = least.select(F.col("m").alias("a"), "b").unionByName(inner)
        links = stored(links.distinct(), "small-star")
        after = _checksum(links)
        if after == before:
            break
        before = after
    leaves = links.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = links.select(F.col("a").alias("id"), F.col("a").alias("component"))
    return leaves.unionByName(roots.distinct())
