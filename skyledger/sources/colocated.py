"""Flights and aircraft bucketed alike by tail, so that joining them shuffles neither."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.profiling import rows_per

BUCKETS = 64

# A busy tail's flights are dealt over slices, each of which is bucketed on its own; so
# many for each even bucket they would fill, as two slices may fall in one bucket.
SLICE = "tail_slice"
SLICES = 4


def _hot_tails(flights: DataFrame, buckets: int) -> DataFrame:
    """(hot_tail, slices) of the tails with more flights than an even bucket.

    Fewer than ``buckets`` tails can have that many, so the table is always small.
    """
    per_tail = rows_per(flights.filter(F.col("tail_number").isNotNull()), "tail_number")
    even = F.greatest(F.lit(1.0), F.lit(flights.count() / buckets))
    slices = F.ceil(F.col("n") * SLICES / even).cast("int")
    return per_tail.filter(F.col("n") > even).select(
        F.col("tail_number").alias("hot_tail"), slices.alias("slices")
    )


def _write(df: DataFrame, key: str, table: str, path: str, buckets: int) -> None:
    # Dealt as the buckets are, so that each task writes one file of one bucket.
    (
        df.repartition(buckets, key, SLICE)
        .write.bucketBy(buckets, key, SLICE)
        .sortBy(key, SLICE)
        .option("path", path)
        .saveAsTable(table)
    )


def write_colocated(
    flights: DataFrame,
    aircrafts: DataFrame,
    path: str,
    *,
    flights_table: str,
    aircrafts_table: str,
    buckets: int = BUCKETS,
) -> None:
    """Both tables below ``path``, bucketed and sorted by tail number and slice.

    A bucket is read by one task. A tail with more flights than an even bucket is
    therefore dealt over slices by a hash of the flight, and its aircraft is copied to
    each of them, so the join stays one of equal keys. Flights without a tail are dealt
    over all buckets; they join nothing.
    """
    spark = flights.sparkSession
    hot = _hot_tails(flights, buckets)
    # Chosen once, whatever reads it: both tables must slice the same tails.
    hot.write.parquet(f"{path}/hot-tails")
    hot = spark.read.schema(hot.schema).parquet(f"{path}/hot-tails")
    turn = F.xxhash64(*flights.columns)
    slices = F.when(F.col("tail_number").isNull(), buckets).otherwise(
        F.coalesce("slices", F.lit(1))
    )
    dealt = flights.join(
        F.broadcast(hot), F.col("tail_number") == F.col("hot_tail"), "left"
    ).withColumn(SLICE, F.pmod(turn, slices).cast("int"))
    _write(
        dealt.drop("hot_tail", "slices"), "tail_number", flights_table, f"{path}/flights", buckets
    )
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))
    copied = aircrafts.join(
        F.broadcast(hot), F.col("tailnum") == F.col("hot_tail"), "left"
    ).withColumn(SLICE, copies)
    _write(
        copied.drop("hot_tail", "slices"), "tailnum", aircrafts_table, f"{path}/aircrafts", buckets
    )


def read_colocated(
    spark: SparkSession, flights_table: str, aircrafts_table: str
) -> tuple[DataFrame, DataFrame]:
    return spark.table(flights_table), spark.table(aircrafts_table)
