"""Flights per model code of one manufacturer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import flown, model_code
from skyledger.operators.bloom import possibly_in
from skyledger.operators.joins import broadcast_limit, size_in_memory
from skyledger.operators.profiling import rows_per

# Fixed value: the manufacturer the model ranking is about, as the aircraft table has it.
CESSNA = "CESSNA"


def model_counts(
    flights: DataFrame,
    aircrafts: DataFrame,
    *,
    manufacturer: str = CESSNA,
    flown_only: bool = False,
) -> DataFrame:
    """Flights per three-digit model code, most flown first.

    Codes that were never flown keep a null count, unless ``flown_only``, which also
    leaves cancelled flights out.
    """
    planes = aircrafts.filter(F.col("manufacturer") == manufacturer).select(
        "tailnum", model_code(F.col("model")).alias("modelName")
    )
    legs = flights.filter(F.col("tail_number").isNotNull())
    if flown_only:
        legs = legs.filter(flown(F.col("actual_departure_time")))
    legs = legs.select("tail_number")
    same_tail = F.col("tail_number") == F.col("tailnum")

    codes = _codes_if_small(planes)
    if codes is not None:
        flown_codes = rows_per(
            legs.join(F.broadcast(planes), same_tail).select(
                F.col("modelName").alias("code")
            ),
            "code",
            alias="numFlights",
        )
        # Three digits make at most a thousand codes, so these counts are always small.
        counts = codes.join(
            F.broadcast(flown_codes), F.col("modelName").eqNullSafe(F.col("code")), "left"
        ).select("modelName", "numFlights")
    else:
        # Of other manufacturers' flights hardly any is counted and shuffled.
        legs = possibly_in(legs, "tail_number", planes, "tailnum")
        per_tail = rows_per(legs, "tail_number")
        counts = (
            planes.join(per_tail, same_tail, "left")
            .groupBy("modelName")
            .agg(F.sum("n").alias("numFlights"))
        )
    if flown_only:
        counts = counts.filter(F.col("numFlights").isNotNull())
    return counts.orderBy(F.col("numFlights").desc_nulls_last(), "modelName")


def _codes_if_small(planes: DataFrame) -> DataFrame | None:
    """The different codes of ``planes`` if these fit a broadcast, none otherwise.

    Both are told by one pass over the aircraft; of codes there are a thousand at most,
    a blank one and a null.
    """
    spark = planes.sparkSession
    limit = broadcast_limit(spark)
    if limit <= 0:
        return None
    found = planes.agg(
        size_in_memory(planes),
        F.collect_set("modelName").alias("codes"),
        F.coalesce(F.bool_or(F.col("modelName").isNull()), F.lit(False)).alias("unknown"),
    ).first()
    if found["bytes"] > limit:
        return None
    codes = [(code,) for code in found["codes"] + [None] * found["unknown"]]
    return spark.createDataFrame(codes, "modelName string")


def top_models(
    flights: DataFrame,
    aircrafts: DataFrame,
    n: int = 3,
    *,
    manufacturer: str = CESSNA,
    flown_only: bool = False,
) -> DataFrame:
    """The ``n`` most flown model codes; models without a code are left out."""
    counts = model_counts(
        flights, aircrafts, manufacturer=manufacturer, flown_only=flown_only
    )
    return counts.filter(F.col("modelName") != "").limit(n)
