"""Departure delays per airline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import departure_gap, flown, in_year, wrap_gap


def delay_stats(
    flights: DataFrame,
    airlines: DataFrame,
    year: int | None = None,
    *,
    country: str | None = None,
    early_wrap: str = "signed",
) -> DataFrame:
    """Count, mean, least and greatest departure delay, in minutes, of late flights.

    ``year`` may be left out when ``flights`` already holds one year, such as one
    partition of the year layout. ``country`` restricts the airlines.
    """
    if year is not None:
        flights = flights.filter(in_year(F.col("flight_date"), year))
    if country is not None:
        airlines = airlines.filter(F.col("country") == country)

    gap = departure_gap(
        F.col("scheduled_departure_time"), F.col("actual_departure_time")
    )
    # One select per step, each reading the one before by name: a condition on the
    # delay in a filter would be pushed to the scan and parse the times once per use.
    late = (
        flights.filter(flown(F.col("actual_departure_time")))
        .select("carrier_code", gap.cast("long").alias("gap"))
        .select("carrier_code", wrap_gap(F.col("gap"), early_wrap).alias("delay"))
        .select("carrier_code", F.when(F.col("delay") > 0, F.col("delay")).alias("late"))
    )
    # Whole seconds add up exactly in any order; minutes as doubles would not.
    per_carrier = (
        late.groupBy("carrier_code")
        .agg(
            F.count("late").alias("numOfDelays"),
            F.sum("late").alias("total"),
            F.min("late").alias("least"),
            F.max("late").alias("greatest"),
        )
        .filter(F.col("numOfDelays") > 0)
    )
    mean = F.col("total") / (F.col("numOfDelays") * 60)
    names = airlines.select("carrier_code", "name")
    return per_carrier.join(names, "carrier_code").select(
        "name",
        "numOfDelays",
        F.round(mean, 2).alias("avgDelays"),
        (F.col("least") / 60).alias("minDelay"),
        (F.col("greatest") / 60).alias("maxDelay"),
    )
