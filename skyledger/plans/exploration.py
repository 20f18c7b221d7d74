"""Exploration of the tables: usage of the fleet, skew, and data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions import departure_gap, flown, in_year, in_year_text
from skyledger.operators.profiling import difference, repeated_keys, rows_per
from skyledger.plans.fleet import (
    flights_per_model,
    flights_per_tail,
    known_aircrafts,
)

MIDNIGHT_24 = "24:00:00"


def _same_tail() -> Column:
    return F.col("tail_number") == F.col("tailnum")


# Fleet


def aircraft_by_model(aircrafts: DataFrame) -> DataFrame:
    return rows_per(aircrafts, "manufacturer", "model")


def models_per_airline(
    flights: DataFrame, airlines: DataFrame, aircrafts: DataFrame, country: str
) -> DataFrame:
    """Number of different known models each airline of the country has flown."""
    per_tail = flights_per_tail(flights, airlines, country=country)
    return rows_per(flights_per_model(per_tail, aircrafts), "name")


def country_model_counts(
    flights: DataFrame, airlines: DataFrame, aircrafts: DataFrame, country: str
) -> DataFrame:
    """All flights of the country's airlines per model of a listed aircraft."""
    per_tail = flights_per_tail(flights, airlines, country=country, flown_only=False)
    models = aircrafts.select("tailnum", "model")
    return (
        per_tail.filter(F.col("tail_number").isNotNull())
        .join(models, _same_tail())
        .groupBy("model")
        .agg(F.sum("count").alias("numFlights"))
    )


def country_tail_counts(
    flights: DataFrame, airlines: DataFrame, country: str
) -> DataFrame:
    per_tail = flights_per_tail(flights, airlines, country=country, flown_only=False)
    return per_tail.select(
        "name", "carrier_code", "tail_number", F.col("count").alias("n")
    )


def fleet_right_outer(
    flights: DataFrame, airlines: DataFrame, aircrafts: DataFrame, country: str
) -> DataFrame:
    """Every aircraft with the country's airlines that used it; nulls where none did."""
    # A flight without a tail number can match no aircraft.
    per_tail = flights_per_tail(
        flights.filter(F.col("tail_number").isNotNull()),
        airlines,
        country=country,
        flown_only=False,
    )
    return per_tail.join(aircrafts, _same_tail(), "right").select(
        "tailnum", "manufacturer", "model", "name", F.col("count").alias("n")
    )


def fleet_usage(flights: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Rows of aircraft left-joined to flights per flight tail number.

    Unused aircraft count one row each, under a null tail number.
    """
    legs = flights.filter(F.col("tail_number").isNotNull())
    per_tail = rows_per(legs, "tail_number", alias="legs")
    return (
        aircrafts.select("tailnum")
        .join(per_tail, _same_tail(), "left")
        .groupBy("tail_number")
        .agg(F.sum(F.coalesce("legs", F.lit(1))).alias("n"))
    )


def fleet_with_unknown(
    flights: DataFrame, airlines: DataFrame, aircrafts: DataFrame, country: str
) -> DataFrame:
    """Flights per (manufacturer, model, name), unlisted aircraft as a null model."""
    per_tail = flights_per_tail(flights, airlines, country=country, flown_only=False)
    models = aircrafts.select("tailnum", "manufacturer", "model")
    return (
        per_tail.join(models, _same_tail(), "left")
        .groupBy("manufacturer", "model", "name")
        .agg(F.sum("count").alias("numFlights"))
    )


def join_coverage(flights: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Number of flights whose aircraft has a known manufacturer and model."""
    legs = flights.filter(F.col("tail_number").isNotNull())
    per_tail = rows_per(legs, "tail_number", alias="legs")
    known = known_aircrafts(aircrafts).where(F.col("tailnum").isNotNull())
    return per_tail.join(known, _same_tail()).agg(
        F.coalesce(F.sum("legs"), F.lit(0)).alias("n")
    )


# Flights


def flights_by_year_carrier(flights: DataFrame) -> DataFrame:
    by_year = flights.select(F.year("flight_date").alias("year"), "carrier_code")
    return rows_per(by_year, "year", "carrier_code")


def flights_in_year_total(flights: DataFrame, year: int) -> DataFrame:
    in_range = flights.filter(in_year(F.col("flight_date"), year))
    return rows_per(in_range, "carrier_code").agg(F.sum("n").alias("total"))


def flights_of_tail(flights: DataFrame, tail_number: str) -> DataFrame:
    return rows_per(flights, "tail_number").filter(
        F.col("tail_number") == tail_number
    )


def flight_id_counts(flights: DataFrame) -> DataFrame:
    due = flights.filter(F.col("scheduled_departure_time").isNotNull())
    return rows_per(due, "flight_id")


def cancelled_flights(flights: DataFrame) -> DataFrame:
    cancelled = F.col("actual_departure_time").isNull()
    return flights.agg(
        F.count(F.when(cancelled, 1)).alias("cancelled"),
        F.count(F.lit(1)).alias("total"),
    )


def _departure_gaps(flights: DataFrame) -> DataFrame:
    gap = departure_gap(
        F.col("scheduled_departure_time"), F.col("actual_departure_time")
    )
    return flights.filter(flown(F.col("actual_departure_time"))).select(
        "flight_id", "carrier_code", gap.alias("gap")
    )


def early_departures(flights: DataFrame) -> DataFrame:
    """Per carrier, flights whose time of departure lies before the scheduled one."""
    early = F.count(F.when(F.col("gap") < 0, 1)).alias("n")
    per_carrier = _departure_gaps(flights).groupBy("carrier_code").agg(early)
    return per_carrier.filter(F.col("n") > 0)


def extreme_delays(flights: DataFrame, below_minutes: float = -600.0) -> DataFrame:
    """Flights whose delay, midnight ignored, is under ``below_minutes``."""
    # Exploding null gives no row. A filter would be pushed below the parsing of the
    # times and repeat it, in a method too large for the JIT compiler.
    gap = F.col("gap")
    found = F.when(gap < below_minutes * 60, F.array(gap / F.lit(60.0)))
    return _departure_gaps(flights).select(
        "flight_id", F.explode(found).alias("minutes")
    )


def midnight_24(flights: DataFrame) -> DataFrame:
    scheduled = F.col("scheduled_departure_time")
    actual = F.col("actual_departure_time")
    return flights.filter(
        (scheduled == MIDNIGHT_24) | (actual == MIDNIGHT_24)
    ).select("flight_id", scheduled.alias("scheduled"), actual.alias("actual"))


def schema_drift(text: DataFrame, typed: DataFrame, year: int) -> DataFrame:
    """Flights found in ``year`` by text dates but not by typed dates, as a count."""
    by_text = text.filter(in_year_text(F.col("flight_date"), year))
    by_type = typed.filter(in_year(F.col("flight_date"), year))
    return difference(by_text.select("flight_id"), by_type.select("flight_id")).agg(
        F.count(F.lit(1)).alias("missing")
    )


def lost_to_typing(text: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per column of ``schema`` the texts that its type turns into nulls."""
    return text.agg(
        *(
            F.count(
                F.when(
                    F.col(field.name).isNotNull()
                    & F.col(field.name).try_cast(field.dataType).isNull(),
                    1,
                )
            ).alias(field.name)
            for field in schema
        )
    )


# Dimensions


def airline_name_search(
    airlines: DataFrame, country: str, pattern: str
) -> DataFrame:
    return (
        airlines.filter(F.col("country") == country)
        .filter(F.col("name").like(pattern))
        .select("carrier_code", "name")
        .orderBy("name")
    )


def distinct_countries(airlines: DataFrame) -> DataFrame:
    """Number of countries, an unknown one included, and of distinct airline rows."""
    per_country = rows_per(airlines.distinct(), "country")
    return per_country.agg(
        F.count(F.lit(1)).alias("countries"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("airlines"),
    )


def duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per named table, how many values of its key occur more than once."""
    counts = [
        repeated_keys(df, key)
        .agg(F.count(F.lit(1)).alias("duplicates"))
        .select(F.lit(name).alias("table"), "duplicates")
        for name, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def rollup_by_country_carrier(rollup: DataFrame) -> DataFrame:
    return rows_per(rollup, "country", "carrier_code")
