"""Explicit schemas: no read infers types."""

from __future__ import annotations

from pyspark.sql import types as T

# Table columns in file order. The source files misspell one name,
# which readers mend once.
MISSPELT_SCHEDULED = "scheduled_depature_time"
SCHEDULED = "scheduled_departure_time"

FLIGHTS_FILE = T.StructType(
    [
        T.StructField("flight_id", T.LongType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("flight_number", T.StringType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("tail_number", T.StringType()),
        T.StructField(MISSPELT_SCHEDULED, T.StringType()),
        T.StructField("scheduled_arrival_time", T.StringType()),
        T.StructField("actual_departure_time", T.StringType()),
        T.StructField("actual_arrival_time", T.StringType()),
        T.StructField("distance", T.IntegerType()),
    ]
)

# Columns of the flights that some job needs.
NEEDED = (
    "carrier_code",
    "flight_date",
    "tail_number",
    SCHEDULED,
    "actual_departure_time",
)

AIRCRAFTS = T.StructType(
    [
        T.StructField("tailnum", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("issue_date", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("aircraft_type", T.StringType()),
        T.StructField("engine_type", T.StringType()),
        T.StructField("year", T.StringType()),
    ]
)

AIRLINES = T.StructType(
    [
        T.StructField("carrier_code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

COUNTRY_ROLLUP = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("tail_number", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)


def corrected(schema: T.StructType) -> T.StructType:
    """``schema`` with the misspelt departure column under its right name."""
    return T.StructType(
        [
            T.StructField(
                SCHEDULED if field.name == MISSPELT_SCHEDULED else field.name,
                field.dataType,
            )
            for field in schema
        ]
    )


FLIGHTS = corrected(FLIGHTS_FILE)

COUNTRY_FLIGHTS = T.StructType(
    [
        *FLIGHTS,
        T.StructField("name", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)
