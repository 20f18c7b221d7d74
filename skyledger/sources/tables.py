"""Readers and writers for the four input tables, as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyledger.sources import schemas

FORMATS = ("csv", "parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    drop_malformed: bool = False,
) -> DataFrame:
    """Typed CSV scan; an empty field is null.

    ``drop_malformed`` removes rows with missing or surplus fields. The parser only
    notices them when it parses whole rows, so column pruning is off in that mode.
    A header, where there is one, must agree with the schema.
    """
    reader = spark.read.schema(schema).option("header", header)
    if header:
        reader = reader.option("enforceSchema", False)
    if drop_malformed:
        reader = reader.option("mode", "DROPMALFORMED").option("columnPruning", False)
    return reader.csv(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "csv",
    **csv_options: bool,
) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    if fmt == "csv":
        return read_csv(spark, path, schema, **csv_options)
    return spark.read.schema(schema).parquet(path)


def read_flights(
    spark: SparkSession, path: str, *, fmt: str = "csv", **csv_options: bool
) -> DataFrame:
    """Flights with the misspelt source column renamed.

    Parquet may name it either way; a column that the jobs need and the files lack is
    an error, other missing columns are null.
    """
    schema = schemas.FLIGHTS_FILE
    if fmt == "parquet":
        names = set(spark.read.parquet(path).columns)
        if schemas.SCHEDULED in names:
            schema = schemas.FLIGHTS
        needed = {name for name in schemas.NEEDED if name != schemas.SCHEDULED}
        needed.add(
            schemas.SCHEDULED
            if schemas.SCHEDULED in names
            else schemas.MISSPELT_SCHEDULED
        )
        if missing := sorted(needed - names):
            raise ValueError(f"{path} lacks {', '.join(missing)}")
    flights = read_table(spark, path, schema, fmt=fmt, **csv_options)
    return flights.withColumnRenamed(schemas.MISSPELT_SCHEDULED, schemas.SCHEDULED)


def read_aircrafts(
    spark: SparkSession, path: str, *, fmt: str = "csv", **csv_options: bool
) -> DataFrame:
    return read_table(spark, path, schemas.AIRCRAFTS, fmt=fmt, **csv_options)


def read_airlines(
    spark: SparkSession, path: str, *, fmt: str = "csv", **csv_options: bool
) -> DataFrame:
    return read_table(spark, path, schemas.AIRLINES, fmt=fmt, **csv_options)


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airport codes, the only column in use, found by its name in the header."""
    return spark.read.option("header", True).csv(path).select("airport_code")


def write_csv(df: DataFrame, path: str, *, header: bool = True) -> None:
    df.write.option("header", header).csv(path)
