"""Headline queries on one machine; prints one JSON line.

The stored variants answer the same question from a flat table and from the layout
made for it, as CSV and as Parquet, to compare wall time and bytes of the files read.
They hold each flight BENCH_COPIES times, since the fixed cost of a query would hide the
difference otherwise.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import catalog
from skyledger.plans.delays import delay_stats
from skyledger.plans.fleet import (
    flights_per_tail,
    top_models_from_rollup,
    top_models_per_airline,
)
from skyledger.session import build_session, scratch_path
from skyledger.sources import derived, layouts

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "6"))
RUNS = 3

# The published row cap of the year layout; it also gives every core a file to read.
YEAR_ROWS_PER_FILE = 100_000

FORMATS = ("csv", "parquet")


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def seconds(query: Callable[[], DataFrame]) -> float:
    """Median of ``RUNS`` runs after one to warm up."""

    def run() -> None:
        query().write.format("noop").mode("overwrite").save()

    run()
    return statistics.median(timed(run) for _ in range(RUNS))


def bytes_of_files(df: DataFrame) -> int:
    """Size of the files a scan opens, after its partition filters."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size").alias("bytes")).first()["bytes"]


def stored(spark: SparkSession, df: DataFrame, name: str, fmt: str) -> DataFrame:
    """``df`` written flat in ``CPUS`` files, and read back."""
    path = scratch_path(spark, f"{name}-{fmt}")
    writer = df.repartition(CPUS).write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return layouts.read_partitioned(spark, path, df.schema, fmt=fmt)


def copied_flights(spark: SparkSession) -> DataFrame:
    """The flights ``COPIES`` times over, under different flight ids."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES)))
    flight_id = F.col("flight_id") * COPIES + F.col("copy") - 1
    return (
        derived.flights(spark, SF_DIR)
        .withColumn("copy", copies)
        .withColumn("flight_id", flight_id)
        .drop("copy")
    )


def main() -> None:
    spark = build_session(
        "skyledger-bench",
        master=f"local[{CPUS}]",
        partitions=CPUS,
        conf={
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Keep Python call sites out of each expression.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    queries: dict[str, float] = {}
    bytes_read: dict[str, int] = {}

    for query in (
        catalog.t1_top_models,
        catalog.t1_top_models_flown,
        catalog.t2_delay_stats,
        catalog.t2_delay_stats_absolute,
        catalog.t3_top_fleet,
        catalog.t3_top_fleet_exact,
        catalog.t3_least_flown,
        catalog.flights_by_year_carrier,
        catalog.flight_id_counts,
        catalog.profile_null_counts,
        catalog.schema_drift,
    ):
        queries[query.__name__] = seconds(lambda q=query: q(spark, SF_DIR))

    airlines = stored(spark, derived.airlines(spark, SF_DIR), "airlines", "parquet")
    aircrafts = stored(spark, derived.aircrafts(spark, SF_DIR), "aircrafts", "parquet")
    year_is = F.col("year") == catalog.YEAR
    country_is = F.col("country") == catalog.COUNTRY

    for fmt in FORMATS:
        flights = stored(spark, copied_flights(spark), "flights", fmt)
        flat_schema = T.StructType(flights.schema.fields)

        by_year_path = scratch_path(spark, f"by-year-{fmt}")
        queries[f"write_by_year_{fmt}"] = timed(
            lambda: layouts.write_flights_by_year(
                flights,
                by_year_path,
                # The derived flights have a thousand small carriers.
                keys=layouts.YEAR_ONLY,
                fmt=fmt,
                max_records_per_file=YEAR_ROWS_PER_FILE,
            )
        )
        by_year = layouts.read_flights_by_year(
            spark, by_year_path, fmt=fmt, schema=flat_schema
        )
        if fmt == "parquet":
            # The published layout's own directories; here a thousand carriers a year.
            by_carrier_path = scratch_path(spark, "by-year-carrier")
            queries["write_by_year_carrier_parquet"] = timed(
                lambda: layouts.write_flights_by_year(flights, by_carrier_path)
            )
            by_carrier = layouts.read_flights_by_year(
                spark, by_carrier_path, schema=flat_schema
            )
            queries["t2_by_year_carrier_parquet"] = seconds(
                lambda: delay_stats(by_carrier.filter(year_is), airlines)
            )
        rollup_path = scratch_path(spark, f"rollup-{fmt}")
        queries[f"write_rollup_{fmt}"] = timed(
            lambda: layouts.write_country_rollup(
                flights_per_tail(flights, airlines), rollup_path, fmt=fmt
            )
        )
        rollup = layouts.read_country_rollup(spark, rollup_path, fmt=fmt)

        queries[f"t2_flat_{fmt}"] = seconds(
            lambda: delay_stats(flights, airlines, catalog.YEAR)
        )
        queries[f"t2_by_year_{fmt}"] = seconds(
            lambda: delay_stats(by_year.filter(year_is), airlines)
        )
        queries[f"t3_flat_{fmt}"] = seconds(
            lambda: top_models_per_airline(
                flights, airlines, aircrafts, catalog.COUNTRY
            )
        )
        queries[f"t3_rollup_{fmt}"] = seconds(
            lambda: top_models_from_rollup(rollup, aircrafts, catalog.COUNTRY)
        )
        bytes_read[f"flat_{fmt}"] = bytes_of_files(flights)
        bytes_read[f"t2_by_year_{fmt}"] = bytes_of_files(by_year.filter(year_is))
        bytes_read[f"t3_rollup_{fmt}"] = bytes_of_files(rollup.filter(country_is))

    ratios = {
        f"{task}_{layout}_{fmt}": {
            "times_as_fast": round(
                queries[f"{task}_flat_{fmt}"] / queries[f"{task}_{layout}_{fmt}"], 2
            ),
            "fewer_bytes_percent": round(
                100 - 100 * bytes_read[f"{task}_{layout}_{fmt}"]
                / bytes_read[f"flat_{fmt}"], 1
            ),
        }
        for fmt in FORMATS
        for task, layout in (("t2", "by_year"), ("t3", "rollup"))
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": {key: round(value, 3) for key, value in queries.items()},
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": CPUS,
                "copies_of_stored_flights": COPIES,
                "layout_against_flat": ratios,
                "bytes_of_files": bytes_read,
            }
        )
    )


if __name__ == "__main__":
    main()
