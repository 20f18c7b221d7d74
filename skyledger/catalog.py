"""Every query by key, over the derived tables of one test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.comparing import compare
from skyledger.operators.heavy import heavy_hitters
from skyledger.operators.profiling import null_counts, rows_per
from skyledger.plans import exploration, reports
from skyledger.plans.delays import delay_stats
from skyledger.plans.fleet import (
    flights_per_tail,
    flights_with_airline,
    least_flown_models,
    rollup_delta,
    top_models_colocated,
    top_models_from_rollup,
    top_models_per_airline,
)
from skyledger.plans.top_models import model_counts, top_models
from skyledger.session import scratch_path
from skyledger.sources import (
    colocated,
    derived,
    incremental,
    layouts,
    mixed_headers,
    quarantine,
    schemas,
    tables,
)

Query = Callable[[SparkSession, str], DataFrame]

COUNTRY = "NATION_3"
MISSING_COUNTRY = "bob"
YEAR = 1996
TAIL = "N000050"
NAME_PATTERN = "%000%"
FILE_CAP = 500
HEAVY_SHARE = 0.0005


# Most flown models of one manufacturer


def t1_top_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_models(derived.flights(spark, sf_dir), derived.aircrafts(spark, sf_dir))


def t1_top_models_flown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_models(
        derived.flights(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        flown_only=True,
    )


def t1_model_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_counts(
        derived.flights(spark, sf_dir), derived.aircrafts(spark, sf_dir)
    )


# Delays per airline


def t2_delay_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delay_stats(
        derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir), YEAR
    )


def t2_delay_stats_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delay_stats(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        YEAR,
        early_wrap="absolute",
    )


def t2_delay_stats_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delay_stats(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        YEAR,
        country=COUNTRY,
    )


def t2_delay_stats_from_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = derived.flights(spark, sf_dir)
    path = scratch_path(spark, "flights-by-year")
    layouts.write_flights_by_year(flights, path)
    in_year = layouts.read_flights_by_year(spark, path).filter(F.col("year") == YEAR)
    return delay_stats(in_year, derived.airlines(spark, sf_dir))


def t2_delay_stats_from_csv_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = derived.flights(spark, sf_dir)
    # A CSV file has its columns by place, so the table is written with all of them.
    columns = [
        F.col(field.name) if field.name in flights.columns
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in schemas.FLIGHTS
    ]
    path = scratch_path(spark, "flights-by-year-csv")
    layouts.write_flights_by_year(flights.select(*columns), path, fmt="csv")
    stored = layouts.read_flights_by_year(spark, path, fmt="csv")
    return delay_stats(
        stored.filter(F.col("year") == YEAR), derived.airlines(spark, sf_dir)
    )


def _flights_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "flights-csv")
    tables.write_csv(derived.flight_file_rows(spark, sf_dir), path)
    return path


def t2_delay_stats_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = tables.read_flights(spark, _flights_csv(spark, sf_dir))
    return delay_stats(flights, derived.airlines(spark, sf_dir), YEAR)


# Models per airline


def t3_top_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_models_per_airline(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
    )


def t3_top_fleet_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_models_per_airline(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
        ties="exact",
    )


def t3_top_fleet_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by-tail")
    # Tables of the session's catalog are called after their folder, which is new.
    name = path.rpartition("/")[2].replace("-", "_")
    names = {"flights_table": f"{name}_flights", "aircrafts_table": f"{name}_aircrafts"}
    colocated.write_colocated(
        derived.flights(spark, sf_dir), derived.aircrafts(spark, sf_dir), path, **names
    )
    flights, aircrafts = colocated.read_colocated(spark, **names)
    return top_models_colocated(flights, derived.airlines(spark, sf_dir), aircrafts, COUNTRY)


def t3_least_flown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return least_flown_models(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
    )


# Where the rollup of an application, folder and format is, once some query has written it.
_ROLLUPS: dict[tuple[str, str, str], str] = {}


def _stored_rollup(
    spark: SparkSession, sf_dir: str, fmt: str = "parquet"
) -> DataFrame:
    written = (spark.sparkContext.applicationId, sf_dir, fmt)
    if written not in _ROLLUPS:
        per_tail = flights_per_tail(
            derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir)
        )
        path = scratch_path(spark, "country-rollup")
        layouts.write_country_rollup(per_tail, path, fmt=fmt)
        _ROLLUPS[written] = path
    return layouts.read_country_rollup(spark, _ROLLUPS[written], fmt=fmt)


def t3_top_fleet_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_models_from_rollup(
        _stored_rollup(spark, sf_dir), derived.aircrafts(spark, sf_dir), COUNTRY
    )


def t3_top_fleet_from_csv_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_models_from_rollup(
        _stored_rollup(spark, sf_dir, "csv"), derived.aircrafts(spark, sf_dir), COUNTRY
    )


def t3_missing_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_models_from_rollup(
        _stored_rollup(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        MISSING_COUNTRY,
    )
    return found.agg(F.count(F.lit(1)).alias("n"))


# Layouts


def layout_year_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = derived.flights(spark, sf_dir)
    path = scratch_path(spark, "flights-by-year-carrier")
    layouts.write_flights_by_year(flights, path)
    stored = layouts.read_flights_by_year(spark, path)
    return rows_per(stored.filter(F.col("year") == YEAR), "carrier_code")


def layout_country_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _stored_rollup(spark, sf_dir)
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("count").alias("numFlights"),
        )
    )


def layout_country_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "country-flights")
    layouts.write_country_flights(
        flights_with_airline(
            derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir)
        ),
        path,
    )
    return (
        layouts.read_country_flights(spark, path)
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("tail_number").alias("tails"),
            F.count_distinct("name").alias("names"),
        )
    )


def layout_country_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "country-tail")
    layouts.write_country_tail(
        flights_with_airline(
            derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir)
        ),
        path,
    )
    stored = layouts.read_country_flights(spark, path)
    return rows_per(stored.filter(F.col("country") == COUNTRY), "name", "tail_number")


def flights_of_tail_from_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "country-tail")
    layouts.write_country_tail(
        flights_with_airline(
            derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir)
        ),
        path,
    )
    stored = layouts.read_country_flights(spark, path)
    return rows_per(stored.filter(F.col("tail_number") == TAIL), "country", "carrier_code")


def layout_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: days up to the 20th with gaps, then days from the 11th on, then
    those up to the 10th, the last one twice."""
    flights = derived.flights(spark, sf_dir)
    flights = flights.select(
        *(
            F.col(f.name) if f.name in flights.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.FLIGHTS
        )
    )
    day = F.dayofmonth("flight_date")
    early, late = flights.filter(day <= 10), flights.filter(day > 10)
    gaps = flights.filter((day <= 20) & (F.col("flight_id") % 5 != 0))
    path = scratch_path(spark, "flights-by-day")
    for delivery in (gaps, late, early, early):
        incremental.load_days(delivery, path, keys=layouts.YEAR_ONLY)
    return (
        layouts.read_flights_by_year(spark, path)
        .groupBy("year", "carrier_code")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("flight_id").alias("ids"))
    )


def layout_rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tenths of the flights, then the next three, then the last one and the news that
    every seventh flight of the first six tenths was cancelled; the last delta twice."""
    flights, airlines = derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir)
    tenth = F.col("flight_id") % 10
    gone = (tenth < 6) & (F.col("flight_id") % 7 == 0)
    was_flown = F.col("actual_departure_time").isNotNull()
    path = scratch_path(spark, "rollup-by-delta")
    deltas = {
        "first": rollup_delta(airlines, flown=flights.filter(tenth < 6)),
        "second": rollup_delta(airlines, flown=flights.filter(tenth.between(6, 8))),
        "third": rollup_delta(
            airlines,
            flown=flights.filter(tenth == 9),
            cancelled=flights.filter(gone & was_flown),
        ),
    }
    for name in (*deltas, "third"):
        incremental.apply_delta(deltas[name], path, name)
    return (
        layouts.read_country_rollup(spark, path)
        .groupBy("country", "carrier_code")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("numFlights"))
    )


def layout_file_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = _stored_rollup(spark, sf_dir)
    path = scratch_path(spark, "country-rollup-capped")
    layouts.write_country_rollup(rollup, path, max_records_per_file=FILE_CAP)
    files = rows_per(
        layouts.read_country_rollup(spark, path).select(
            F.input_file_name().alias("file")
        ),
        "file",
    )
    return files.agg(
        (F.max("n") <= FILE_CAP).alias("within_cap"), F.sum("n").alias("total")
    )


# Exploration


def flights_by_year_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.flights_by_year_carrier(derived.flights(spark, sf_dir))


def rollup_by_country_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_tail = flights_per_tail(
        derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir)
    )
    return exploration.rollup_by_country_carrier(per_tail)


def flights_in_year_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.flights_in_year_total(derived.flights(spark, sf_dir), YEAR)


def flights_of_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.flights_of_tail(derived.flights(spark, sf_dir), TAIL)


def flight_id_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.flight_id_counts(derived.flights(spark, sf_dir))


def aircraft_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.aircraft_by_model(derived.aircrafts(spark, sf_dir))


def models_per_airline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.models_per_airline(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
    )


def country_model_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.country_model_counts(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
    )


def country_tail_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.country_tail_counts(
        derived.flights(spark, sf_dir), derived.airlines(spark, sf_dir), COUNTRY
    )


def fleet_right_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.fleet_right_outer(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
    )


def fleet_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.fleet_usage(
        derived.flights(spark, sf_dir), derived.aircrafts(spark, sf_dir)
    )


def fleet_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.fleet_with_unknown(
        derived.flights(spark, sf_dir),
        derived.airlines(spark, sf_dir),
        derived.aircrafts(spark, sf_dir),
        COUNTRY,
    )


def airline_name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.airline_name_search(
        derived.airlines(spark, sf_dir), COUNTRY, NAME_PATTERN
    )


def distinct_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.distinct_countries(derived.airlines(spark, sf_dir))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _flights_csv(spark, sf_dir)
    text = tables.read_csv(spark, path, _as_text(schemas.FLIGHTS_FILE))
    return exploration.schema_drift(text, tables.read_flights(spark, path), YEAR)


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.names])


def profile_lost_to_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _flights_csv(spark, sf_dir)
    text = tables.read_csv(spark, path, _as_text(schemas.FLIGHTS_FILE))
    typed = [f for f in schemas.FLIGHTS_FILE if not isinstance(f.dataType, T.StringType)]
    return exploration.lost_to_typing(text, T.StructType(typed))


def compare_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights file as text and as typed, each read without some of its flights."""
    path = _flights_csv(spark, sf_dir)
    columns = [
        "flight_id", "flight_date", "tail_number", "actual_departure_time"
    ]
    text = tables.read_csv(spark, path, _as_text(schemas.FLIGHTS_FILE)).select(columns)
    typed = tables.read_flights(spark, path).select(
        *(F.col(name).cast("string").alias(name) for name in columns)
    )
    return compare(
        text.filter(F.col("flight_id").cast("long") % 61 != 0),
        typed.filter(F.col("flight_id").cast("long") % 59 != 0),
        ["flight_id"],
    )


# Data quality


def profile_heavy_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_hitters(derived.flights(spark, sf_dir), "tail_number", HEAVY_SHARE)


def profile_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(derived.flights(spark, sf_dir))


def profile_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.cancelled_flights(derived.flights(spark, sf_dir))


def profile_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.duplicate_keys(
        {
            "airlines": (derived.airlines(spark, sf_dir), "carrier_code"),
            "aircrafts": (derived.aircrafts(spark, sf_dir), "tailnum"),
            "flights": (derived.flights(spark, sf_dir), "flight_id"),
        }
    )


def profile_early_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.early_departures(derived.flights(spark, sf_dir))


def profile_extreme_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.extreme_delays(derived.flights(spark, sf_dir))


def profile_join_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.join_coverage(
        derived.flights(spark, sf_dir), derived.aircrafts(spark, sf_dir)
    )


def profile_midnight_24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.midnight_24(derived.flights(spark, sf_dir))


# Text sources


def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "aircrafts-csv")
    tables.write_csv(derived.aircraft_file_rows(spark, sf_dir), path)
    return tables.read_aircrafts(spark, path)


def src_uri_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths are passed through as they are, with blanks and other letters in them too."""
    path = f"{scratch_path(spark, 'by uri')}/flottenübersicht 1+1 %41/aircraft, all.csv"
    tables.write_csv(derived.aircraft_file_rows(spark, sf_dir), path)
    return tables.read_aircrafts(spark, path).select("tailnum", "manufacturer", "model")


def src_csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "airlines-csv")
    tables.write_csv(derived.airlines(spark, sf_dir), path, header=False)
    return tables.read_airlines(spark, path, header=False)


def src_csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each aircraft as a whole line, one cut short and one with surplus fields."""
    rows = derived.aircraft_file_rows(spark, sf_dir)
    line = F.to_csv(F.struct(*rows.columns))
    cut = F.to_csv(F.struct(*rows.columns[:3]))
    surplus = F.to_csv(F.struct(*rows.columns, F.lit("surplus").alias("surplus")))
    path = scratch_path(spark, "aircrafts-ragged")
    rows.select(F.explode(F.array(line, cut, surplus)).alias("line")).write.text(path)
    return tables.read_aircrafts(
        spark, path, header=False, drop_malformed=True
    ).select("tailnum", "manufacturer", "model")


def src_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and the sum of their flight ids, per reason for which they are rejected."""
    path = scratch_path(spark, "flight-lines")
    derived.flight_lines(spark, sf_dir).write.text(path)
    load = quarantine.load_csv(
        spark, path, scratch_path(spark, "flights-loaded"), schemas.FLIGHTS_FILE, header=False
    )
    first = F.substring_index(quarantine.LINE, ",", 1).cast("long")
    rejected = load.rejected.select(
        F.col(quarantine.REASON).alias("reason"), first.alias("flight_id")
    )
    accepted = load.accepted.select(F.lit("accepted").alias("reason"), "flight_id")
    return (
        rejected.unionByName(accepted)
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("flight_id").alias("ids"))
    )


def src_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flights-mixed")
    for part in derived.flight_file_parts(spark, sf_dir):
        part.write.mode("append").option("header", True).csv(path)
    return mixed_headers.read_flights_by_header(spark, path).select(
        "flight_id",
        "carrier_code",
        "flight_number",
        F.date_format("flight_date", "yyyy-MM-dd").alias("flight_date"),
        "tail_number",
        schemas.SCHEDULED,
        "actual_departure_time",
    )


# Reports


def report_model_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.model_lines(t1_top_models(spark, sf_dir))


def report_delay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.delay_lines(t2_delay_stats(spark, sf_dir))


def report_fleet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fleet_lines(t3_top_fleet_exact(spark, sf_dir))


def report_fleet_lines_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ranked_lines(t3_top_fleet(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        t1_top_models,
        t1_top_models_flown,
        t1_model_counts,
        t2_delay_stats,
        t2_delay_stats_absolute,
        t2_delay_stats_country,
        t2_delay_stats_from_layout,
        t2_delay_stats_from_csv_layout,
        t2_delay_stats_from_csv,
        t3_top_fleet,
        t3_top_fleet_exact,
        t3_top_fleet_from_rollup,
        t3_top_fleet_from_csv_rollup,
        t3_top_fleet_colocated,
        t3_least_flown,
        t3_missing_country,
        layout_year_carrier,
        layout_country_rollup,
        layout_country_flights,
        layout_country_tail,
        layout_file_cap,
        layout_incremental,
        layout_rollup_incremental,
        flights_by_year_carrier,
        rollup_by_country_carrier,
        flights_in_year_total,
        flights_of_tail,
        flights_of_tail_from_layout,
        flight_id_counts,
        aircraft_by_model,
        models_per_airline,
        country_model_counts,
        country_tail_counts,
        fleet_right_outer,
        fleet_usage,
        fleet_with_unknown,
        airline_name_search,
        distinct_countries,
        schema_drift,
        compare_reads,
        profile_heavy_tails,
        profile_null_counts,
        profile_cancelled,
        profile_duplicate_keys,
        profile_early_departures,
        profile_extreme_delays,
        profile_join_coverage,
        profile_midnight_24,
        profile_lost_to_typing,
        src_csv_roundtrip,
        src_uri_path,
        src_csv_headerless,
        src_csv_ragged,
        src_csv_quarantine,
        src_csv_mixed_headers,
        report_model_lines,
        report_delay_lines,
        report_fleet_lines,
        report_fleet_lines_ties,
    )
}
