"""The physical plans the jobs are meant to have."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from skyledger import catalog
from skyledger.operators.joins import BROADCAST_BYTES_CONF
from skyledger.plans.delays import delay_stats
from skyledger.plans.fleet import flights_per_tail, top_models_from_rollup
from skyledger.sources import derived, layouts

SF_DIR = "/root/testdata/sf0.001"


def explained(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def final_plan(df):
    df.collect()
    return explained(df, "simple").split("== Initial Plan ==")[0]


def scan_of(plan, column):
    """The scan block of the formatted plan that reads ``column``."""
    blocks = re.split(r"\n\n+", plan)
    return next(b for b in blocks if "Scan parquet" in b and f"{column}:" in b)


@pytest.fixture(scope="module")
def stored_flights(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "flights")
    flights = derived.flights(spark, SF_DIR)
    layouts.write_flights_by_year(flights, path, keys=layouts.YEAR_ONLY)
    return layouts.read_flights_by_year(spark, path)


def test_delays_read_one_year_and_three_columns(spark, stored_flights):
    in_year = stored_flights.filter(F.col("year") == 1996)
    plan = explained(delay_stats(in_year, derived.airlines(spark, SF_DIR)))
    scan = scan_of(plan, "actual_departure_time")
    assert "PartitionFilters: [isnotnull(year" in scan
    assert "IsNotNull(actual_departure_time)" in scan
    schema = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert sorted(field.split(":")[0] for field in schema.split(",")) == [
        "actual_departure_time",
        "carrier_code",
        "scheduled_departure_time",
    ]


def test_year_range_reaches_the_scan(spark, stored_flights):
    plan = explained(delay_stats(stored_flights, derived.airlines(spark, SF_DIR), 1996))
    scan = scan_of(plan, "flight_date")
    assert "GreaterThanOrEqual(flight_date,1996-01-01)" in scan
    assert "LessThanOrEqual(flight_date,1996-12-31)" in scan


@pytest.mark.parametrize("query", [catalog.t1_top_models, catalog.t2_delay_stats])
def test_small_dimensions_are_broadcast(spark, query):
    plan = final_plan(query(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_top_models_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in explained(catalog.t1_top_models(spark, SF_DIR))


def test_delays_are_aggregated_before_the_shuffle(spark):
    plan = explained(catalog.t2_delay_stats(spark, SF_DIR), "simple")
    assert plan.count("partial_count(late") == 1
    assert plan.count("RLIKE") == 2  # each time is parsed once


def test_ranking_limits_groups_and_counts_flights_once(spark):
    plan = final_plan(catalog.t3_top_fleet(spark, SF_DIR))
    assert "WindowGroupLimit" in plan
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    exact = explained(catalog.t3_top_fleet_exact(spark, SF_DIR), "simple")
    assert "WindowGroupLimit" in exact


def test_rollup_query_reads_one_country(spark, tmp_path):
    path = str(tmp_path / "rollup")
    rollup = spark.createDataFrame(
        [("Alpha", "AA", "N1", 5, "Canada"), ("Beta", "BB", "N1", 7, "Egypt")],
        "name string, carrier_code string, tail_number string, count long,"
        " country string",
    )
    layouts.write_country_rollup(rollup, path)
    stored = layouts.read_country_rollup(spark, path)
    top = top_models_from_rollup(stored, derived.aircrafts(spark, SF_DIR), "Canada")
    scan = scan_of(explained(top), "tail_number")
    assert "(country" in scan.split("PartitionFilters:")[1].split("\n")[0]
    assert "IsNotNull(tail_number)" in scan


def test_difference_shuffles_once(spark):
    plan = explained(catalog.schema_drift(spark, SF_DIR), "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


JIT_METHOD_LIMIT = 8000  # HotSpot leaves larger methods to the interpreter


@pytest.mark.parametrize(
    "query",
    [
        catalog.t1_top_models_flown,
        catalog.t2_delay_stats,
        catalog.t3_top_fleet,
        catalog.profile_early_departures,
        catalog.profile_extreme_delays,
        catalog.profile_midnight_24,
        catalog.profile_null_counts,
    ],
)
def test_generated_code_can_be_compiled(spark, query):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = explained(query(spark, SF_DIR), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert 0 < max(sizes) < JIT_METHOD_LIMIT


def test_a_hot_carrier_is_split_when_airlines_are_too_many_to_broadcast(spark):
    """Half of all flights are of one carrier, each with another aircraft."""
    flights = spark.range(0, 400_000, 1, 8).selectExpr(
        "IF(id % 2 = 0, 'HOT', concat('C', id % 500)) AS carrier_code",
        "concat('N', id) AS tail_number",
        "'10:00:00' AS actual_departure_time",
    )
    airlines = spark.range(500).selectExpr(
        "concat('C', id) AS carrier_code", "string(id) AS name", "'Canada' AS country"
    )
    hot = spark.sql("SELECT 'HOT' AS carrier_code, 'Hot' AS name, 'Canada' AS country")
    settings = {
        BROADCAST_BYTES_CONF: "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        per_tail = flights_per_tail(flights, airlines.unionByName(hot))
        plan = final_plan(per_tail.groupBy("tail_number").agg(F.sum("count")))
        assert "SortMergeJoin(skew=true)" in plan
        assert per_tail.agg(F.sum("count")).first()[0] == 400_000
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
