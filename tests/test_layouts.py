from __future__ import annotations

import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.plans.fleet import top_models_from_rollup
from skyledger.sources import layouts, schemas

FLIGHTS = T.StructType(
    [
        T.StructField("flight_id", T.LongType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("flight_date", T.DateType()),
    ]
)


def flights(spark):
    # Codes that look like numbers, an unknown carrier and an unknown date.
    rows = [
        (1, "4D", datetime.date(1995, 1, 1)),
        (2, "007", datetime.date(1995, 7, 1)),
        (3, "007", datetime.date(1996, 7, 1)),
        (4, None, datetime.date(1996, 7, 1)),
        (5, "4D", None),
    ]
    return spark.createDataFrame(rows, FLIGHTS)


def directories(path):
    return {str(p.parent.relative_to(path)) for p in Path(path).rglob("part-*")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("keys", [layouts.YEAR_CARRIER, layouts.YEAR_ONLY])
def test_flights_by_year_come_back_as_written(spark, tmp_path, fmt, keys):
    path = str(tmp_path / "out")
    layouts.write_flights_by_year(flights(spark), path, keys=keys, fmt=fmt)
    stored = layouts.read_flights_by_year(spark, path, fmt=fmt, schema=FLIGHTS)
    columns = ["flight_id", "carrier_code", "flight_date", "year"]
    found = [tuple(row) for row in stored.select(columns).orderBy("flight_id").collect()]
    expected = flights(spark).withColumn("year", F.year("flight_date"))
    assert found == [tuple(row) for row in expected.select(columns).collect()]
    in_1996 = stored.filter(F.col("year") == 1996)
    assert sorted(row.flight_id for row in in_1996.collect()) == [3, 4]


def test_two_levels_of_directories(spark, tmp_path):
    path = str(tmp_path / "out")
    layouts.write_flights_by_year(flights(spark), path)
    assert directories(path) == {
        "year=1995/carrier_code=4D",
        "year=1995/carrier_code=007",
        "year=1996/carrier_code=007",
        "year=1996/carrier_code=__HIVE_DEFAULT_PARTITION__",
        "year=__HIVE_DEFAULT_PARTITION__/carrier_code=4D",
    }


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_many_carriers_share_directories(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    many = spark.range(300).selectExpr(
        "id AS flight_id",
        "IF(id % 50 = 0, NULL, lpad(string(id % 150), 4, '0')) AS carrier_code",
        "IF(id % 7 = 0, NULL, make_date(1990 + int(id % 3), 5, 1)) AS flight_date",
    )
    layouts.write_flights_by_year(many, path, fmt=fmt, most_directories=40)
    assert len(directories(path)) <= 40
    stored = layouts.read_flights_by_year(spark, path, fmt=fmt, schema=FLIGHTS)
    expected = layouts.with_year(many)
    assert sorted(stored.columns) == sorted(expected.columns)
    stored = stored.select(expected.columns)
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()
    in_1991 = stored.filter(F.col("year") == 1991)
    files = in_1991.select("_metadata.file_path").distinct().collect()
    assert files and all("year=1991" in row.file_path for row in files)


def test_year_filter_chooses_directories(spark, tmp_path):
    path = str(tmp_path / "out")
    layouts.write_flights_by_year(flights(spark), path)
    stored = layouts.read_flights_by_year(spark, path, schema=FLIGHTS)
    wanted = stored.filter(F.col("year") == 1996)
    files = wanted.select("_metadata.file_path").distinct().collect()
    assert len(files) == 2
    assert all("year=1996" in row.file_path for row in files)


ROLLUP = [
    ("Alpha", "AA", "N1", 5, "Canada"),
    ("Alpha", "AA", "N2", 2, "Canada"),
    ("Beta", "007", "N1", 7, "Korea, South"),
    ("Gamma", "CC", None, 1, None),
]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rollup_comes_back_as_written(spark, tmp_path, fmt):
    path = str(tmp_path / "rollup")
    rollup = spark.createDataFrame(ROLLUP, schemas.COUNTRY_ROLLUP)
    layouts.write_country_rollup(rollup, path, fmt=fmt)
    stored = layouts.read_country_rollup(spark, path, fmt=fmt)
    assert stored.schema == schemas.COUNTRY_ROLLUP
    found = [tuple(row) for row in stored.collect()]
    assert sorted(found, key=repr) == sorted(ROLLUP, key=repr)


def test_top_models_read_one_country(spark, tmp_path):
    path = str(tmp_path / "rollup")
    rollup = spark.createDataFrame(ROLLUP, schemas.COUNTRY_ROLLUP)
    layouts.write_country_rollup(rollup, path)
    aircrafts = spark.createDataFrame(
        [("N1", "MAKER", "M1"), ("N2", "MAKER", "M2")],
        "tailnum string, manufacturer string, model string",
    )
    stored = layouts.read_country_rollup(spark, path)
    found = top_models_from_rollup(stored, aircrafts, "Canada").collect()
    assert [tuple(row) for row in found] == [
        ("Alpha", "MAKER", "M1", 5, 1),
        ("Alpha", "MAKER", "M2", 2, 2),
    ]
    assert top_models_from_rollup(stored, aircrafts, "bob").collect() == []


def test_country_flights(spark, tmp_path):
    path = str(tmp_path / "flights")
    rows = [(1, "AA", "Alpha", "Canada"), (2, "BB", "Beta", None)]
    df = spark.createDataFrame(
        rows, "flight_id long, carrier_code string, name string, country string"
    )
    layouts.write_country_flights(df, path)
    stored = layouts.read_country_flights(spark, path)
    columns = ["flight_id", "carrier_code", "name", "country"]
    found = stored.select(columns).orderBy("flight_id").collect()
    assert [tuple(row) for row in found] == rows


def test_country_flights_sorted_by_tail(spark, tmp_path):
    path = str(tmp_path / "flights")
    df = spark.range(0, 2000, 1, 4).selectExpr(
        "id AS flight_id",
        "concat('N', lpad(string(id * 7919 % 2000), 4, '0')) AS tail_number",
        "IF(id % 2 = 0, 'Canada', 'Egypt') AS country",
    )
    layouts.write_country_flights(df, path, by_tail=True, max_records_per_file=100)
    stored = layouts.read_country_flights(spark, path)
    spans = stored.groupBy("country", F.input_file_name()).agg(
        F.min("tail_number").alias("low"), F.max("tail_number").alias("high")
    )
    ordered = spans.orderBy("country", "low").collect()
    assert len(ordered) == 20
    for before, after in zip(ordered, ordered[1:]):
        assert before.country < after.country or before.high < after.low


def test_row_cap_per_file(spark, tmp_path):
    path = str(tmp_path / "capped")
    df = spark.range(10).select(
        F.col("id").alias("flight_id"),
        F.lit("AA").alias("carrier_code"),
        F.lit(datetime.date(1996, 1, 1)).alias("flight_date"),
    )
    layouts.write_flights_by_year(df, path, max_records_per_file=3)
    stored = layouts.read_flights_by_year(spark, path, schema=FLIGHTS)
    per_file = stored.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) == 4
    assert max(row["count"] for row in per_file) == 3
    assert stored.count() == 10


@pytest.mark.parametrize("keys", [layouts.YEAR_CARRIER, layouts.YEAR_ONLY])
def test_a_hot_directory_is_written_by_several_tasks(spark, tmp_path, keys):
    """One year and carrier hold nearly all rows; adaptive execution splits them."""
    path = str(tmp_path / "hot")
    df = spark.range(0, 400_000, 1, 8).select(
        F.col("id").alias("flight_id"),
        F.when(F.col("id") % 100 == 0, "BB").otherwise("AA").alias("carrier_code"),
        F.lit(datetime.date(1996, 1, 1)).alias("flight_date"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        layouts.write_flights_by_year(df, path, keys=keys)
    finally:
        spark.conf.set(size, before)
    year = Path(path, "year=1996")
    hot_directory = year / "carrier_code=AA" if "carrier_code" in keys else year
    hot = list(hot_directory.glob("part-*"))
    assert len(hot) > 1
    stored = layouts.read_flights_by_year(spark, path, schema=FLIGHTS)
    assert stored.count() == 400_000


def tail_flights(spark, n=4000):
    """Even tail numbers of one country, a third of the flights on one of them."""
    tail = "if(id % 3 = 0, 'N0500', concat('N', lpad(string(2 * (id % 400)), 4, '0')))"
    return spark.range(n).selectExpr("id AS flight_id", f"{tail} AS tail_number", "'Chad' AS country")


def tails_by_file(spark, path):
    files = sorted(Path(path, "country=Chad").glob("part-*"))
    return [
        [r.tail_number for r in spark.read.parquet(str(f)).select("tail_number").collect()]
        for f in files
    ]


def test_country_tail_spreads_a_hot_tail_and_keeps_files_narrow(spark, tmp_path):
    path = str(tmp_path / "out")
    layouts.write_country_tail(tail_flights(spark), path, parts=8, max_records_per_file=400)
    files = tails_by_file(spark, path)
    assert len(files) > 8 and max(map(len, files)) <= 400
    assert sum("N0500" in f for f in files) >= 3
    # Every other tail is in one file, or two where a file ends within it.
    for tail in {t for f in files for t in f} - {"N0500"}:
        assert sum(tail in f for f in files) <= 2
    ranges = sorted((min(f), max(f)) for f in files)
    assert all(low[1] <= high[0] for low, high in zip(ranges, ranges[1:]))


def test_bloom_filters_skip_row_groups_of_other_tails(spark, tmp_path):
    path = str(tmp_path / "out")
    layouts.write_country_tail(tail_flights(spark), path, parts=4)
    files = [str(f) for f in Path(path, "country=Chad").glob("part-*")]

    def skipped(tail):
        return [
            row[-1]
            for f in files
            for row in duckdb.sql(f"FROM parquet_bloom_probe('{f}', 'tail_number', '{tail}')").fetchall()
        ]

    # No row group has an odd number, though every range of numbers holds some.
    assert len(skipped("N0301")) >= 4 and all(skipped("N0301"))
    assert not all(skipped("N0300"))
    schema = tail_flights(spark).schema
    stored = layouts.read_country_flights(spark, path, schema=schema)
    for tail, found in (("N0301", 0), ("N0300", 6)):
        rows = stored.filter(F.col("tail_number") == tail).select("tail_number")
        assert len(rows.collect()) in (found, found + 1)
        plan = rows._jdf.queryExecution().executedPlan()
        scan = next(iter(_scans(plan)))
        read = scan.metrics().apply("numOutputRows").value()
        assert read == 0 if found == 0 else 0 < read < 4000


def _scans(plan):
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return [leaves.apply(k) for k in range(leaves.size())]
