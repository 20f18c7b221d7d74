from __future__ import annotations

import datetime

import pytest

from skyledger.session import scratch_path
from skyledger.sources import schemas
from skyledger.sources.tables import (
    read_aircrafts,
    read_airlines,
    read_airports,
    read_csv,
    read_flights,
    read_table,
    write_csv,
)

FLIGHTS_HEADER = ",".join(schemas.FLIGHTS_FILE.names)
AIRCRAFTS_HEADER = ",".join(schemas.AIRCRAFTS.names)


def write_text(tmp_path, *lines):
    path = tmp_path / "table.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_flights_are_typed_and_the_misspelt_column_renamed(spark, tmp_path):
    path = write_text(
        tmp_path,
        FLIGHTS_HEADER,
        "8234160,AA,1,1994-05-01,SYD,MEL,N201AA,09:00:00,10:30:00,24:00:00,,439",
        "8234161,AA,2,1994-05-02,SYD,MEL,,09:00:00,10:30:00,,,439",
    )
    flights = read_flights(spark, path)
    assert flights.schema == schemas.FLIGHTS
    first, second = flights.orderBy("flight_id").collect()
    assert first.flight_id == 8234160
    assert first.flight_date == datetime.date(1994, 5, 1)
    assert first.scheduled_departure_time == "09:00:00"
    assert first.actual_departure_time == "24:00:00"
    assert first.actual_arrival_time is None
    assert second.tail_number is None
    assert second.actual_departure_time is None


def test_header_must_agree_with_the_schema(spark, tmp_path):
    path = write_text(tmp_path, "carrier_code,country,name", "AA,Canada,Alpha")
    with pytest.raises(Exception, match="header does not conform"):
        read_airlines(spark, path).collect()


def test_no_header(spark, tmp_path):
    path = write_text(tmp_path, "007,Bond Air,Canada", "4D,,Egypt")
    found = read_airlines(spark, path, header=False).orderBy("carrier_code").collect()
    assert [tuple(row) for row in found] == [
        ("007", "Bond Air", "Canada"),
        ("4D", None, "Egypt"),
    ]


def test_airport_codes(spark, tmp_path):
    path = write_text(tmp_path, "airport_code,city", "SYD,Sydney", "MEL,Melbourne")
    codes = read_airports(spark, path).collect()
    assert [tuple(row) for row in codes] == [("SYD",), ("MEL",)]


def ragged(tmp_path):
    whole = "N1,Corporation,CESSNA,01/01/1990,172M,Valid,Fixed,Reciprocating,1976"
    return write_text(
        tmp_path,
        AIRCRAFTS_HEADER,
        whole,
        "N2",
        "N3,Corporation,CESSNA",
        whole + ",surplus",
        "N4,,,,,,,,",
    )


def test_ragged_rows_are_dropped_however_few_columns_are_read(spark, tmp_path):
    aircrafts = read_aircrafts(spark, ragged(tmp_path), drop_malformed=True)
    assert aircrafts.count() == 2
    tails = aircrafts.select("tailnum").collect()
    assert sorted(row.tailnum for row in tails) == ["N1", "N4"]
    models = aircrafts.filter("model IS NOT NULL").select("model").collect()
    assert [row.model for row in models] == ["172M"]


def test_permissive_read_pads_ragged_rows(spark, tmp_path):
    aircrafts = read_aircrafts(spark, ragged(tmp_path))
    assert len(aircrafts.collect()) == 5


def test_quotes_and_commas_survive_a_round_trip(spark, tmp_path):
    rows = [("A,B", 'The "Best"', None), ("C", "new name", "Korea, South")]
    airlines = spark.createDataFrame(rows, schemas.AIRLINES)
    path = str(tmp_path / "airlines")
    write_csv(airlines, path)
    found = read_csv(spark, path, schemas.AIRLINES).collect()
    assert sorted(tuple(r) for r in found) == sorted(rows)


def test_parquet_tables(spark, tmp_path):
    path = str(tmp_path / "airlines.parquet")
    spark.createDataFrame([("AA", "Alpha", "Canada")], schemas.AIRLINES).write.parquet(
        path
    )
    assert read_airlines(spark, path, fmt="parquet").count() == 1
    with pytest.raises(ValueError, match="format"):
        read_table(spark, path, schemas.AIRLINES, fmt="orc")


def test_parquet_flights_under_either_name(spark, tmp_path):
    row = [("AA", datetime.date(1996, 6, 1), "N1", "10:00:00", "10:10:00")]
    for name in (schemas.MISSPELT_SCHEDULED, schemas.SCHEDULED):
        columns = f"carrier_code string, flight_date date, tail_number string, {name} string"
        path = str(tmp_path / name)
        spark.createDataFrame(row, f"{columns}, actual_departure_time string").write.parquet(path)
        found = read_flights(spark, path, fmt="parquet").first()
        assert found[schemas.SCHEDULED] == "10:00:00" and found["flight_id"] is None
    path = str(tmp_path / "short")
    spark.createDataFrame([("AA",)], "carrier_code string").write.parquet(path)
    with pytest.raises(ValueError, match="lacks actual_departure_time, flight_date"):
        read_flights(spark, path, fmt="parquet")


def test_scratch_paths_are_new_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    assert first.startswith(f"{shared}/skyledger-{spark.sparkContext.applicationId}/x-")


class Settings:
    """A session with other settings than the one that runs the tests."""

    def __init__(self, spark, **conf):
        self.sparkContext = spark.sparkContext
        self.conf = conf


def test_scratch_without_a_shared_folder(spark):
    cluster = Settings(spark, **{"spark.master": "yarn"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(cluster, "x")
    warehouse = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/tmp/w/"}
    assert scratch_path(Settings(spark, **warehouse), "x").startswith("file:/tmp/w/sky")
