"""Folders whose files differ in the order or number of their columns."""

from __future__ import annotations

import datetime

import pytest

from skyledger.sources import mixed_headers, schemas

VALUES = {
    "flight_id": "{k}",
    "carrier_code": "007",
    "flight_number": "{k}",
    "flight_date": "1996-05-0{k}",
    "origin": "SYD",
    "destination": "MEL, main",
    "tail_number": "N{k}",
    "scheduled_depature_time": "09:0{k}:00",
    "scheduled_arrival_time": "10:00:00",
    "actual_departure_time": "09:1{k}:00",
    "actual_arrival_time": "",
    "distance": "43{k}",
    "gate": "7",
}
NAMES = [name for name in VALUES if name != "gate"]


def write(folder, name, names, *keys, first="", called=None):
    def line(values):
        return ",".join(f'"{v}"' if "," in v else v for v in values)

    lines = [first + line([(called or {}).get(n, n) for n in names])]
    lines += [line([VALUES[n].format(k=k) for n in names]) for k in keys]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_orders_a_missing_column_and_odd_names(spark, tmp_path):
    write(tmp_path, "a.csv", NAMES, 1, 2)
    write(tmp_path, "b [1] {x} ü *.csv", NAMES[::-1], 3)
    write(tmp_path, "c d.csv", NAMES[4:] + NAMES[:4], 4)
    short = [n for n in NAMES if n not in ("distance", "origin")]
    write(tmp_path, "d.csv", short, 5, first="﻿",
          called={"scheduled_depature_time": "scheduled_departure_time", "flight_id": " flight_id "})
    write(tmp_path, "e.csv", NAMES, 6)
    (tmp_path / "empty.csv").write_text("")
    write(tmp_path, "header only.csv", NAMES)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    flights = mixed_headers.read_flights_by_header(spark, str(tmp_path))
    assert flights.schema == schemas.FLIGHTS
    rows = {r.flight_id: r for r in flights.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    for k, row in rows.items():
        assert row.flight_date == datetime.date(1996, 5, k)
        assert (row.carrier_code, row.tail_number) == ("007", f"N{k}")
        assert (row.scheduled_departure_time, row.actual_departure_time) == (f"09:0{k}:00", f"09:1{k}:00")
        assert row.destination == "MEL, main"
        assert row.distance == (None if k == 5 else 430 + k)
        assert row.origin == (None if k == 5 else "SYD")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


@pytest.mark.parametrize(
    ("names", "fault"),
    [
        ([*NAMES, "gate"], "unknown column 'gate'"),
        ([*NAMES, "distance"], "column 'distance' more than once"),
        ([n for n in NAMES if n != "tail_number"], "no column 'tail_number'"),
    ],
)
def test_headers_that_are_refused(spark, tmp_path, names, fault):
    write(tmp_path, "a.csv", NAMES, 1)
    write(tmp_path, "b.csv", names, 2)
    with pytest.raises(ValueError, match=fault):
        mixed_headers.read_flights_by_header(spark, str(tmp_path))


def test_headers_come_from_one_task_for_each_file(spark, tmp_path):
    for k in range(9):
        write(tmp_path, f"{k}.csv", NAMES, *range(1, 9))
    headers = mixed_headers.file_headers(spark, str(tmp_path))
    assert headers.count() == 9
    assert {r["header"] for r in headers.collect()} == {",".join(NAMES)}


def test_a_folder_without_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    flights = mixed_headers.read_flights_by_header(spark, str(tmp_path))
    assert flights.schema == schemas.FLIGHTS and flights.count() == 0
