"""Loads that set malformed lines aside: reasons, files, one scan."""

from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from pyspark.sql import types as T

from skyledger.session import scratch_path
from skyledger.sources import quarantine, schemas

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("miles", T.IntegerType()),
    ]
)
GOOD = ["1,Alpha,1996-05-01,10", '2,"Beta, Gamma",,', '3,"say \\"hi\\"",1996-05-02,7', ",,,", '4,5" disc,,1']
BAD = {
    "5,cut": "fields missing",
    "6": "fields missing",
    "7,long,1996-05-01,1,2": "fields surplus",
    '8,"a, b",1996-05-01,1,"c, d"': "fields surplus",
    '9,"open,1996-05-01,1': "open quote",
    "10,x,1996-02-30,1": "value of day",
    "ten,x,yesterday,1.5": "value of id, day, miles",
    "11,x,1996-05-01,99999999999": "value of miles",
}


def write(folder, name, lines, header="id,name,day,miles"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in [header, *lines] if line is not None))
    return str(folder)


def test_every_line_is_accepted_or_rejected_with_its_reason(spark, tmp_path):
    path = write(tmp_path / "in", "a b ü.csv", [GOOD[0], "", *BAD, *GOOD[1:]])
    load = quarantine.load_csv(spark, path, str(tmp_path / "out"), SCHEMA)
    rows = {(r.id, r.name, r.day, r.miles) for r in load.accepted.collect()}
    assert load.accepted.schema == SCHEMA
    assert rows == {
        (1, "Alpha", datetime.date(1996, 5, 1), 10),
        (2, "Beta, Gamma", None, None),
        (3, 'say "hi"', datetime.date(1996, 5, 2), 7),
        (None, None, None, None),
        (4, '5" disc', None, 1),
    }
    rejected = load.rejected.collect()
    assert {r[quarantine.LINE]: r[quarantine.REASON] for r in rejected} == BAD
    assert len(rejected) == len(BAD)
    assert {Path(r[quarantine.FILE]).name for r in rejected} == {"a b ü.csv"}
    counts = {r.reason: r.n for r in quarantine.rejects_by_reason(load).collect()}
    assert counts == {
        "accepted": 5, "fields missing": 2, "fields surplus": 2, "open quote": 1,
        "value of day": 1, "value of id, day, miles": 1, "value of miles": 1,
    }


def test_rejects_name_their_files(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", [GOOD[0], "5,cut"])
    write(tmp_path / "in", "b.csv", ["6"])
    load = quarantine.load_csv(spark, path, str(tmp_path / "out"), SCHEMA)
    files = {r[quarantine.LINE]: Path(r[quarantine.FILE]).name for r in load.rejected.collect()}
    assert files == {"5,cut": "a.csv", "6": "b.csv"}


def test_no_rejects_no_rows_no_header(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", GOOD, header=None)
    load = quarantine.load_csv(spark, path, str(tmp_path / "one"), SCHEMA, header=False)
    assert (load.accepted.count(), load.rejected.count()) == (5, 0)
    path = write(tmp_path / "none", "a.csv", [])
    load = quarantine.load_csv(spark, path, str(tmp_path / "two"), SCHEMA)
    assert (load.accepted.count(), load.rejected.count()) == (0, 0)


def test_a_header_must_agree_with_the_schema(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", GOOD, header="id,day,name,miles")
    with pytest.raises(Exception, match="header does not conform"):
        quarantine.load_csv(spark, path, str(tmp_path / "out"), SCHEMA)


def test_one_scan_without_a_shuffle(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", [*GOOD, *BAD])
    judged = quarantine.read_judged(spark, path, SCHEMA)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 1 and "Exchange" not in plan
    load = quarantine.load_csv(spark, path, scratch_path(spark, "load"), SCHEMA)
    plan = load.accepted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan


def test_flights_schema(spark, tmp_path):
    header = ",".join(schemas.FLIGHTS_FILE.names)
    lines = ["1,AA,1,1994-05-01,SYD,MEL,N1,09:00:00,10:30:00,24:00:00,,439", "2,AA,1"]
    path = write(tmp_path / "in", "f.csv", lines, header=header)
    load = quarantine.load_csv(spark, path, str(tmp_path / "out"), schemas.FLIGHTS_FILE)
    assert [r.flight_id for r in load.accepted.collect()] == [1]
    assert [r[quarantine.REASON] for r in load.rejected.collect()] == ["fields missing"]
