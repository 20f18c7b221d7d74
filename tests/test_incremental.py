"""Layouts and rollups kept up to date by deliveries and deltas."""

from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.plans.fleet import flights_per_tail, rollup_delta
from skyledger.sources import files, incremental, layouts, schemas

FLIGHTS = T.StructType(
    [
        T.StructField("flight_id", T.LongType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField("tail_number", T.StringType()),
    ]
)


def day(text):
    return datetime.date.fromisoformat(text) if text else None


def flights(spark, *rows):
    return spark.createDataFrame([(i, c, day(d), t) for i, c, d, t in rows], FLIGHTS)


def load(df, root, **settings):
    return incremental.load_days(df, root, schema=FLIGHTS, **settings)


def held(spark, root):
    stored = layouts.read_flights_by_year(spark, root, schema=FLIGHTS)
    return sorted(
        (tuple(r) for r in stored.select(*FLIGHTS.names, "year").collect()), key=repr
    )


def expected(*rows):
    out = [(i, c or None, day(d), t, day(d).year if d else None) for i, c, d, t in rows]
    return sorted(out, key=repr)


def parts(root):
    return {
        str(p.relative_to(root))
        for p in Path(root).rglob("part-*")
        if not str(p.relative_to(root)).startswith("_")
    }


A = (1, "AA", "1995-05-01", "N1")
B = (2, "4D", "1995-05-02", "N2")
C = (3, "AA", "1996-05-01", "N3")
D = (4, "A/B: 7%", "1996-05-02", None)
E = (5, "", None, "N5")


def test_loads_in_parts_equal_one_load(spark, tmp_path):
    root = str(tmp_path / "table")
    assert load(flights(spark, A, D), root)
    assert load(flights(spark, C), root)
    assert load(flights(spark, B, E), root)
    assert held(spark, root) == expected(A, B, C, D, E)
    # As directories, empty and unknown carriers are one.
    assert {p.rpartition("/")[0] for p in parts(root)} == {
        "year=1995/carrier_code=AA",
        "year=1995/carrier_code=4D",
        "year=1996/carrier_code=AA",
        "year=1996/carrier_code=A%2FB%3A 7%25",
        "year=__HIVE_DEFAULT_PARTITION__/carrier_code=__HIVE_DEFAULT_PARTITION__",
    }


def test_only_the_directories_of_changed_days_are_written(spark, tmp_path):
    root = str(tmp_path / "table")
    load(flights(spark, A, B, C, D, E), root)
    before = parts(root)
    moved = (1, "BB", "1995-05-01", "N9")
    assert load(flights(spark, moved), root)
    assert held(spark, root) == expected(moved, B, C, D, E)
    # The day's only flight of AA in 1995 went to another carrier, and so its directory.
    gone = {p for p in before if "year=1995/carrier_code=AA" in p}
    assert before - gone <= parts(root)
    assert not (Path(root) / "year=1995/carrier_code=AA").exists()
    assert {p.split("/")[1] for p in parts(root) - before} == {"carrier_code=BB"}


def test_a_rerun_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    load(flights(spark, A, B, C), root)
    before = parts(root)
    assert not load(flights(spark, C, A, B), root)
    assert not load(flights(spark, B), root)
    assert parts(root) == before
    assert incremental._versions(spark, root) == [1]
    assert not (Path(root) / incremental.STAGING).exists()
    assert not load(flights(spark), root)


def test_a_changed_row_of_a_day_is_noticed(spark, tmp_path):
    root = str(tmp_path / "table")
    load(flights(spark, A, B), root)
    changed = (*B[:3], "N22")
    assert load(flights(spark, changed), root)
    assert held(spark, root) == expected(A, changed)


def test_years_alone_and_repeated_rows(spark, tmp_path):
    root = str(tmp_path / "table")
    load(flights(spark, A, A, B, C), root, keys=layouts.YEAR_ONLY)
    before = parts(root)
    assert load(flights(spark, A), root, keys=layouts.YEAR_ONLY)
    assert held(spark, root) == expected(A, B, C)
    assert {p for p in before if "1996" in p} <= parts(root)


@pytest.mark.parametrize("broken", ["move", "remove"])
def test_a_load_lost_while_publishing_is_finished_by_the_next(
    spark, tmp_path, monkeypatch, broken
):
    root = str(tmp_path / "table")
    load(flights(spark, A, B), root)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        if broken == "move":
            patch.setattr(files, "move", lost)
        else:
            # Lost when the first emptied directory should go.
            started = [False]
            remove = files.remove

            def once(spark, path):
                if "carrier_code" in path:
                    lost()
                remove(spark, path)

            patch.setattr(files, "remove", once)
        load(flights(spark, (1, "BB", "1995-05-01", "N9")), root)
    load(flights(spark, C), root)
    assert held(spark, root) == expected((1, "BB", "1995-05-01", "N9"), B, C)
    assert incremental._versions(spark, root) == [1, 2, 3]


@pytest.mark.parametrize("keys", [layouts.YEAR_CARRIER, layouts.YEAR_ONLY])
def test_publishing_moves_the_staged_files(spark, tmp_path, monkeypatch, keys):
    root = str(tmp_path / "table")
    load(flights(spark, A, B), root, keys=keys)
    written = []
    write = layouts.write_partitioned

    def noted(df, path, *args, **settings):
        written.append(path)
        write(df, path, *args, **settings)

    monkeypatch.setattr(layouts, "write_partitioned", noted)
    changed = (1, "AA", "1995-05-01", "N9")
    load(flights(spark, changed, C), root, keys=keys)
    assert held(spark, root) == expected(changed, B, C)
    assert written == [f"{root}/{incremental.STAGING}/rows"]


def test_a_load_lost_between_two_directories_is_finished(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    load(flights(spark, A, B, C), root)
    moves = []
    move = files.move

    def second_lost(spark, path, to):
        moves.append(path)
        if len(moves) == 2:
            raise OSError("lost")
        move(spark, path, to)

    changed = [(*r[:3], "N9") for r in (A, B, C)]
    with monkeypatch.context() as patch, pytest.raises(OSError, match="lost"):
        patch.setattr(files, "move", second_lost)
        load(flights(spark, *changed), root)
    assert not load(flights(spark, *changed), root)
    assert held(spark, root) == expected(*changed)


def test_loads_have_many_partitions_that_the_session_does_not_keep(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(
        incremental, "finish", lambda spark, *_: seen.append(spark.conf.get(incremental.PARTITIONS_CONF))
    )
    load(flights(spark, A), str(tmp_path / "table"))
    assert int(seen[0]) >= incremental.PARTITIONS
    assert spark.conf.get(incremental.PARTITIONS_CONF, None) is None


def test_a_load_lost_while_staging_is_forgotten(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    load(flights(spark, A), root)
    (Path(root) / incremental.STAGING / "rows/year=1995").mkdir(parents=True)
    assert load(flights(spark, C), root)
    assert held(spark, root) == expected(A, C)


# Counts per tail

LEGS = T.StructType(
    [
        T.StructField("carrier_code", T.StringType()),
        T.StructField("tail_number", T.StringType()),
        T.StructField("actual_departure_time", T.StringType()),
    ]
)
AIRLINES = [("AA", "Alpha", "Canada"), ("BB", "Beta", "Egypt"), ("CC", "Gamma", None)]
NOON = "12:00:00"


def legs(spark, *rows):
    return spark.createDataFrame(rows, LEGS)


def airlines(spark):
    return spark.createDataFrame(AIRLINES, schemas.AIRLINES)


def rollup(spark, root):
    rows = layouts.read_country_rollup(spark, root).collect()
    return {(r.name, r.carrier_code, r.tail_number, r.country): r["count"] for r in rows}


def test_two_deltas_equal_a_rebuild(spark, tmp_path):
    root = str(tmp_path / "rollup")
    first = [("AA", "N1", NOON)] * 3 + [("BB", "N2", NOON), ("CC", None, NOON)]
    second = [("AA", "N1", NOON), ("AA", "N4", NOON), ("AA", "N5", None)]
    gone = [("AA", "N1", NOON)] * 2 + [("CC", None, None)]
    lines = airlines(spark)
    assert incremental.apply_delta(rollup_delta(lines, flown=legs(spark, *first)), root, "1")
    before = parts(root)
    delta = rollup_delta(lines, flown=legs(spark, *second), cancelled=legs(spark, *gone))
    assert incremental.apply_delta(delta, root, "2")
    left = [("AA", "N1", NOON)] * 2 + [("AA", "N4", NOON), ("BB", "N2", NOON)]
    rebuilt = flights_per_tail(legs(spark, *left), lines)
    assert rollup(spark, root) == {
        (r.name, r.carrier_code, r.tail_number, r.country): r["count"]
        for r in rebuilt.collect()
    }
    # Egypt was not written again, and the country that lost its last row is gone.
    assert {p for p in before if "Egypt" in p} <= parts(root)
    assert {p.split("/")[0] for p in parts(root)} == {"country=Canada", "country=Egypt"}
    after = parts(root)
    assert not incremental.apply_delta(delta, root, "2")
    assert parts(root) == after


def test_a_delta_of_one_country_reads_that_country(spark, tmp_path):
    root = str(tmp_path / "rollup")
    lines = airlines(spark)
    flown = legs(spark, ("AA", "N1", NOON), ("BB", "N2", NOON))
    incremental.apply_delta(rollup_delta(lines, flown=flown), root, "1")
    # Were it read, this would be an error.
    for path in (Path(root) / "country=Egypt").glob("part-*"):
        path.write_bytes(b"no longer a Parquet file")
    assert incremental.apply_delta(
        rollup_delta(lines, flown=legs(spark, ("AA", "N1", NOON))), root, "2"
    )
    canada = layouts.read_country_rollup(spark, root).filter(F.col("country") == "Canada")
    assert [r["count"] for r in canada.collect()] == [2]


def test_counts_below_zero_are_refused(spark, tmp_path):
    root = str(tmp_path / "rollup")
    lines = airlines(spark)
    incremental.apply_delta(rollup_delta(lines, flown=legs(spark, ("AA", "N1", NOON))), root, "1")
    before, files_before = rollup(spark, root), parts(root)
    delta = rollup_delta(lines, cancelled=legs(spark, ("AA", "N1", NOON), ("AA", "N1", NOON)))
    with pytest.raises(Exception, match="fewer flights than none"):
        incremental.apply_delta(delta, root, "2")
    assert (rollup(spark, root), parts(root)) == (before, files_before)
    assert incremental.apply_delta(
        rollup_delta(lines, cancelled=legs(spark, ("AA", "N1", NOON))), root, "2"
    )
    assert rollup(spark, root) == {}
    with pytest.raises(ValueError, match="flown or cancelled"):
        rollup_delta(lines)
