"""Flights and aircraft bucketed by tail: no shuffle of either, hot tails in slices."""

from __future__ import annotations

import random
import re
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import types as T

from skyledger.plans.fleet import top_models_colocated, top_models_per_airline
from skyledger.sources import colocated, schemas

LEGS = T.StructType(
    [
        T.StructField("flight_id", T.LongType()),
        T.StructField("carrier_code", T.StringType()),
        T.StructField("tail_number", T.StringType()),
        T.StructField("actual_departure_time", T.StringType()),
    ]
)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(3)
    # A third of all flights is one tail's; some have none, some were cancelled.
    tails = ["N0"] * 100 + [f"N{k}" for k in range(1, 180)] + [None] * 21
    rows = [
        (k, rng.choice(["AA", "BB", "CC"]), rng.choice(tails), rng.choice(["12:00:00"] * 5 + [None]))
        for k in range(3000)
    ]
    planes = [(f"N{k}", rng.choice(["X", "Y", None]), rng.choice("abcde")) for k in range(170)]
    planes += [("N1", "Z", "twice"), ("N0", "Z", "twice"), (None, "Z", "none")]
    blank = [None] * 4
    aircrafts = [(t, None, m, None, model, *blank) for t, m, model in planes]
    airlines = [("AA", "Alpha", "Canada"), ("BB", "Beta", "Canada"), ("CC", "Gamma", "Egypt")]
    airlines += [("BB", "Beta", "Canada")]
    return (
        spark.createDataFrame(rows, LEGS),
        spark.createDataFrame(airlines, schemas.AIRLINES),
        spark.createDataFrame(aircrafts, schemas.AIRCRAFTS),
    )


@pytest.fixture
def stored(spark, tables, tmp_path):
    names = {f"{kind}_table": f"t_{uuid4().hex}" for kind in ("flights", "aircrafts")}
    flights, _, aircrafts = tables
    colocated.write_colocated(flights, aircrafts, str(tmp_path / "t"), buckets=8, **names)
    yield (*colocated.read_colocated(spark, **names), tmp_path / "t")
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("ties", ["keep", "exact"])
def test_rows_are_those_of_the_plain_job(tables, stored, ties, join_path):
    flights, airlines, aircrafts = tables
    plain = top_models_per_airline(flights, airlines, aircrafts, "Canada", ties=ties)
    found = top_models_colocated(stored[0], airlines, stored[1], "Canada", ties=ties)
    assert found.collect() == plain.collect() and len(plain.collect()) > 5


def nodes(plan, into_broadcasts):
    """The nodes of a plan as it ran."""
    yield plan
    if plan.nodeName() == "BroadcastExchange" and not into_broadcasts:
        return
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from nodes(plan.executedPlan(), into_broadcasts)
    elif plan.nodeName().endswith("QueryStage"):
        yield from nodes(plan.plan(), into_broadcasts)
    for k in range(plan.children().size()):
        yield from nodes(plan.children().apply(k), into_broadcasts)


def test_neither_side_of_the_join_is_shuffled(tables, stored, join_path):
    found = top_models_colocated(stored[0], tables[1], stored[1], "Canada")
    found.collect()
    whole = list(nodes(found._jdf.queryExecution().executedPlan(), True))
    [join] = [
        node for node in whole
        if node.nodeName() == "SortMergeJoin" and "tail_number" in node.simpleString(100)
    ]
    below = list(nodes(join, False))
    scans = [node.simpleString(1000) for node in below if "Scan parquet" in node.nodeName()]
    assert sum("Bucketed: true" in scan for scan in scans) == 2
    assert "Exchange" not in {node.nodeName() for node in below}


def test_a_hot_tail_is_in_several_buckets(tables, stored):
    flights, aircrafts, path = stored
    assert flights.count() == 3000
    buckets = re.compile(r"_(\d{5})\.c000")
    files = list(Path(path, "flights").glob("part-*"))
    held = {}
    for file in files:
        rows = flights.sparkSession.read.parquet(str(file)).filter("tail_number = 'N0'").count()
        if rows:
            held[buckets.search(file.name)[1]] = rows
    assert len(held) >= 3 and sum(held.values()) > 900
    # Its aircraft, of which there are two rows, stand in every slice.
    slices = flights.filter("tail_number = 'N0'").select(colocated.SLICE).distinct().count()
    assert aircrafts.filter("tailnum = 'N0'").count() == 2 * slices
    assert aircrafts.filter("tailnum = 'N5'").count() == 1


def test_empty_tables(spark, tables, tmp_path):
    flights, airlines, aircrafts = tables
    names = {f"{kind}_table": f"t_{uuid4().hex}" for kind in ("flights", "aircrafts")}
    colocated.write_colocated(
        flights.limit(0), aircrafts.limit(0), str(tmp_path / "e"), buckets=4, **names
    )
    found = top_models_colocated(
        spark.table(names["flights_table"]), airlines, spark.table(names["aircrafts_table"]), "Canada"
    )
    assert found.collect() == []
