from __future__ import annotations

import pytest

from skyledger.operators.bloom import possibly_in
from skyledger.plans.top_models import model_counts, top_models

AIRCRAFTS = "tailnum string, manufacturer string, model string"
FLIGHTS = "tail_number string, actual_departure_time string"


@pytest.fixture
def aircrafts(spark):
    return spark.createDataFrame(
        [
            ("N1", "CESSNA", "172M"),
            ("N2", "CESSNA", "172N"),
            ("N3", "CESSNA", "550"),
            ("N4", "CESSNA", "210A"),  # never flown
            ("N5", "CESSNA", "SKYLANE"),  # no code
            ("N6", "CESSNA", None),
            ("N7", "BOEING", "737"),
            ("N8", "CESSNA", "680"),  # listed twice
            ("N8", "CESSNA", "680"),
        ],
        AIRCRAFTS,
    )


@pytest.fixture
def flights(spark):
    legs = [("N1", 2, 0), ("N2", 1, 0), ("N3", 1, 4), ("N5", 1, 0), ("N6", 2, 0)]
    legs += [("N7", 9, 0), ("N8", 2, 0), (None, 5, 0)]
    rows = []
    for tail, flown, cancelled in legs:
        rows += [(tail, "10:00:00")] * flown + [(tail, None)] * cancelled
    return spark.createDataFrame(rows, FLIGHTS)


def pairs(df):
    return [(row.modelName, row.numFlights) for row in df.collect()]


def test_counts_keep_never_flown_and_uncoded_models(flights, aircrafts, join_path):
    assert pairs(model_counts(flights, aircrafts)) == [
        ("550", 5),
        ("680", 4),
        ("172", 3),
        (None, 2),
        ("", 1),
        ("210", None),
    ]


def test_flown_only_drops_cancelled_and_never_flown(flights, aircrafts, join_path):
    assert pairs(model_counts(flights, aircrafts, flown_only=True)) == [
        ("680", 4),
        ("172", 3),
        (None, 2),
        ("", 1),
        ("550", 1),
    ]


def test_top_models_have_a_code(flights, aircrafts, join_path):
    assert pairs(top_models(flights, aircrafts)) == [("550", 5), ("680", 4), ("172", 3)]
    assert pairs(top_models(flights, aircrafts, flown_only=True)) == [
        ("680", 4),
        ("172", 3),
        ("550", 1),
    ]


def test_fewer_models_than_asked_for(spark, flights, join_path):
    one = spark.createDataFrame([("N1", "CESSNA", "172M")], AIRCRAFTS)
    assert pairs(top_models(flights, one)) == [("172", 2)]
    none = spark.createDataFrame([], AIRCRAFTS)
    assert pairs(top_models(flights, none)) == []


def test_flights_of_other_manufacturers_are_dropped_before_the_shuffle(spark, join_path):
    planes = [(f"N{k}", "CESSNA" if k % 50 == 0 else "X", "172") for k in range(1000)]
    aircrafts = spark.createDataFrame(planes, AIRCRAFTS)
    flights = spark.range(20_000).selectExpr(
        "if(id % 9 = 0, NULL, concat('N', id % 1500)) AS tail_number",
        "'12:00:00' AS actual_departure_time",
    )
    counts = model_counts(flights, aircrafts)
    expected = sum(1 for k in range(20_000) if k % 9 and k % 1500 < 1000 and k % 1500 % 50 == 0)
    assert [tuple(r) for r in counts.collect()] == [("172", expected)]
    if join_path == "shuffle":
        plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        semi = plan.index("LeftSemi")
        # Above it stand the partial counts and their shuffle.
        assert "HashAggregate(keys=[tail_number" in plan[:semi]


def test_bloom_filter_keeps_every_partner(spark):
    keys = spark.range(0, 60_000, 3).selectExpr("concat('N', id) AS k")
    rows = spark.range(60_000).selectExpr("id", "if(id % 7 = 0, NULL, concat('N', id)) AS tail")
    left = {r.id for r in possibly_in(rows, "tail", keys, "k").collect()}
    partners = {k for k in range(0, 60_000, 3) if k % 7}
    assert partners <= left and len(left - partners) < 400
    assert possibly_in(rows, "tail", keys.limit(0), "k").count() == 0
