from __future__ import annotations

from collections import Counter

import pytest

from skyledger.plans.exploration import (
    country_model_counts,
    country_tail_counts,
    fleet_right_outer,
    fleet_usage,
    fleet_with_unknown,
    join_coverage,
    models_per_airline,
)
from skyledger.plans.fleet import (
    flights_per_model,
    flights_per_tail,
    flights_with_airline,
    least_flown_models,
    rank_models,
    top_models_per_airline,
)

COUNTRY = "Canada"


@pytest.fixture
def airlines(spark):
    return spark.createDataFrame(
        [
            ("AA", "Alpha", COUNTRY),
            ("BB", "Beta", COUNTRY),
            ("B2", "Beta", COUNTRY),  # two codes, one name
            ("DD", "Delta", COUNTRY),  # listed twice
            ("DD", "Delta", COUNTRY),
            ("UU", "Umbra", "United States"),
            ("NN", "Nowhere", None),
        ],
        "carrier_code string, name string, country string",
    )


@pytest.fixture
def aircrafts(spark):
    rows = [(f"N{i}", "MAKER", f"M{i}") for i in range(1, 9)]
    rows += [("N9", None, "M9"), ("N10", "MAKER", None), ("N11", "OTHER", "M1")]
    return spark.createDataFrame(
        rows, "tailnum string, manufacturer string, model string"
    )


LEGS = [
    # Alpha: a tie at rank 5 between M5, M6 and M7; M8 below it.
    ("AA", "N1", 9),
    ("AA", "N2", 8),
    ("AA", "N3", 7),
    ("AA", "N4", 6),
    ("AA", "N5", 3),
    ("AA", "N6", 3),
    ("AA", "N7", 3),
    ("AA", "N8", 1),
    ("AA", "N9", 20),
    ("AA", "N10", 20),
    ("AA", "NX", 20),
    ("AA", None, 20),
    ("BB", "N1", 2),
    ("B2", "N1", 3),
    ("B2", "N11", 5),
    ("DD", "N2", 2),
    ("UU", "N1", 50),
    ("NN", "N1", 4),
]


@pytest.fixture
def flights(spark):
    rows = []
    for carrier, tail, n in LEGS:
        rows += [(carrier, tail, "10:00:00")] * n
    rows += [("AA", "N8", None)] * 30  # cancelled
    return spark.createDataFrame(
        rows, "carrier_code string, tail_number string, actual_departure_time string"
    )


def tuples(df):
    return [tuple(row) for row in df.collect()]


def test_ties_at_the_last_rank_are_kept(flights, airlines, aircrafts, join_path):
    ranked = top_models_per_airline(flights, airlines, aircrafts, COUNTRY)
    assert tuples(ranked) == [
        ("Alpha", "MAKER", "M1", 9, 1),
        ("Alpha", "MAKER", "M2", 8, 2),
        ("Alpha", "MAKER", "M3", 7, 3),
        ("Alpha", "MAKER", "M4", 6, 4),
        ("Alpha", "MAKER", "M5", 3, 5),
        ("Alpha", "MAKER", "M6", 3, 5),
        ("Alpha", "MAKER", "M7", 3, 5),
        ("Beta", "MAKER", "M1", 5, 1),
        ("Beta", "OTHER", "M1", 5, 1),
        ("Delta", "MAKER", "M2", 4, 1),
    ]


def test_exact_takes_five_in_total_order(flights, airlines, aircrafts, join_path):
    ranked = top_models_per_airline(flights, airlines, aircrafts, COUNTRY, ties="exact")
    found = tuples(ranked)
    assert [row[2] for row in found if row[0] == "Alpha"] == [
        "M1",
        "M2",
        "M3",
        "M4",
        "M5",
    ]
    assert [row[4] for row in found if row[0] == "Beta"] == [1, 2]


def test_least_flown_keeps_ties(flights, airlines, aircrafts, join_path):
    found = tuples(least_flown_models(flights, airlines, aircrafts, COUNTRY))
    assert [row[2:] for row in found if row[0] == "Alpha"] == [
        ("M8", 1, 1),
        ("M5", 3, 2),
        ("M6", 3, 2),
        ("M7", 3, 2),
        ("M4", 6, 5),
    ]


def test_unknown_ties_are_refused(spark):
    empty = spark.createDataFrame(
        [], "name string, manufacturer string, model string, numFlights long"
    )
    with pytest.raises(ValueError, match="ties"):
        rank_models(empty, ties="some")


def test_country_without_airlines_gives_no_rows(flights, airlines, aircrafts, join_path):
    assert tuples(top_models_per_airline(flights, airlines, aircrafts, "bob")) == []


def test_per_tail_counts_multiply_duplicate_airlines(flights, airlines, join_path):
    found = Counter(tuples(flights_per_tail(flights, airlines)))
    expected = Counter()
    country = {"UU": "United States", "NN": None}
    name = {"AA": "Alpha", "BB": "Beta", "B2": "Beta", "DD": "Delta"}
    name |= {"UU": "Umbra", "NN": "Nowhere"}
    for carrier, tail, n in LEGS:
        copies = 2 if carrier == "DD" else 1
        row = (name[carrier], carrier, tail, country.get(carrier, COUNTRY), n * copies)
        expected[row] += 1
    assert found == expected


def test_flights_with_airline(flights, airlines, join_path):
    joined = flights_with_airline(flights, airlines)
    assert joined.columns.count("carrier_code") == 1
    total = sum(n for _, _, n in LEGS) + 2  # DD is listed twice
    assert joined.count() == total


def test_models_per_airline(flights, airlines, aircrafts, join_path):
    found = dict(tuples(models_per_airline(flights, airlines, aircrafts, COUNTRY)))
    assert found == {"Alpha": 8, "Beta": 2, "Delta": 1}


def test_country_counts_include_cancelled_flights(
    flights, airlines, aircrafts, join_path
):
    by_model = dict(
        tuples(country_model_counts(flights, airlines, aircrafts, COUNTRY))
    )
    assert by_model["M8"] == 31
    assert by_model["M1"] == 9 + 5 + 5
    assert by_model[None] == 20
    by_tail = {
        row[1:3]: row[3] for row in tuples(country_tail_counts(flights, airlines, COUNTRY))
    }
    assert by_tail["AA", "N8"] == 31
    assert by_tail["AA", None] == 20


def test_right_outer_keeps_unused_aircraft(flights, airlines, aircrafts, join_path):
    found = tuples(fleet_right_outer(flights, airlines, aircrafts, "United States"))
    used = [row for row in found if row[3] is not None]
    assert used == [("N1", "MAKER", "M1", "Umbra", 50)]
    assert len(found) == aircrafts.count()


def test_usage_counts_unused_aircraft_under_null(spark, flights, join_path):
    aircrafts = spark.createDataFrame(
        [("N1",), ("N2",), ("N2",), ("Q1",), ("Q2",)], "tailnum string"
    )
    found = dict(tuples(fleet_usage(flights, aircrafts)))
    n1 = sum(n for _, tail, n in LEGS if tail == "N1")
    n2 = sum(n for _, tail, n in LEGS if tail == "N2")
    assert found == {"N1": n1, "N2": 2 * n2, None: 2}


def test_unknown_aircraft_form_a_null_group(flights, airlines, aircrafts, join_path):
    found = {
        row[:3]: row[3]
        for row in tuples(fleet_with_unknown(flights, airlines, aircrafts, COUNTRY))
    }
    assert found[None, None, "Alpha"] == 40  # no such aircraft, and no tail number
    assert found[None, "M9", "Alpha"] == 20
    assert found["MAKER", None, "Alpha"] == 20


def test_join_coverage(spark, flights, aircrafts, join_path):
    known = {f"N{i}" for i in range(1, 9)} | {"N11"}
    expected = sum(n for _, tail, n in LEGS if tail in known) + 30
    assert tuples(join_coverage(flights, aircrafts)) == [(expected,)]
    assert tuples(join_coverage(flights.limit(0), aircrafts)) == [(0,)]


def test_null_tail_numbers_do_not_reach_the_models(spark, aircrafts, join_path):
    per_tail = spark.createDataFrame(
        [("Alpha", None, 3), ("Alpha", "N1", 2)],
        "name string, tail_number string, count long",
    )
    assert tuples(flights_per_model(per_tail, aircrafts)) == [
        ("Alpha", "MAKER", "M1", 2)
    ]
