from __future__ import annotations

import datetime

import pytest

from skyledger.plans.delays import delay_stats

FLIGHTS = (
    "carrier_code string, flight_date date, scheduled_departure_time string,"
    " actual_departure_time string"
)
DAY = datetime.date(1996, 6, 1)


@pytest.fixture
def airlines(spark):
    return spark.createDataFrame(
        [
            ("AA", "Alpha", "United States"),
            ("BB", "Beta", "Canada"),
            ("CC", "Gamma", "Canada"),
        ],
        "carrier_code string, name string, country string",
    )


@pytest.fixture
def flights(spark):
    return spark.createDataFrame(
        [
            ("AA", DAY, "10:00:00", "10:10:00"),
            ("AA", DAY, "10:00:00", "10:20:00"),
            ("AA", DAY, "10:00:00", "10:05:00"),
            ("AA", DAY, "10:00:00", "10:00:00"),  # on time
            ("AA", DAY, "10:00:00", "09:00:00"),  # early
            ("AA", DAY, "00:20:00", "23:50:00"),  # early over midnight
            ("AA", DAY, "23:55:00", "24:00:00"),
            ("AA", DAY, "10:00:00", None),  # cancelled
            ("AA", DAY, None, "10:00:00"),
            ("AA", DAY, "10:00", "11:00:00"),  # malformed
            ("AA", datetime.date(1995, 12, 31), "10:00:00", "15:00:00"),
            ("AA", datetime.date(1997, 1, 1), "10:00:00", "15:00:00"),
            ("BB", DAY, "06:00:00", "18:00:00"),
            ("BB", DAY, "06:00:00", "06:00:30"),
            ("CC", DAY, "10:00:00", "09:59:00"),  # only early flights
            ("ZZ", DAY, "10:00:00", "11:00:00"),  # no such airline
        ],
        FLIGHTS,
    )


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_signed_delays(flights, airlines, join_path):
    assert rows(delay_stats(flights, airlines, 1996)) == [
        ("Alpha", 4, 10.0, 5.0, 20.0),
        ("Beta", 2, 360.25, 0.5, 720.0),
    ]


def test_absolute_delays_count_early_over_midnight(flights, airlines):
    found = rows(delay_stats(flights, airlines, 1996, early_wrap="absolute"))
    assert found[0] == ("Alpha", 5, 14.0, 5.0, 30.0)


def test_country(flights, airlines):
    found = rows(delay_stats(flights, airlines, 1996, country="Canada"))
    assert found == [("Beta", 2, 360.25, 0.5, 720.0)]


def test_all_years(flights, airlines):
    assert rows(delay_stats(flights, airlines))[0] == ("Alpha", 6, 106.67, 5.0, 300.0)


def test_mean_is_rounded_half_up(spark, airlines):
    times = ["10:00:01"] * 3 + ["10:00:06"] * 1  # 9 s over 4 flights, 0.0375 min
    late = [("AA", DAY, "10:00:00", time) for time in times]
    found = rows(delay_stats(spark.createDataFrame(late, FLIGHTS), airlines))
    assert found == [("Alpha", 4, 0.04, 1 / 60, 0.1)]


def test_no_flights(spark, airlines):
    assert rows(delay_stats(spark.createDataFrame([], FLIGHTS), airlines, 1996)) == []
