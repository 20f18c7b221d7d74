"""The three jobs on random flights against plain Python, whatever the joins."""

from __future__ import annotations

import datetime
import random
import re
from collections import Counter, defaultdict

import pytest

from skyledger.plans.delays import delay_stats
from skyledger.plans.fleet import top_models_per_airline
from skyledger.plans.top_models import model_counts

TIMES = ["00:00:00", "00:20:00", "11:59:59", "12:00:00", "23:50:00", "24:00:00"]
TIMES += ["00:07:30", "18:00:01", "9:00:00", None]
AIRLINES = [(f"C{i}", f"Airline {i // 2}", f"Country {i % 3}") for i in range(8)]
AIRLINES += [AIRLINES[0], ("C9", "No country", None)]
MAKERS = ["CESSNA", "CESSNA", "BOEING", None]
MODELS = ["172S", "172", "T210", "SKYLANE", "1234", None]
FLIGHTS = (
    "carrier_code string, tail_number string, flight_date date,"
    " scheduled_departure_time string, actual_departure_time string"
)


@pytest.fixture(params=[1, 2])
def tables(request):
    rng = random.Random(request.param)
    aircrafts = [
        (f"N{i}", rng.choice(MAKERS), rng.choice(MODELS)) for i in range(30)
    ]
    aircrafts += aircrafts[:3]
    carriers = [code for code, _, _ in AIRLINES] + ["C0"] * 20 + ["unknown", None]
    tails = [f"N{i}" for i in range(28)] + ["N5"] * 20 + ["unlisted", None]
    flights = [
        (
            rng.choice(carriers),
            rng.choice(tails),
            datetime.date(rng.choice([1995, 1996]), rng.choice([1, 12]), 1),
            rng.choice(TIMES),
            rng.choice(TIMES),
        )
        for _ in range(600)
    ]
    return flights, aircrafts


def frames(spark, flights, aircrafts):
    return (
        spark.createDataFrame(flights, FLIGHTS),
        spark.createDataFrame(
            AIRLINES, "carrier_code string, name string, country string"
        ),
        spark.createDataFrame(
            aircrafts, "tailnum string, manufacturer string, model string"
        ),
    )


def seconds(time):
    if time is None or not re.fullmatch(r"\d\d:\d\d:\d\d", time):
        return None
    hours, minutes, secs = map(int, time.split(":"))
    return (hours * 3600 + minutes * 60 + secs) % 86400


def test_delays(spark, tables, join_path):
    flights, aircrafts = tables
    late = defaultdict(list)
    for carrier, _, date, scheduled, actual in flights:
        due, left = seconds(scheduled), seconds(actual)
        if date.year != 1996 or due is None or left is None:
            continue
        delay = left - due
        if abs(delay) > 43200:
            delay += -86400 if delay > 0 else 86400
        if delay > 0:
            late[carrier].append(delay)
    expected = []
    for code, name, _ in AIRLINES:
        if late[code]:
            gaps = late[code]
            mean = round(sum(gaps) / len(gaps) / 60, 2)
            expected.append((name, len(gaps), mean, min(gaps) / 60, max(gaps) / 60))
    f, airlines, _ = frames(spark, flights, aircrafts)
    found = sorted(tuple(row) for row in delay_stats(f, airlines, 1996).collect())
    assert len(found) == len(expected)
    for got, wanted in zip(found, sorted(expected)):
        assert got == pytest.approx(wanted, abs=0.0051)


@pytest.mark.parametrize("flown_only", [False, True])
def test_model_counts(spark, tables, join_path, flown_only):
    flights, aircrafts = tables
    per_tail = Counter(f[1] for f in flights if f[4] is not None or not flown_only)
    expected = {}
    for tail, maker, model in aircrafts:
        if maker == "CESSNA":
            found = re.search(r"\d{3}", model) if model is not None else None
            code = None if model is None else found.group() if found else ""
            flown = per_tail.get(tail)
            if flown is not None:
                expected[code] = (expected.get(code) or 0) + flown
            elif not flown_only:
                expected.setdefault(code, None)
    f, _, a = frames(spark, flights, aircrafts)
    counts = model_counts(f, a, flown_only=flown_only)
    assert {row.modelName: row.numFlights for row in counts.collect()} == expected


@pytest.mark.parametrize("ties", ["keep", "exact"])
def test_fleet(spark, tables, join_path, ties):
    flights, aircrafts = tables
    counts = Counter()
    for code, name, country in AIRLINES:
        if country != "Country 0":
            continue
        for carrier, tail, _, _, actual in flights:
            if carrier != code or actual is None:
                continue
            for listed, maker, model in aircrafts:
                if listed == tail and maker is not None and model is not None:
                    counts[name, maker, model] += 1
    expected = []
    for name in {key[0] for key in counts}:
        rows = sorted((-n, *key[1:]) for key, n in counts.items() if key[0] == name)
        for i, (n, maker, model) in enumerate(rows, 1):
            rank = i if ties == "exact" else 1 + sum(row[0] < n for row in rows)
            if rank <= 5:
                expected.append((name, maker, model, -n, rank))
    f, airlines, a = frames(spark, flights, aircrafts)
    ranked = top_models_per_airline(f, airlines, a, "Country 0", ties=ties)
    assert sorted(tuple(row) for row in ranked.collect()) == sorted(expected)
    assert expected
