"""Keyed comparison of two reads against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from skyledger.operators.comparing import compare, unmatched

SCHEMA = "id long, part string, x string, y double, z array<int>"


def brute(left, right):
    rest_left, rest_right = Counter(left), Counter(right)
    both = rest_left & rest_right
    rest_left, rest_right = rest_left - both, rest_right - both
    groups = defaultdict(lambda: ([], []))
    for side, rest in enumerate((rest_left, rest_right)):
        for row in rest.elements():
            groups[row[:2]][side].append(row[2:])
    out = Counter()
    for a, b in groups.values():
        out["only left", None] += max(0, len(a) - len(b))
        out["only right", None] += max(0, len(b) - len(a))
        for place, name in enumerate("xyz"):
            common = Counter(r[place] for r in a) & Counter(r[place] for r in b)
            out["differs", name] += min(len(a), len(b)) - sum(common.values())
    return {k: n for k, n in out.items() if n}


def compared(spark, left, right):
    sides = (
        spark.createDataFrame([(*r[:4], None if r[4] is None else list(r[4])) for r in rows], SCHEMA)
        for rows in (left, right)
    )
    rows = compare(*sides, ["id", "part"]).collect()
    assert len({(r.kind, r.column) for r in rows}) == len(rows)
    return {(r.kind, r.column): r.n for r in rows}


def rows(rng, n):
    return [
        (
            rng.choice([None, *range(12)]), rng.choice("ab"), rng.choice(["p", "q", "null", None]),
            rng.choice([0.5, None]), rng.choice([(), (1,), None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_random_rows(spark, seed):
    rng = random.Random(seed)
    left = rows(rng, 150)
    right = [r if rng.random() < 0.8 else rows(rng, 1)[0] for r in left] + rows(rng, 10)
    rng.shuffle(right)
    assert compared(spark, left, right) == brute(left, right)


def test_same_rows_empty_sides_and_hot_keys(spark):
    rng = random.Random(7)
    left = rows(rng, 60)
    assert compared(spark, left, left[::-1]) == {}
    assert compared(spark, [], []) == {}
    assert compared(spark, left, []) == {("only left", None): 60}
    hot = [(None, "a", f"v{k % 9}", None, None) for k in range(300)]
    other = [(None, "a", f"v{k % 7}", None, None) for k in range(280)]
    assert compared(spark, hot, other) == brute(hot, other)


def test_unmatched_rows_and_keys_alone(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id long, `x y` string")
    right = spark.createDataFrame([(None, 1), ("b", 3), ("a", 1)][1:], "`x y` string, id long")
    found = {tuple(r) for r in unmatched(left, right).collect()}
    assert found == {(1, "a", 1, 0), (2, None, 1, 0), (3, "b", 0, 1)}
    keys = compare(left.select("id"), right.select("id"), ["id"])
    assert {tuple(r) for r in keys.collect()} == {("only left", None, 2), ("only right", None, 1)}
    with pytest.raises(ValueError, match="same columns"):
        compare(left, right.drop("id"), ["id"])


def test_the_rows_are_shuffled_once(spark):
    wide = "id, id % 7 AS part, string(id) AS x, double(id) AS y, array(int(id)) AS z"
    left = spark.range(1000).selectExpr(*wide.split(", "))
    plan = unmatched(left, left)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
