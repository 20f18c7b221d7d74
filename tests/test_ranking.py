from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.operators.ranking import first_within, ranked_within

GROUPS = st.sampled_from(["a", "b", None])
ROWS = st.lists(st.tuples(GROUPS, st.integers(0, 4)), max_size=30)


def brute_force(rows, n, descending):
    kept = []
    for i, (group, value) in enumerate(rows):
        others = [v for g, v in rows if g == group]
        ahead = sum(v > value if descending else v < value for v in others)
        if ahead + 1 <= n:
            kept.append((group, value, i, ahead + 1))
    return sorted(kept, key=repr)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rows=ROWS, n=st.integers(1, 4), descending=st.booleans())
def test_ranked_within_equals_brute_force(spark, rows, n, descending):
    df = spark.createDataFrame(
        [(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v int, i int"
    )
    ranked = ranked_within(df, "g", "v", n, descending=descending)
    found = sorted((tuple(row) for row in ranked.collect()), key=repr)
    assert found == brute_force(rows, n, descending)


def test_first_within_numbers_rows_in_order(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", 2, "w")],
        "g string, v int, name string",
    )
    first = first_within(df, "g", [F.col("v").desc(), F.col("name")], 2)
    assert sorted(tuple(row) for row in first.collect()) == [
        ("a", 3, "y", 1),
        ("a", 3, "z", 2),
        ("b", 2, "w", 1),
    ]
