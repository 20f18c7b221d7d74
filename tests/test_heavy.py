"""Heavy hitters against exact counts; what is shuffled is bounded."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from skyledger.operators import heavy


@pytest.fixture(scope="module")
def keys():
    rng = random.Random(9)
    out = ["hot"] * 3000 + [None] * 700 + ["warm"] * 101 + ["even"] * 100 + ["cool"] * 99
    out += [f"k{rng.randrange(4000)}" for _ in range(10_000 - len(out))]
    rng.shuffle(out)
    return out


def found(df, share, **settings):
    return {r.key: r.n for r in heavy.heavy_hitters(df, "key", share, **settings).collect()}


@pytest.mark.parametrize(
    ("parts", "order", "share"),
    [(1, "as it comes", 0.01), (7, "sorted", 0.01), (7, "as it comes", 0.0004)],
)
def test_every_key_above_the_share(spark, keys, parts, order, share):
    df = spark.createDataFrame([(k, 1) for k in keys], "key string, n long").repartition(parts)
    if order == "sorted":
        df = df.repartitionByRange(parts, "key").sortWithinPartitions("key")
    expected = {k: n for k, n in Counter(keys).items() if n > share * len(keys)}
    assert found(df, share) == expected
    assert ("even" in expected) == (share < 0.01)


def test_small_batches_lose_nothing(spark, keys):
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(3)
    spark.conf.set(batch, 37)
    try:
        for counters in (2, 4):
            counted = heavy.candidates(df, "key", 0.01, counters)
            names = {r.key for r in counted.collect()}
            assert names >= {k for k, n in Counter(keys).items() if n > 100}
            assert len(names) < counters / (counters - 1) / 0.01
            assert found(df, 0.01, counters=counters) == {"hot": 3000, None: 700, "warm": 101}
    finally:
        spark.conf.unset(batch)


def test_numbers_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(5,), (5,), (None,), (7,)], "key long")
    assert found(df, 0.3) == {5: 2}
    assert found(df, 0.2) == {5: 2, None: 1, 7: 1}
    assert found(spark.createDataFrame([], "key long"), 0.2) == {}
    assert found(spark.createDataFrame([(None,)] * 3, "key long"), 0.2) == {None: 3}
    with pytest.raises(ValueError, match="share"):
        heavy.heavy_hitters(df, "key", 0)


def test_no_shuffle_of_all_keys(spark):
    df = spark.range(0, 200_000, 1, 4).selectExpr("if(id % 10 = 0, 0, id) AS key")
    rows = heavy.heavy_hitters(df, "key", 0.01)
    assert [tuple(r) for r in rows.collect()] == [(0, 20_000)]
    plan = rows._jdf.queryExecution().executedPlan().executedPlan()
    text = plan.toString()
    # The tasks' counters are read twice from one shuffle of them.
    assert text.count("MapInArrow") == 1 and "ReusedExchange" in text
