"""Hard-negative mining against brute force: odd rows, ties, tiles, large components."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from skyledger.llm import negatives  # noqa: E402

ROWS = "vec_id long, embedding array<double>, label int, row string, score int, dim int"


def mined(spark, rows, every=5):
    df = spark.createDataFrame([(i, v, label, "r", 1, 2) for i, label, v in rows], ROWS)
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    out = []
    for k in range(160):
        centre = rng.choice(centres)
        out.append((k, rng.randint(0, 3), [0.5 * c + rng.gauss(0, 0.4) for c in centre]))
    # Copies under other ids and labels, rows that repeat, one id for several rows.
    out += [(200 + k, k % 3, out[5][2]) for k in range(40)]
    out += [out[7], out[7], (10, 1, out[3][2]), (10, 2, out[4][2])]
    odd = [None, [], [0.0] * 6, [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5]
    odd += [[None] + [1.0] * 5, [1.0, 2.0], [1.0, 1.5], [-0.0] * 6]
    out += [(300 + 5 * k + j, 1 + j, v) for k, v in enumerate(odd) for j in range(2)]
    return out + [(None, 1, out[0][2]), (400, None, out[0][2]), (405, 0, [0.0] * 6)]


def test_odd_rows(spark, rows):
    expected = brute.hard_negatives(rows, lambda i: i % 5 == 0)
    assert len(expected) > 100
    assert mined(spark, rows) == sorted(expected)


def test_tiles(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 8)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 3)
    assert mined(spark, rows) == sorted(brute.hard_negatives(rows, lambda i: i % 5 == 0))


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(k, k % 2, [rng.random() * 2**19 for _ in range(3)]) for k in range(30)]
    expected = brute.hard_negatives(rows, lambda i: i % 5 == 0)
    assert max(r[4] for r in expected) > 2**53
    assert mined(spark, rows) == sorted(expected)


def test_scores_stop_at_the_ends_of_64_bits(spark):
    rows = [(k, k % 2, [1e300, float(k)]) for k in range(12)]
    assert mined(spark, rows) == []
    tied = [(0, 0, [1e300]), (1, 0, [1e300]), (2, 1, [1e-300])]
    assert mined(spark, tied) == []


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(5, 1, [1.0])]) == []
