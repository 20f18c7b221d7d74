from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.functions import departure_gap, in_year, in_year_text, model_code
from skyledger.functions import seconds_of_day, wrap_gap

# scheduled, actual, signed minutes, absolute minutes
MIDNIGHT_ROWS = [
    ("22:20:00", "23:50:00", 90, 90),
    ("23:50:00", "00:20:00", 30, 30),
    ("00:20:00", "23:50:00", -30, 30),
    ("06:00:00", "18:00:00", 720, 720),
    ("18:00:00", "06:00:00", -720, -720),
    ("23:30:00", "24:00:00", 30, 30),
    ("24:00:00", "00:10:00", 10, 10),
    ("10:00:00", None, None, None),
    (None, "10:00:00", None, None),
]


@pytest.mark.parametrize("early_wrap", ["signed", "absolute"])
def test_delay_across_midnight(spark, early_wrap):
    df = spark.createDataFrame(
        MIDNIGHT_ROWS, "scheduled string, actual string, signed int, absolute int"
    )
    gap = departure_gap(F.col("scheduled"), F.col("actual"))
    found = df.select(wrap_gap(gap, early_wrap) / 60, early_wrap).collect()
    assert [tuple(row) for row in found] == [(row[1], row[1]) for row in found]
    assert len(found) == len(MIDNIGHT_ROWS)


def test_unknown_wrap_is_refused(spark):
    with pytest.raises(ValueError, match="early_wrap"):
        wrap_gap(F.lit(1), "other")


def test_seconds_of_day(spark):
    cases = {
        "00:00:00": 0,
        "24:00:00": 0,
        "00:00:59": 59,
        "23:59:59": 86399,
        "24:00:01": None,
        "7:00:00": None,
        "25:00:00": None,
        "12:60:00": None,
        "+1:00:00": None,
        "ab:cd:ef": None,
        "12:00:00\n": None,
        "": None,
    }
    df = spark.createDataFrame([(text,) for text in cases], "t string")
    rows = df.select("t", seconds_of_day(F.col("t")).alias("s")).collect()
    assert {row.t: row.s for row in rows} == cases


def test_in_year_includes_both_ends(spark):
    texts = ["1995-12-31", "1996-01-01", "1996-12-31", "1997-01-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(
        in_year_text(F.col("t"), 1996).alias("text"),
        in_year(F.col("t").cast("date"), 1996).alias("typed"),
    ).collect()
    assert [row.text for row in found] == [False, True, True, False, None]
    assert [row.typed for row in found] == [False, True, True, False, None]


def test_model_code(spark):
    cases = {"172S": "172", "T-337 400": "337", "A12B": "", "1234": "123", None: None}
    df = spark.createDataFrame([(m,) for m in cases], "m string")
    rows = df.select("m", model_code(F.col("m")).alias("code")).collect()
    assert {row.m: row.code for row in rows} == cases
