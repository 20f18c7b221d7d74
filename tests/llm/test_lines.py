"""Line dedup against brute force: odd rows, hot lines, long texts, bitmaps, plan."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from skyledger.llm import lines  # noqa: E402

# Extra columns under the names of the operator's own.
CLASHING = "row long, position int, key_a long, slices int, keep string, words int, n_lines string"
DOCS = f"doc_id long, text string, {CLASHING}"
EXTRA = (1, 2, 3, 4, "k", 5, "n")

COMMON = "Read the whole of this article"
ACCENTED = "Überall ÄHNLICHE Zeilen im Text"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    long = "\n".join(f"line {k % 700} of a very long text" for k in range(6_000))
    rows = [
        (1, COMMON),
        (2, f" \t{COMMON.upper()}\r\nonly here, only once, twenty\n{COMMON}"),
        (3, f"{COMMON}\n\n{COMMON}\n"),
        (4, f"\x0b{ACCENTED}\x0c\n{ACCENTED}"),
        (5, ACCENTED.lower().replace("ü", "Ü").replace("ä", "Ä")),
        (6, f"{ACCENTED}\n{ACCENTED.lower()}"),
        (7, "short line\nshort line"),
        (8, "short line"),
        (9, "short line"),
        (10, None),
        (11, ""),
        (12, "\n\n"),
        (13, "x" * 19 + "\n" + "x" * 20),
        (14, "x" * 19 + "\n" + "x" * 20),
        (15, "x" * 19 + "\n" + "X" * 20),
        (16, long),
        (17, long + "\n" + COMMON),
        (18, "line 5 of a very long text\n" + "y" * 300_000),
        (None, f"{COMMON}\nno id here, no id at all"),
        (None, "no id here, no id at all\nno id here, no id at all"),
        (20, "no id here, no id at all"),
        (-7, f"no id here, no id at all\n{COMMON}"),
        # Rows that repeat, and other rows under one id.
        (3, f"{COMMON}\n\n{COMMON}\n"),
        (3, f"something else of its own\n{COMMON}"),
        (17, long + "\n" + COMMON),
        (17, "line 3 of a very long text\nand its own end of it all"),
    ]
    return rows


def lines_of(spark, rows):
    found = lines.remove_lines(spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS))
    assert found.columns == [
        "doc_id", "text", "row", "position", "key_a", "slices", "keep", "words",
        "n_lines", "n_dropped",
    ]
    return ordered(found.select("doc_id", "n_lines", "n_dropped", "text").collect())


def test_odd_rows(spark, odd_rows):
    assert lines_of(spark, odd_rows) == ordered(brute.without_common_lines(odd_rows))


@pytest.mark.parametrize("sliced", [0, 2])
def test_hot_lines_are_dealt_over_slices(spark, odd_rows, monkeypatch, sliced):
    monkeypatch.setattr(lines, "SLICED", sliced) if sliced else None
    monkeypatch.setattr(lines, "SAMPLED", 1_000_000)
    rng = random.Random(4)
    rows = odd_rows + [
        (100 + k, "\n".join([COMMON] * rng.randint(0, 2) + [f"line {k % 9} of a very long text"]))
        for k in range(200)
    ]
    keys = lines.line_keys(spark.createDataFrame(rows, "doc_id long, text string"))
    assert lines._slices(keys).count() > 3
    assert lines_of(spark, rows) == ordered(brute.without_common_lines(rows))


def test_bitmaps_tell_the_kept_lines(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    found = {}
    for row in lines.keep_bitmaps(docs).collect():
        bits = {entry["word"]: entry["bits"] for entry in row["keep"] or []}
        kept = [k for k in range(row["n_lines"]) if bits.get(k // 64, -1) >> k % 64 & 1]
        assert len(kept) == row["n_lines"] - row["n_dropped"]
        found.setdefault(row["doc_id"], []).append(kept)
        # Only words that lose a line are listed.
        assert all(word != -1 for word in bits.values())
    assert found[2] == [[1]] and found[11] == [[0]] and 5 not in found[16][0]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert lines.remove_lines(empty).collect() == []
    assert lines.keep_bitmaps(empty).collect() == []


def test_hashes_are_sorted_once_and_by_range(spark, odd_rows, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    written = lines.stored
    monkeypatch.setattr(lines, "stored", kept)
    lines.dropped_lines(spark.createDataFrame(odd_rows, "doc_id long, text string"))
    [plan] = [p for p in plans if "Window" in p]
    assert plan.count("Exchange rangepartitioning") == 1
    assert "hashpartitioning" not in plan and "Python" not in plan
