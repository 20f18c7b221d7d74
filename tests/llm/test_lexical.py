"""Lexical search against brute force: odd rows, many terms, small chunks, several passes."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from skyledger.llm import lexical  # noqa: E402

DOCS = "doc_id long, text string, item long, n int, terms string, score int, rank int"
ITEMS = "item_id long, text string, doc_id long, item int"
EXTRA = (1, 2, "t", 3, 4)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(150)] + ["Ärger", "naïve", "日本", "THE", "the"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]

    def text(n):
        return " ".join(rng.choices(vocabulary, weights, k=n))

    docs = [(k, text(rng.randint(1, 60))) for k in range(150)]
    docs += [
        (200, None), (201, ""), (202, " ,.; "), (203, "w1-w2/w3\x00W1"),
        (204, "w7 " * 40_000), (205, text(30_000)),
        docs[3], docs[3], (None, docs[4][1]), (None, None), (-5, docs[4][1]),
    ]
    items = [(k, text(rng.randint(1, 25))) for k in range(12)]
    items += [
        (50, " ".join(vocabulary)), (51, None), (52, "!?"), (53, "unheard of"),
        items[0], items[0], (None, "w1 w5"), (54, docs[4][1]),
    ]
    return docs, items


def found(spark, rows):
    docs, items = rows
    got = lexical.search(
        spark.createDataFrame([(*d, *EXTRA) for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS),
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def test_odd_rows(spark, rows):
    assert found(spark, rows) == sorted(brute.ranked(*rows), key=repr)


def test_small_chunks_pieces_and_passes(spark, rows, monkeypatch):
    for name, value in (
        ("POSTINGS_AT_ONCE", 40), ("BYTES_AT_ONCE", 50), ("DOCS_AT_ONCE", 7), ("ITEM_BYTES", 200)
    ):
        monkeypatch.setattr(lexical, name, value)
    assert found(spark, rows) == sorted(brute.ranked(*rows), key=repr)


def test_empty_tables(spark, rows):
    assert found(spark, (rows[0][:0], rows[1])) == []
    assert found(spark, (rows[0], rows[1][:0])) == []
    assert found(spark, ([(1, None)], rows[1])) == []
