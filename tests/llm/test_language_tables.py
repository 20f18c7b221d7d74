"""Language models of any size and number."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import language


@pytest.mark.parametrize("parts", [1, 5])
def test_tables_score_like_the_broadcast_model(spark, monkeypatch, parts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.select("doc_id", "text", F.concat("lang", (F.col("doc_id") % parts).cast("string")).alias("lang"))
    odd = [(None, "no id", None), (-1, None, "en0"), (-2, "x", "zz"), (-3, "日本 Ωμέγα", None), (-3, "日本 Ωμέγα", None)]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))

    def rows():
        return sorted((tuple(r) for r in language.identify(docs).collect()), key=repr)

    small = rows()
    monkeypatch.setattr(language, "MODEL_SEQUENCES", 0)
    large = rows()
    assert len(small) == len(large) > 200
    for a, b in zip(small, large):
        assert (*a[:4], a[6], a[7]) == (*b[:4], b[6], b[7])
        assert a[4:6] == pytest.approx(b[4:6], abs=1e-3)


def test_every_language_is_learned(spark):
    rng = random.Random(4)
    rows, words = [], {}
    for k in range(210):
        words[k] = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(6)]
        rows += [(10 * k + j, " ".join(rng.choices(words[k], k=12)), f"l{k:03}") for j in range(8)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len({r["lang_pred"] for r in found.collect()}) == 210
