"""Extra columns under the operators' own names change nothing."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import functions as F

from skyledger.llm import embeddings, urls


def test_vectors(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(30)]
    rows += [(40, rows[3][1]), (41, None), (42, [0.0] * 8), (None, rows[4][1])]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    names = ("node", "n", "first", "share", "label", "a", "b", "id", "component")
    clashing = reduce(lambda df, name: df.withColumn(name, F.lit("x")), names, plain)
    found = sorted(map(tuple, embeddings.near_duplicates(clashing).collect()), key=repr)
    assert found == sorted(map(tuple, embeddings.near_duplicates(plain).collect()), key=repr)
    assert {r[0]: r[1] for r in found}[40] == 1


def test_pages_and_rules(spark):
    pages = spark.createDataFrame(
        [(1, "http://A.b.net/x"), (2, None), (3, "no url"), (4, "http://org/fr/")], "page_id long, url string"
    )
    listed = spark.createDataFrame([("net/", "block"), ("org/fr/", "allow")], "rule string, verdict string")
    names = ("host", "path", "rule", "key", "verdict", "block", "lane_0")
    clashing = reduce(lambda df, name: df.withColumn(name, F.lit("x")), names, pages)
    more = listed.withColumn("page_id", F.lit(9)).withColumn("key", F.lit("k"))
    found = sorted(map(tuple, urls.judge(clashing, more).collect()))
    assert found == sorted(map(tuple, urls.judge(pages, listed).collect()))
    assert [r[4] for r in found] == ["block", "allow", "allow", "allow"]
