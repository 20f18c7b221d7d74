"""One row of each component stays, whatever ids repeat."""

from __future__ import annotations

from skyledger.llm import simhash

A = "one text that is entirely its own and stands for itself alone here"
B = "quite another text about the weather of last year in the mountains"


def kept(spark, *rows):
    schema = "doc_id long, text string, row string, component_id int, fingerprint long"
    df = spark.createDataFrame([(*r, "r", 1, 2) for r in rows], schema)
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def test_ids_that_clash(spark):
    assert kept(spark, (3, B), (5, A), (5, B)) == [(3, B), (5, A)]
    assert kept(spark, (5, A), (5, B), (5, A), (7, B)) == [(5, A), (5, B)]
    assert kept(spark, (5, A), (5, A), (5, A)) == [(5, A)]


def test_rows_without_an_id_stay(spark):
    assert kept(spark, (None, A), (None, A), (4, A)) == [(4, A), (None, A), (None, A)]
    assert kept(spark, (4, None), (3, ""), (5, " \n")) == [(3, "")]
