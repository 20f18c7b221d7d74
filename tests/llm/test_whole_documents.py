"""The mix takes documents whole."""

from __future__ import annotations

from skyledger.llm import mixing


def test_mixed_documents_are_whole(spark):
    rows = [(k, f"s{k % 3}", f"a{k}  b\nc d e f g") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = mixing.mix(docs).collect()
    assert {r["text"] for r in mixed} <= {r[2] for r in rows}
    targets = {r["source"]: r["target"] for r in mixing.plan(docs, "doc_id", "source").select("doc.source", "target").collect()}
    for source, target in targets.items():
        taken = 7 * sum(r["source"] == source for r in mixed)
        assert abs(taken - target) <= 4
