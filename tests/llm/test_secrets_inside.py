"""Random strings behind an equals sign, in a path or behind a prefix."""

from __future__ import annotations

import random

from skyledger.llm import secrets


def test_random_strings_inside_longer_stretches(spark):
    rng = random.Random(9)
    alphabet = secrets.ALPHABETS["base62"].decode()
    plain = ["stone", "River", "under", "quiet", "Lantern", "of", "and"]
    rows = [(k, " ".join(rng.choices(plain, k=200))) for k in range(50)]
    secret = "".join(rng.choices(alphabet, k=40))
    shapes = ["key={}", "sig={}==", "http://a.b/c?client_id={}&x=1", "my-site_logs/of-days/{}/x", "a=b={}"]
    texts = [f"see {shape.format(secret)} here" for shape in shapes]
    rows += [(50 + k, text) for k, text in enumerate(texts)]
    rows.append((99, "this-is-a-long-slug/of_plain=words-and-more-plain-words-2024 x"))
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()}
    for k, text in enumerate(texts):
        at = text.index(secret)
        assert len(spans[50 + k]) == 1
        start, kind, end = spans[50 + k][0]
        assert kind == 3 and at - 5 <= start <= at and at + 40 <= end <= at + 42
    assert not any(spans[k] for k in [*range(50), 99])
