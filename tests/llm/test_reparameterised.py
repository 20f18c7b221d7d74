"""Re-parameterised questions: names that open sentences, slots one to one, odd texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.llm import decontaminate

ITEM = (
    "Maria buys twelve red apples at the old market near the river. Maria gives three of them "
    "to her little brother on the way home. She eats two more after dinner that evening. "
    "Maria then counts how many apples are still left in the basket."
)
FILL = "something else was said before that had nothing to do with it. "


def found(spark, *texts, items=(ITEM,)):
    docs = spark.createDataFrame(
        [(k, t, "n", 1) for k, t in enumerate(texts)], "doc_id long, text string, names string, at int"
    )
    asked = spark.createDataFrame(
        [(k, t, "w", 2) for k, t in enumerate(items)], "item_id long, text string, window string, of int"
    )
    rows = decontaminate.leaks(docs, asked).collect()
    return {r["doc_id"]: r["changed"] for r in rows}


def put(text, **values):
    for old, new in values.items():
        text = text.replace(old, new)
    return text


def test_names_that_open_sentences(spark):
    peter = put(ITEM, Maria="Peter", twelve="15", three="4", two="6")
    texts = [ITEM, FILL + peter + " " + FILL, peter.lower(), ITEM.upper(), FILL * 4]
    assert found(spark, *texts) == {0: False, 1: True, 3: False}


def test_slots_are_one_to_one(spark):
    same = put(ITEM, twelve="5", three="5", two="5")
    other = put(ITEM, twelve="5", three="6", two="7")
    mixed = ITEM.replace("Maria", "Peter", 1)
    # Of the last, the windows with the other name are lost, and no more.
    assert found(spark, same, other, mixed) == {1: True, 2: False}


def test_an_opening_word_is_a_name_only_where_the_text_says_so(spark):
    df = spark.createDataFrame(
        [
            ("The cat sat. The dog ran to the door. Then he met Bert. Bert left. Anna did.",),
            ("On the mat the cat sat. On it went. Carl sat on it. Carl came.",),
            ("",), (None,), ("§ o §o §n X",),
        ],
        "text string",
    )
    marked_words = df.select(decontaminate.words_of(F.col("text")).alias("words"))
    words = [r["words"] for r in marked_words.collect()]
    marked = [[w for w in one if w.startswith("§")] for one in words]
    assert marked[:2] == [["§nbert", "§nbert"], ["§ncarl", "§ncarl"]]
    assert words[2] == words[3] == []
    assert not [w for w in words[4] if w in ("§o", "§n")]


@pytest.mark.parametrize("repeat", [2000])
def test_a_very_long_text(spark, repeat):
    text = (FILL * repeat) + put(ITEM, Maria="Greta", twelve="9") + " " + FILL.title() * 500
    assert found(spark, text) == {0: True}
