"""Windows of decontamination: what they are, and that compiled code makes them."""

from pyspark.sql import functions as F

from skyledger.llm import decontaminate


def test_windows_are_made_by_compiled_code(spark):
    rows = [
        (1, ["the", "§nanna", "has", "§d12", "red", "apples"]),
        (2, ["the", "anna", "has", "twelve", "red", "pears"]),
        (3, ["too", "few", "words", "here"]),
        (4, []),
    ]
    texts = spark.createDataFrame(rows, "id long, words array<string>")
    made = decontaminate.windows(texts)
    found = {(r["id"], r["pos"], r["named"]): r["window"] for r in made.collect()}
    assert sorted(found) == [(1, 0, False), (1, 0, True), (1, 1, False), (1, 1, True),
                             (2, 0, False), (2, 1, False)]
    # The number's words are one slot; the name is one in the template alone.
    assert found[1, 0, True] == found[2, 0, False] != found[1, 0, False]
    assert found[1, 1, True] != found[2, 1, False]
    plan = made._jdf.queryExecution().executedPlan().toString()
    hashed = [line for line in plan.splitlines() if "Generate" in line and "xxhash64" in line]
    assert hashed and all("*(" in line and "lambda" not in line for line in hashed)


def test_a_window_of_documents_is_the_items(spark):
    text = "On Monday Anna Berg sold 12 apples. Anna walked two miles home"
    words = spark.range(1).select("id", decontaminate.words_of(F.lit(text)).alias("words"))
    other = text.replace("Anna", "Peter").replace("12", "forty")
    again = spark.range(1).select("id", decontaminate.words_of(F.lit(other)).alias("words"))
    first, second = (
        {(r["pos"], r["window"]) for r in decontaminate.windows(w).filter("not named").collect()}
        for w in (words, again)
    )
    assert first == second and len(first) == len(text.split()) - decontaminate.WINDOW_WORDS + 1
