"""Benchmark decontamination by template windows and slot consistency."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import let, stored

WINDOW_WORDS = 5
LEAST_SHARE = 0.8

# A window must hold this many words that are no placeholders.
LEAST_LITERAL = 3

# Diagonals this close are one span with words put in or left out.
NEIGHBOURS = 3

# Numbers and units that are written as words.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen "
    "fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty "
    "sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm km inch inches foot feet yard yards mile miles mg kg gram grams ounce ounces "
    "pound pounds ml liter liters litre litres gallon gallons second seconds minute "
    "minutes hour hours day days week weeks month months year years cent cents dollar "
    "dollars euro euros percent kmh mph kwh degrees"
).split()


def marked_words(text: Column) -> Column:
    """Lower-case words; those that may fill a slot carry a mark of its type.

    A capital inside a sentence begins a name (mark n), any other one a word that may be
    a name (o), digits make a number (d), and the words listed above numbers and units.
    """
    # The first letter is looked at before what stands in front of it: most have none.
    name = r"(?=\p{Lu})(?<=[^\s.!?:;][ \t])([\p{L}'-]+)"
    opening = r"(?=\p{Lu})(?<![\p{L}\p{N}'-])([\p{L}'-]+)"
    number = r"(?=\p{N})(?<![\p{L}\p{N}])(\p{N}+(?:[.,]\p{N}+)*)(?![\p{L}\p{N}])"
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("§"), F.lit(" "))
    text = F.regexp_replace(F.regexp_replace(text, name, "§n$1"), opening, "§o$1")
    text = F.regexp_replace(F.lower(text), number, "§d$1")
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}§]+"), "")


def _bare(word: Column) -> Column:
    return F.substring(word, 3, 1 << 20)


def _starting(words: Column, mark: str) -> Column:
    return F.filter(words, lambda w: F.startswith(w, F.lit(mark)))


def _names(words: Column) -> Column:
    """What a capitalised word may open a sentence with and is a name: one that the text
    has as a name inside a sentence, or at several openings and nowhere in lower case."""
    inner = F.transform(_starting(words, "§n"), _bare)

    def repeated(opening: Column) -> Column:
        # In order, so that a word which repeats stands behind itself.
        again = F.filter(
            opening, lambda w, k: (k > 0) & w.eqNullSafe(F.get(opening, k - 1))
        )
        return F.array_except(F.transform(again, _bare), words)

    return F.array_union(inner, let(F.sort_array(_starting(words, "§o")), repeated))


def words_of(text: Column) -> Column:
    """The marked words of a text, words at openings told from names."""

    def told(words: Column, names: Column) -> Column:
        def word(w: Column) -> Column:
            name = F.concat(F.lit("§n"), _bare(w))
            own = F.when(F.array_contains(names, _bare(w)), name).otherwise(_bare(w))
            return F.when(F.startswith(w, F.lit("§o")), own).otherwise(w)

        return F.transform(words, word)

    return let(
        marked_words(text), lambda words: let(_names(words), lambda names: told(words, names))
    )


def canonical(word: Column) -> Column:
    """A marked word with its slot value left out."""
    return (
        F.when(F.startswith(word, F.lit("§")), F.substring(word, 1, 2))
        .when(word.isin(NUMBER_WORDS), "§d")
        .when(word.isin(UNITS), "§u")
        .otherwise(word)
    )


def plain(word: Column) -> Column:
    """A marked word with its slot value left out, unless it is a name: case says nothing."""
    return canonical(F.when(F.startswith(word, F.lit("§n")), _bare(word)).otherwise(word))


def _name_hash(word: Column) -> Column:
    """The hash of a name as ``plain`` has it; null for other words."""
    return F.when(F.startswith(word, F.lit("§n")), F.xxhash64(plain(word)))


def value(word: Column) -> Column:
    """A marked word without its mark."""
    return F.regexp_replace(word, "^§[nd]", "")


def windows(texts: DataFrame) -> DataFrame:
    """``texts`` with (pos, window, named), a row for each template window of ``words``, in
    place of these, and where the window has a name, one more for the same words with the
    name kept in lower case; none for fewer words than one. Windows are hashes.

    Words are hashed once, in arrays. Windows are made from rows of a place each, as
    compiled code does: functions of arrays take several times as long for every place.
    """
    carried = [name for name in texts.columns if name != "words"]
    places = F.sequence(F.lit(0), F.size("template") - WINDOW_WORDS)
    own = [F.get("template", F.col("pos") + k) for k in range(WINDOW_WORDS)]
    names = [F.get("names", F.col("pos") + k) for k in range(WINDOW_WORDS)]
    bare = F.xxhash64(*(F.coalesce(n, w) for n, w in zip(names, own)))
    return (
        texts.select(
            *carried,
            F.transform("words", lambda w: F.xxhash64(canonical(w))).alias("template"),
            F.transform("words", _name_hash).alias("names"),
        )
        .select("*", F.explode(F.when(F.size("template") >= WINDOW_WORDS, places)).alias("pos"))
        .select(
            *carried,
            "pos",
            F.posexplode(
                F.array(F.xxhash64(*own), F.when(F.coalesce(*names).isNotNull(), bare))
            ).alias("named", "window"),
        )
        .filter(F.col("window").isNotNull())
        .withColumn("named", F.col("named") == 1)
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, changed) of documents that hold a benchmark item.

    Both texts become templates: numbers, names and units turn into typed placeholders.
    Windows of ``WINDOW_WORDS`` template words are joined by hash, and so are the same
    words with names in lower case, for texts in another case; a match of either votes for
    its diagonal, and close diagonals are one span. Its slots must be consistent, one to
    one: where the item repeats a value, the span repeats the value it put there, and
    where the item has different values, so has the span. An item is held if
    the consistent spans of a document together have ``LEAST_SHARE`` of its windows, so
    that words put in or sentences swapped lose no more than the windows they break.
    ``changed`` tells that the spans with the item's own values do not have that share
    alone, a re-parameterised question.

    Windows with fewer than ``LEAST_LITERAL`` plain words say too little and are left
    out. The share is of the places whose template window says enough or of those where
    either window does, whichever is larger; an item without any other window matches nothing, as do null and empty texts.
    Repeated rows are reported once, an item listed twice under both ids; other columns
    are ignored and empty tables give an empty result.
    """
    slot = F.startswith(F.col("word"), F.lit("§"))
    items = (
        benchmark.select("item_id", words_of(F.col("text")).alias("words"))
        .filter(F.size("words") >= WINDOW_WORDS)
        .distinct()
    )

    def literal(word: Callable[[Column], Column]) -> Column:
        return F.size(
            F.filter(
                F.transform(F.slice("words", F.col("pos") + 1, WINDOW_WORDS), word),
                lambda w: ~F.startswith(w, F.lit("§")),
            )
        )

    strong = literal(canonical) >= LEAST_LITERAL
    item_windows = (
        windows(items.withColumn("asked", F.col("words")))
        .withColumnRenamed("asked", "words")
        .filter(F.when(F.col("named"), literal(plain) >= LEAST_LITERAL).otherwise(strong))
        .select("item_id", F.col("pos").alias("at"), "window", strong.alias("strong"))
    )
    strong_at = F.when(F.col("strong"), F.col("at"))
    sizes = item_windows.groupBy("item_id").agg(
        F.count_distinct("at").alias("of"), F.count_distinct(strong_at).alias("of_strong")
    )
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    matches = (
        windows(keyed.select("key", "doc_id", words_of(F.col("text")).alias("words")))
        .select("key", "doc_id", "pos", "window")
        .join(item_windows, "window")
        .withColumn("diagonal", F.col("pos") - F.col("at"))
        .groupBy("key", "doc_id", "item_id", "diagonal")
        .agg(F.collect_set("at").alias("ats"), F.collect_set(strong_at).alias("strong_ats"))
    )
    by_diagonal = Window.partitionBy("key", "doc_id", "item_id").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > NEIGHBOURS

    def different(ats: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(ats))))

    def held(n: str, n_strong: str) -> Column:
        return F.greatest(
            F.col(n) / F.col("of"),
            F.when(F.col("of_strong") > 0, F.col(n_strong) / F.col("of_strong")),
        )

    similarity = held("n", "n_strong")
    pair = ["key", "doc_id", "item_id"]
    spans = (
        matches.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(by_diagonal))
        .groupBy(*pair, "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"),
            F.array_distinct(F.flatten(F.collect_list("strong_ats"))).alias("strong_ats"),
            F.collect_list(F.struct("diagonal", "ats")).alias("places"),
        )
    )
    # A pair whose spans do not reach the share together needs no look at its slots. Written,
    # as it is read twice and few rows are left.
    found = stored(
        spans.groupBy(*pair)
        .agg(
            different("ats").alias("n"),
            different("strong_ats").alias("n_strong"),
            F.collect_list(F.struct("span", "ats", "strong_ats", "places")).alias("spans"),
        )
        .join(sizes, "item_id")
        .filter(similarity >= LEAST_SHARE)
        .select(*pair, "of", "of_strong", F.inline("spans")),
        "leaks-found",
    )
    place = F.explode("places").alias("place")
    slots = (
        found.select("key", "item_id", "span", place)
        .select("key", "item_id", "span", "place.diagonal", F.explode("place.ats").alias("at"))
        .withColumn("at", F.explode(F.sequence(F.col("at"), F.col("at") + WINDOW_WORDS - 1)))
        .distinct()
        .join(
            items.select("item_id", F.posexplode("words").alias("at", "word"))
            .filter(slot | F.col("word").isin(NUMBER_WORDS + UNITS))
            .select("item_id", "at", value(F.col("word")).alias("asked")),
            ["item_id", "at"],
        )
    )
    texts = keyed.join(slots.select("key").distinct(), "key", "left_semi").distinct()
    filled = (
        slots.join(
            texts.select("key", words_of(F.col("text")).alias("words")).distinct(), "key"
        )
        .withColumn("given", value(F.get("words", F.col("diagonal") + F.col("at"))))
        .groupBy("key", "item_id", "span")
        .agg(
            F.count_distinct("asked").alias("n_asked"),
            F.count_distinct("given").alias("n_given"),
            F.count_distinct("asked", "given").alias("n_pairs"),
            F.max((F.col("asked") != F.col("given")).cast("int")).alias("changed"),
        )
    )
    own = F.coalesce("changed", F.lit(0)) == 0
    return (
        found.drop("places")
        .join(filled, ["key", "item_id", "span"], "left")
        .filter(
            F.col("n_pairs").isNull()
            | (F.col("n_pairs") <= F.least("n_asked", "n_given"))
        )
        .withColumn("own_ats", F.when(own, F.col("ats")))
        .withColumn("own_strong_ats", F.when(own, F.col("strong_ats")))
        .groupBy(*pair, "of", "of_strong")
        .agg(
            different("ats").alias("n"),
            different("strong_ats").alias("n_strong"),
            different("own_ats").alias("n_own"),
            different("own_strong_ats").alias("n_own_strong"),
        )
        .select(
            *pair,
            similarity.alias("similarity"),
            (held("n_own", "n_own_strong") < LEAST_SHARE).alias("changed"),
        )
        .filter(F.col("similarity") >= LEAST_SHARE)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, in the columns of ``docs``.

    Null, blank and short texts stay, rows that repeat go or stay together, and without
    items or documents the table is as it was.
    """
    found = leaks(docs, benchmark).select(F.col("key").alias("leak")).distinct()
    key = F.xxhash64(docs["doc_id"], docs["text"])
    return docs.join(found, key == found["leak"], "left_anti")
