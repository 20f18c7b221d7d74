"""Line dedup: hashed lines, range-partitioned and sorted, become keep bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

# A line counts from this many code points on, and is common from this many documents on.
LEAST_CHARS = 20
LEAST_DOCUMENTS = 3

# What is stripped at both ends of a line, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Lines sampled for each shuffle partition, and so many of one key make a slice. At most
# SAMPLED / SLICED keys for each partition are sliced, which bounds what is broadcast.
SAMPLED = 100
SLICED = 20
SEED = 11

WORD_BITS = 64
KEY = ("key_a", "key_b")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row() -> Column:
    """Tells rows under one doc_id apart by their texts."""
    return F.xxhash64("doc_id", "text")


def line_keys(docs: DataFrame) -> DataFrame:
    """(key_a, key_b, doc_id, row, position) of every line long enough to be compared.

    A line is its place and 128 bits of hash, two 64-bit hashes with different seeds.
    """
    line = F.btrim("line", F.lit(BLANKS))
    # Of ASCII text, plain lower() changes the same letters and is several times faster.
    plain = F.length("line") == F.octet_length("line")
    key = F.when(plain, F.lower("line")).otherwise(F.translate("line", UPPER, LOWER))
    return (
        docs.select("doc_id", _row().alias("row"), F.posexplode(_lines(F.col("text"))))
        .select("doc_id", "row", F.col("pos").alias("position"), F.col("col").alias("line"))
        .filter(F.length("line") >= LEAST_CHARS)
        .withColumn("line", line)
        .filter(F.length("line") >= LEAST_CHARS)
        .withColumn("line", key)
        .select(
            F.xxhash64("line").alias("key_a"),
            F.xxhash64(F.lit(SEED), F.col("line")).alias("key_b"),
            "doc_id",
            "row",
            "position",
        )
    )


def _slices(lines: DataFrame) -> DataFrame:
    """(key_a, key_b, slices) of the keys that would outgrow a partition.

    Found in a sample whose size goes with the number of partitions, as Spark finds the
    borders of ranges; it only places rows and has no part in any decision.
    """
    spark = lines.sparkSession
    wanted = SAMPLED * int(spark.conf.get("spark.sql.shuffle.partitions"))
    fraction = min(1.0, wanted / max(1, lines.count()))
    seen = lines.select(*KEY).sample(fraction, SEED).groupBy(*KEY).count()
    slices = F.ceil(F.col("count") / SLICED).cast("int").alias("slices")
    return stored(seen.filter(F.col("count") > SLICED).select(*KEY, slices), "line-slices")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, position) of every line that goes.

    Hashes are range-partitioned and sorted by document, latest first, and position; the
    first document of a key's stream keeps its lines, those after it lose theirs if the
    stream has enough documents. A key that fills partitions is dealt by document over
    slices: each has a first document, and the first of them all is the key's.
    """
    lines = stored(line_keys(docs), "line-keys")
    slices = _slices(lines)
    placed = lines.join(F.broadcast(slices), list(KEY), "left").withColumn(
        "slice",
        F.coalesce(F.pmod(F.xxhash64("doc_id"), "slices"), F.lit(0)).cast("int"),
    )
    latest = F.col("doc_id").desc_nulls_last()
    group = Window.partitionBy(*KEY, "slice")
    ranked = (
        placed.repartitionByRange(*KEY, "slice")
        .sortWithinPartitions(*KEY, "slice", latest, "position")
        .withColumn("turn", F.dense_rank().over(group.orderBy(latest)))
        .withColumn("documents", F.max("turn").over(group))
        .withColumn("first", F.max("doc_id").over(group))
    )
    common = F.col("documents") >= LEAST_DOCUMENTS
    whole = F.col("slices").isNull()
    ranked = stored(
        ranked.filter(~whole | common & (F.col("turn") > 1)).select(
            *KEY, "slices", "slice", "documents", "first", "doc_id", "row", "position"
        ),
        "line-turns",
    )
    place = ["doc_id", "row", "position"]
    sliced = ranked.filter(~whole)
    # A row for each sliced key: a bounded number, see SLICED.
    keys = (
        sliced.groupBy(*KEY, "slice")
        .agg(F.first("documents").alias("documents"), F.first("first").alias("first"))
        .groupBy(*KEY)
        .agg(F.sum("documents").alias("documents"), F.max("first").alias("first"))
        .filter(common)
    )
    later = sliced.drop("documents", "first").join(F.broadcast(keys), list(KEY))
    later = later.filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    return ranked.filter(whole).select(*place).unionByName(later.select(*place))


def _bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc_id, row, n_dropped, keep, words) of the documents that lose a line."""
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.col("position") % WORD_BITS
    )
    number = F.floor(F.col("position") / WORD_BITS).cast("int").alias("word")
    words = dropped.groupBy("doc_id", "row", number).agg(F.bit_or(bit).alias("gone"))
    entry = F.struct("word", F.bitwise_not("gone").alias("bits"))
    rows = words.groupBy("doc_id", "row").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"),
        F.array_sort(F.collect_list(entry)).alias("keep"),
    )

    def filled(entry: Column, at: Column) -> Column:
        before = F.coalesce(F.get("keep", at - 1)["word"], F.lit(-1))
        skipped = F.array_repeat(F.lit(-1).cast("long"), entry["word"] - before - 1)
        return F.concat(skipped, F.array(entry["bits"]))

    return rows.withColumn("words", F.flatten(F.transform("keep", filled)))


def _with_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc, lines, n_dropped, keep, words): each row of ``docs`` and its bitmap."""
    columns = (F.col(f"`{name}`") for name in docs.columns)
    rows = docs.select(
        F.struct(*columns).alias("doc"), _row().alias("row"), F.col("doc_id")
    )
    own = _bitmaps(dropped_lines(docs.select("doc_id", "text"))).alias("own")
    same = (F.col("rows.row") == F.col("own.row")) & F.col("rows.doc_id").eqNullSafe(
        F.col("own.doc_id")
    )
    return rows.alias("rows").join(own, same, "left").select(
        "doc",
        _lines(F.col("doc.text")).alias("lines"),
        F.coalesce("own.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        "own.keep",
        "own.words",
    )


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep), a row for each row of ``docs``.

    A text is split at line feeds; a null or empty one is one empty line. Lines are alike
    whose text is, blanks stripped at both ends and A-Z lower-cased. Those of 20 code
    points and more, found under at least three doc_ids, stay only in the largest
    doc_id that holds them, there as often as they stand.

    ``keep`` is a compressed bitmap: (word, bits) for each 64 lines of which any goes, a
    set bit for a line that stays. Lines of words that are not listed stay; null if none
    goes. Repeated rows get the same bitmap. Rows without a doc_id count as one document,
    the smallest. An empty table gives an empty result.
    """
    return _with_bitmaps(docs).select(
        "doc.doc_id", F.size("lines").cast("long").alias("n_lines"), "n_dropped", "keep"
    )


def kept_text(lines: Column, words: Column, text: Column) -> Column:
    """The lines whose bits are set, joined; the text itself where no line goes."""

    def stays(_: Column, at: Column) -> Column:
        word = F.get(words, F.floor(at / WORD_BITS).cast("int"))
        bit = F.call_function("shiftright", word, at % WORD_BITS).bitwiseAND(F.lit(1))
        return F.coalesce(bit, F.lit(1)) == 1

    joined = F.array_join(F.filter(lines, stays), "\n")
    return F.when(words.isNull(), F.coalesce(text, F.lit(""))).otherwise(joined)


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that ``keep_bitmaps`` keeps, and with
    ``n_lines`` and ``n_dropped`` in place of columns of these names."""
    counts = ("n_lines", "n_dropped")
    text = kept_text(F.col("lines"), F.col("words"), F.col("doc.text"))
    return _with_bitmaps(docs).select(
        *(
            text.alias("text") if name == "text" else F.col(f"doc.`{name}`")
            for name in docs.columns
            if name not in counts
        ),
        F.size("lines").cast("long").alias("n_lines"),
        "n_dropped",
    )
