"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

ORDER = 4

# Models of so many counted sequences, and so many sequences times languages, at most are
# sent to every task. Larger ones stay tables, joined to the texts' sequences. Both keep
# all sequences of all languages and score alike.
MODEL_SEQUENCES = 400_000
MODEL_CELLS = 4_000_000

# Texts as unlike their language as this many standard deviations of texts of their
# length, and this many nats per character at least, are rejected. Foreign text costs
# more than that; text that changes language or repeats itself does not.
REJECT_DEVIATIONS = 8.0
REJECT_NATS = 1.0

# Characters of whole documents handled together; bounds memory, not the result.
CHARS_AT_ONCE = 1_000_000

# How fast the score goes to 1 with the difference in nats per character.
SHARPNESS = 10.0

_U = np.uint64
_K = _U(0x9E3779B97F4A7C15)


@cache
def _alphabet() -> np.ndarray:
    """Letters to their lower case, everything else to a space, by code point."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters of a text; one space for all between, before and after."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.concatenate([[32], _alphabet()[raw], [32]]).astype(np.uint32)
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 32) | (found[:-1] != 32)
    return found[keep]


def _hashes(points: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place from ``order`` - 1 on."""
    n = len(points) - order + 1
    value = np.zeros(max(n, 0), _U)
    for k in range(order):
        value = (value ^ points[k : k + n].astype(_U)) * _K
        value ^= value >> _U(29)
    return value


# Counting


def _some_texts(
    column: pa.Array, chars: int = CHARS_AT_ONCE
) -> Iterator[tuple[int, list[np.ndarray]]]:
    held, size, begin = [], 0, 0
    for row, text in enumerate(column):
        held.append(letters(text.as_py()))
        size += len(held[-1])
        if size >= chars:
            yield begin, held
            held, size, begin = [], 0, row + 1
    if held:
        yield begin, held


def _sequence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the character sequences of each language in a batch."""
    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        for begin, texts in _some_texts(batch.column("text")):
            here = langs[begin : begin + len(texts)]
            for lang in np.unique(here.astype(str)):
                # Blanks between texts keep a sequence from running over two of them.
                gap = np.zeros(ORDER, np.uint32)
                own = [x for t, l in zip(texts, here) if l == lang for x in (t, gap)]
                points = np.concatenate(own)
                value = _hashes(points, ORDER)
                start = np.flatnonzero(
                    np.lib.stride_tricks.sliding_window_view(points, ORDER).all(axis=1)
                )
                value, first, count = np.unique(
                    value[start], return_index=True, return_counts=True
                )
                at = start[first][:, None] + np.arange(ORDER)
                raw = points[at].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                sequences = [raw[k : k + ORDER] for k in range(0, len(raw), ORDER)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(count), pa.string()),
                        "sequence": pa.array(sequences, pa.string()),
                        "n": pa.array(count, pa.int64()),
                    }
                )


class Model:
    """Log-probabilities of all languages in arrays sorted by the hash of a sequence."""

    def __init__(self, langs: list[str], rows: list[tuple[str, int, int]]) -> None:
        """``rows``: a sequence of ``ORDER`` characters, the language's number, a count."""
        self.langs = langs
        width = len(langs)
        tables: dict[int, dict[str, np.ndarray]] = {k: {} for k in range(1, ORDER + 1)}
        for sequence, lang, n in rows:
            tables[ORDER].setdefault(sequence, np.zeros(width))[lang] += n
        # Lower orders count in how many contexts a sequence is seen, not how often.
        for k in range(ORDER, 1, -1):
            for sequence, counts in tables[k].items():
                shorter = tables[k - 1].setdefault(sequence[1:], np.zeros(width))
                shorter += counts > 0
        self.keys, self.logs, self.context_keys, self.context_logs = {}, {}, {}, {}
        lower: dict[str, np.ndarray] = {}
        alphabet = max(2, len(tables[1]))
        for k in range(1, ORDER + 1):
            names = list(tables[k])
            counts = np.array([tables[k][s] for s in names]).reshape(len(names), width)
            once, twice = (counts == 1).sum(0), (counts == 2).sum(0)
            discount = np.where(once > 0, once / np.maximum(1, once + 2 * twice), 0.5)
            contexts: dict[str, int] = {}
            at = np.array(
                [contexts.setdefault(s[:-1], len(contexts)) for s in names], np.int64
            )
            total = np.zeros((max(1, len(contexts)), width))
            kinds = np.zeros_like(total)
            np.add.at(total, at, counts)
            np.add.at(kinds, at, counts > 0)
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            below = (
                np.full((len(names), width), 1.0 / alphabet)
                if k == 1
                else np.array([lower[s[1:]] for s in names]).reshape(len(names), width)
            )
            share = np.maximum(counts - discount, 0) / np.maximum(total, 1)[at]
            value = share + weight[at] * below
            lower = dict(zip(names, value))
            self.keys[k], self.logs[k] = self._sorted(names, value, k)
            self.context_keys[k], self.context_logs[k] = self._sorted(
                list(contexts), weight[: len(contexts)], k - 1
            )
        self.floor = float(np.log(0.5 / alphabet))

    @staticmethod
    def _sorted(names: list[str], value: np.ndarray, order: int):
        points = np.frombuffer(
            "".join(names).encode("utf-32-le", "surrogatepass"), np.uint32
        ).reshape(len(names), order)
        key = np.zeros(len(names), _U)
        for k in range(order):
            key = (key ^ points[:, k].astype(_U)) * _K
            key ^= key >> _U(29)
        at = np.argsort(key)
        return key[at], np.log(value[at]).astype(np.float32)

    def _find(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def logs_at(self, points: np.ndarray) -> np.ndarray:
        """Log-probability of each character from the ``ORDER``-th on, by language."""
        n = len(points) - ORDER + 1
        out = np.zeros((n, len(self.langs)), np.float32)
        open_ = np.arange(n)
        for k in range(ORDER, 0, -1):
            # ``open_`` have no entry of a higher order; ``out`` has their weights.
            ends = open_ + ORDER
            window = np.stack([points[ends - k + j] for j in range(k)]) if k else None
            key = np.zeros(len(open_), _U)
            context = key
            for j in range(k):
                context = key
                key = (key ^ window[j].astype(_U)) * _K
                key ^= key >> _U(29)
            at, found = self._find(self.keys[k], key)
            out[open_[found]] += self.logs[k][at[found]]
            open_ = open_[~found]
            if not len(open_):
                return out
            at, seen = self._find(self.context_keys[k], context[~found])
            out[open_[seen]] += self.context_logs[k][at[seen]]
        out[open_] += self.floor
        return out


def _counted(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(lang, sequence, n) of all sequences of (lang, text), and all languages in order."""
    langs = sorted(row["lang"] for row in docs.select("lang").distinct().collect())
    counted = (
        docs.select("lang", "text")
        .mapInArrow(_sequence_rows, "lang string, sequence string, n long")
        .groupBy("lang", "sequence")
        .agg(F.sum("n").alias("n"))
    )
    return stored(counted, "language-counts"), langs


def _model(counted: DataFrame, langs: list[str]) -> Model:
    numbers = {lang: k for k, lang in enumerate(langs)}
    found = counted.toArrow().to_pydict()
    rows = zip(found["sequence"], (numbers[x] for x in found["lang"]), found["n"])
    return Model(langs, list(rows))


# Scoring


def _scores(shared: Broadcast):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            chars = CHARS_AT_ONCE * 4 // max(4, len(model.langs))
            for begin, texts in _some_texts(batch.column("text"), chars):
                size = np.array([len(t) for t in texts])
                # Every text begins with blanks, so that each of its letters is scored.
                pad = np.full(ORDER - 1, 32, np.uint32)
                points = np.concatenate([x for t in texts for x in (pad, t)])
                logs = model.logs_at(points) if model.langs else None
                n_letters = size - 2
                best, entropy, score = [], [], []
                first = np.cumsum(size + ORDER - 1) - size - (ORDER - 1)
                for start, n in zip(first, size):
                    if logs is None or n <= 2:
                        best.append("und"), entropy.append(None), score.append(0.0)
                        continue
                    # From the first letter to the blank that ends the text.
                    mean = -logs[start + 1 : start + n].mean(axis=0, dtype=np.float64)
                    k = int(mean.argmin())
                    share = np.exp(-SHARPNESS * (mean - mean[k]))
                    best.append(model.langs[k])
                    entropy.append(float(mean[k]))
                    score.append(float(share[k] / share.sum()))
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "key": part.column("key"),
                        "held_out": part.column("held_out"),
                        "taught": part.column("taught"),
                        "lang_pred": pa.array(best, pa.string()),
                        "score": pa.array(score, pa.float64()),
                        "entropy": pa.array(entropy, pa.float64()),
                        "n_letters": pa.array(np.maximum(n_letters, 0), pa.int64()),
                    }
                )

    return rows


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of letters and the counted sequences of each text."""
    for batch in batches:
        for begin, texts in _some_texts(batch.column("text")):
            grams = []
            for text in texts:
                points = np.concatenate([np.full(ORDER - 1, 32, np.uint32), text])
                raw = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                ends = range(1, len(text)) if len(text) > 2 else ()
                grams.append(list(Counter(raw[k : k + ORDER] for k in ends).items()))
            part = batch.slice(begin, len(texts))
            n_letters = [max(0, len(t) - 2) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    **{name: part.column(name) for name in ("doc_id", "key", "held_out", "taught")},
                    "n_letters": pa.array(n_letters, pa.int64()),
                    "grams": pa.array(
                        [[{"sequence": s, "n": n} for s, n in g] for g in grams],
                        pa.list_(pa.struct([("sequence", pa.string()), ("n", pa.int64())])),
                    ),
                }
            )


def _logs(rows: DataFrame, name: str, value: str) -> DataFrame:
    """(name, logs): the logarithms of ``value`` in order of the languages."""
    pairs = F.array_sort(F.collect_list(F.struct("number", F.log(value).alias("log"))))
    return rows.groupBy(name).agg(F.transform(pairs, lambda p: p["log"]).alias("logs"))


def _tables(counted: DataFrame, langs: DataFrame) -> tuple[dict, dict, float]:
    """Per order: (sequence, logs) and (context, logs) of what any language has, as
    ``Model`` has them, from aggregates and joins; and the floor."""
    orders = {ORDER: counted}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.substring("sequence", 2, k).alias("sequence")
        orders[k] = stored(
            orders[k + 1].groupBy("lang", shorter).agg(F.count(F.lit(1)).alias("n")), f"order-{k}"
        )
    alphabet = max(2, orders[1].select("sequence").distinct().count())
    values, contexts, lower = {}, {}, None
    for k in range(1, ORDER + 1):
        own = orders[k].withColumn("context", F.substring("sequence", 1, k - 1))
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = F.when(once > 0, once / (once + 2 * twice)).otherwise(0.5)
        all_langs = langs.join(own.groupBy("lang").agg(discount.alias("discount")), "lang", "left")
        all_langs = F.broadcast(all_langs.fillna(0.5, ["discount"]))
        totals = own.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")
        )
        weight = F.coalesce(F.col("discount") * F.col("kinds") / F.col("total"), F.lit(1.0))
        weights = stored(
            own.select("context")
            .distinct()
            .crossJoin(all_langs)
            .join(totals, ["lang", "context"], "left")
            .select("lang", "number", "context", "discount", "total", weight.alias("weight")),
            f"weights-{k}",
        )
        dense = (
            own.select("sequence", "context")
            .distinct()
            .join(weights, "context")
            .join(own.select("lang", "sequence", "n"), ["lang", "sequence"], "left")
            .withColumn("shorter", F.substring("sequence", 2, k))
        )
        if lower is None:
            dense = dense.withColumn("below", F.lit(1.0 / alphabet))
        else:
            below = lower.select("lang", F.col("sequence").alias("shorter"), F.col("value").alias("below"))
            dense = dense.join(below, ["lang", "shorter"])
        share = F.greatest(F.coalesce("n", F.lit(0)) - F.col("discount"), F.lit(0.0)) / F.greatest(
            F.coalesce("total", F.lit(0)), F.lit(1)
        )
        value = share + F.col("weight") * F.col("below")
        lower = stored(dense.select("lang", "number", "sequence", value.alias("value")), f"values-{k}")
        values[k] = _logs(lower, "sequence", "value")
        contexts[k] = _logs(weights, "context", "weight")
    return values, contexts, math.log(0.5 / alphabet)


def _joined_scores(docs: DataFrame, counted: DataFrame, names: list[str]) -> DataFrame:
    """What ``_scores`` gives, by joining the texts' sequences to tables of any size."""
    spark = docs.sparkSession
    langs = spark.createDataFrame(list(zip(names, range(len(names)))), "lang string, number int")
    schema = (
        "doc_id long, key long, held_out boolean, taught string, n_letters long, "
        "grams array<struct<sequence:string,n:long>>"
    )
    texts = stored(docs.mapInArrow(_text_rows, schema), "language-sequences")
    # Rows alike in key add alike to sums and numbers; the mean is the same.
    grams = texts.select("key", F.inline("grams"))
    values, contexts, floor = _tables(counted, langs)
    wanted = stored(grams.select("sequence").distinct(), "wanted")
    logs = F.array_repeat(F.lit(floor), len(names))

    def added(a: Column, b: Column) -> Column:
        return F.coalesce(F.zip_with(a, b, lambda x, y: x + y), a)

    for k in range(1, ORDER + 1):
        found = values[k].select(F.col("sequence").alias("suffix"), F.col("logs").alias("found"))
        seen = contexts[k].select("context", F.col("logs").alias("seen"))
        wanted = (
            wanted.withColumn("logs", logs)
            .withColumn("suffix", F.substring("sequence", ORDER + 1 - k, k))
            .withColumn("context", F.substring("sequence", ORDER + 1 - k, k - 1))
            .join(found, "suffix", "left")
            .join(seen, "context", "left")
            .select("sequence", F.coalesce("found", added(F.col("logs"), F.col("seen"))).alias("logs"))
        )
        logs = F.col("logs")
    # Adaptive execution splits the partitions of frequent sequences.
    means = (
        grams.join(stored(wanted, "sequence-logs"), "sequence")
        .select("key", "n", F.posexplode("logs").alias("number", "log"))
        .groupBy("key", "number")
        .agg((-F.sum(F.col("n") * F.col("log")) / F.sum("n")).alias("mean"))
    )
    by_mean = F.array_sort(F.collect_list(F.struct("mean", "number")))
    share = F.aggregate(
        "means",
        F.lit(0.0),
        lambda total, m: total + F.exp(-SHARPNESS * (m["mean"] - F.col("entropy"))),
    )
    best = (
        means.groupBy("key")
        .agg(by_mean.alias("means"))
        .withColumn("entropy", F.get("means", F.lit(0))["mean"])
        .select("key", F.get("means", F.lit(0))["number"].alias("number"), "entropy", (1 / share).alias("score"))
        .join(F.broadcast(langs.withColumnRenamed("lang", "lang_pred")), "number")
    )
    return texts.drop("grams").join(best, "key", "left").select(
        "doc_id",
        "key",
        "held_out",
        "taught",
        F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "entropy",
        "n_letters",
    )


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, key, held_out, lang_pred, score, entropy, n_letters, rejected).

    One model per value of ``lang`` learns the sequences of ``ORDER`` letters of all
    texts with a lang whose crc32(doc_id) modulo 4 is not 2; lower orders follow from
    them (interpolated Kneser-Ney). A text gets the language of the lowest cross-entropy
    per character; ``score`` is that language's share, from 0 to 1. ``rejected`` marks
    texts without letters and those whose cross-entropy lies ``REJECT_DEVIATIONS``
    standard deviations and ``REJECT_NATS`` above the mean of the texts of that language
    and about that length that were learned from (of any length, where there are none),
    so that ordinary texts of any length stay.

    A null text or one without a letter is ``und`` with the score 0, as is every text if
    no text can be learned from. Without a doc_id a row is neither held out nor learned
    from. Repeated rows stay repeated (``key``, a hash of doc_id and text, is theirs in
    common); other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(remainder == 2, F.lit(False))
    learned = docs.filter(
        (remainder != 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("lang", "text")
    counted, langs = _counted(learned)
    size = counted.agg(F.count(F.lit(1)), F.count_distinct("sequence")).first()
    schema = (
        "doc_id long, key long, held_out boolean, taught string, lang_pred string, "
        "score double, entropy double, n_letters long"
    )
    texts = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("key"),
        held_out.alias("held_out"),
        # Only for the calibration below: the lang of texts that were learned from.
        F.when(remainder != 2, F.col("lang")).alias("taught"),
        "text",
    )
    if size[0] <= MODEL_SEQUENCES and size[1] * len(langs) <= MODEL_CELLS:
        shared = spark.sparkContext.broadcast(_model(counted, langs))
        scored = texts.mapInArrow(_scores(shared), schema)
    else:
        scored = _joined_scores(texts, counted, langs)
    scored = stored(scored, "language-scores")
    length = F.floor(F.log2(F.col("n_letters") + 1)).cast("int")
    moments = [
        F.count("entropy").alias("n"),
        F.sum("entropy").alias("total"),
        F.sum(F.col("entropy") * F.col("entropy")).alias("squares"),
    ]
    # At most a row for each language and power of two, then for each language.
    by_length = (
        scored.filter(F.col("taught") == F.col("lang_pred"))
        .groupBy("lang_pred", length.alias("length"))
        .agg(*moments)
    )

    def limit(n: str, total: str, squares: str) -> Column:
        mean = F.col(total) / F.col(n)
        variance = F.greatest(F.col(squares) / F.col(n) - mean * mean, F.lit(0.0))
        return mean + F.greatest(REJECT_DEVIATIONS * F.sqrt(variance), F.lit(REJECT_NATS))

    whole = (
        by_length.groupBy("lang_pred")
        .agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares")))
        .select("lang_pred", limit("n", "total", "squares").alias("any_length"))
    )
    near = by_length.select(
        "lang_pred", "length", limit("n", "total", "squares").alias("this_length")
    )
    usual = F.coalesce("this_length", "any_length")
    return (
        scored.withColumn("length", length)
        .join(F.broadcast(near), ["lang_pred", "length"], "left")
        .join(F.broadcast(whole), "lang_pred", "left")
        .select(
            "doc_id",
            "key",
            "held_out",
            "lang_pred",
            "score",
            "entropy",
            "n_letters",
            (F.col("entropy").isNull() | F.coalesce(F.col("entropy") > usual, F.lit(False)))
            .alias("rejected"),
        )
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised, in the columns of ``docs``.

    Null and blank texts and those without a letter go, rows that repeat go or stay
    together, and an empty table stays empty; what else goes is told by ``identify``.
    """
    rejected = identify(docs).filter("rejected").select(F.col("key").alias("no")).distinct()
    key = F.xxhash64(docs["doc_id"], docs["text"])
    return docs.join(rejected, key == rejected["no"], "left_anti")
