"""SimHash near duplicates by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import components, stored

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3

# Shingles held at once while a text is counted, and members of one side of a unit of
# the trie join; both bound memory and leave the result alone.
SHINGLES_AT_ONCE = 200_000
UNIT_MEMBERS = 2048

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash of the lower-cased (A-Z) word shingles; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
    span = min(SHINGLE_WORDS, len(words))
    end = (start + size)[span - 1 :].tolist()
    start = start[: len(end)].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros((8, 8), np.int64)
    for k in range(0, len(end), SHINGLES_AT_ONCE):
        part = slice(k, k + SHINGLES_AT_ONCE)
        hashes = b"".join(
            [digest(joined[i:j], SEED) for i, j in zip(start[part], end[part])]
        )
        lanes = np.frombuffer(hashes, np.uint8).reshape(-1, 8) + _LANES
        per_byte = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
        ones += per_byte @ _BITS
    packed = np.packbits(2 * ones > len(end), axis=1).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def with_fingerprint(docs: DataFrame, *carried: Column) -> DataFrame:
    """(doc_id, carried columns, fingerprint as a long) of every document."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint).astype("int64")

    return docs.select("doc_id", *carried, hashed("text").alias("fingerprint"))


# The trie join


def linked_pairs(
    group: np.ndarray, key: np.ndarray, side: np.ndarray, top: int, budget: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one group whose keys differ in at most ``budget`` bits.

    ``group`` and ``key`` (unsigned) are sorted together; keys of a group agree above
    bit ``top``. ``side`` 0 marks groups whose members all meet; in the others members
    of side 1 meet those of side 2. Node pairs of the groups' tries are traversed
    together, a level at a time: each holds two ranges of the sorted keys and the bits
    that differ so far, and is dropped once these exceed the budget. Pairs of small
    nodes are finished by comparing their leaves.
    """
    n = len(key)
    order = np.flatnonzero(np.diff(np.concatenate([[-1], group])))
    ends = np.append(order[1:], n)
    lo1, hi1, lo2, hi2 = order, ends, order.copy(), ends.copy()
    err = np.zeros(len(order), np.int64)
    left, right = [], []

    def finish(chosen: np.ndarray) -> None:
        width1 = (hi1 - lo1)[chosen]
        width2 = (hi2 - lo2)[chosen]
        size = width1 * width2
        at = np.repeat(np.arange(len(size)), size)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        i = lo1[chosen][at] + nth // width2[at]
        j = lo2[chosen][at] + nth % width2[at]
        near = (np.bitwise_count(key[i] ^ key[j]) <= budget) & (i < j)
        i, j = i[near], j[near]
        meets = (side[i] == 0) | (side[i] != side[j])
        left.append(i[meets])
        right.append(j[meets])

    for bit in range(top - 1, -2, -1):
        small = (hi1 - lo1) * (hi2 - lo2) <= (64 if bit >= 0 else n * n)
        for part in np.array_split(
            np.flatnonzero(small), max(1, int(small.sum()) // 65536)
        ):
            finish(part)
        rest = ~small
        lo1, hi1, lo2, hi2, err = (x[rest] for x in (lo1, hi1, lo2, hi2, err))
        if not len(lo1) or bit < 0:
            break
        ones = (key >> np.uint64(bit)) & np.uint64(1)
        upto = np.concatenate([[0], np.cumsum(ones.astype(np.int64))])
        mid1 = hi1 - (upto[hi1] - upto[lo1])
        mid2 = hi2 - (upto[hi2] - upto[lo2])
        apart = lo1 != lo2
        low1, low2, high1, high2 = (lo1, mid1), (lo2, mid2), (mid1, hi1), (mid2, hi2)
        every = np.ones(len(lo1), bool)
        pairs = [
            (low1, low2, 0, every),
            (high1, high2, 0, every),
            (low1, high2, 1, every),
            (high1, low2, 1, apart),
        ]
        parts = []
        for one, two, more, chosen in pairs:
            alive = chosen & (one[1] > one[0]) & (two[1] > two[0])
            alive &= err + more <= budget
            parts.append(
                (one[0][alive], one[1][alive], two[0][alive], two[1][alive])
                + (err[alive] + more,)
            )
        lo1, hi1, lo2, hi2, err = (np.concatenate(x) for x in zip(*parts))
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes over the links (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return label


def _join_units(batches: Iterator[pd.DataFrame], top: int, budget: int):
    """Spanning links of the units in a partition sorted by (unit, key)."""

    def joined(units: pd.DataFrame) -> pd.DataFrame:
        group = pd.factorize(units["unit"])[0]
        key = units["key"].to_numpy(np.int64).view(np.uint64)
        order = np.lexsort((key, group))
        group, key = group[order], key[order]
        side = units["side"].to_numpy()[order]
        own = units["fingerprint"].to_numpy()[order]
        a, b = linked_pairs(group, key, side, top, budget)
        label = forest(len(key), a, b)
        child = np.flatnonzero(label != np.arange(len(key)))
        return pd.DataFrame({"a": own[label[child]], "b": own[child]})

    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = held["unit"].iloc[-1] if len(held) else None
        whole = (held["unit"] != last).to_numpy()
        if whole.sum() >= 8192:
            yield joined(held[whole])
            held = held[~whole].reset_index(drop=True)
    if held is not None and len(held):
        yield joined(held)


def fingerprint_links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that span every component of distinct ``fingerprint`` values.

    Two fingerprints that differ in at most ``max_bits`` bits agree in one of
    ``max_bits + 1`` sections of the 64 bits. Each section in turn is rotated to the
    top, where it chooses the trie; the rest of the budget is spent on the traversal
    below it. A trie with more than ``UNIT_MEMBERS`` members is dealt into shares, and
    each pair of shares is a unit of its own, so that no task gathers a large one.
    """
    sections = max_bits + 1
    width = 64 // sections
    rows = []
    for k in range(sections):
        turn = k * width
        turned = (
            F.col("fingerprint")
            if not turn
            else F.shiftleft("fingerprint", turn).bitwiseOR(
                F.shiftrightunsigned("fingerprint", 64 - turn)
            )
        )
        rows.append(F.struct(F.lit(k).alias("section"), turned.alias("key")))
    turned = fingerprints.select("fingerprint", F.explode(F.array(*rows)).alias("t"))
    turned = turned.select(
        "fingerprint",
        "t.section",
        "t.key",
        F.shiftrightunsigned("t.key", 64 - width).alias("prefix"),
    )
    large = (
        turned.groupBy("section", "prefix")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > UNIT_MEMBERS)
        .select("section", "prefix", F.ceil(F.col("n") / UNIT_MEMBERS).alias("shares"))
    )
    shared = turned.join(large, ["section", "prefix"], "left").withColumn(
        "share",
        F.pmod(F.xxhash64("fingerprint"), F.coalesce("shares", F.lit(1))).cast("int"),
    )
    other = F.explode(
        F.sequence(F.lit(0), (F.coalesce("shares", F.lit(1)) - 1).cast("int"))
    )
    units = shared.withColumn("other", other).select(
        F.xxhash64(
            "section", "prefix", F.least("share", "other"), F.greatest("share", "other")
        ).alias("unit"),
        F.when(F.col("share") == F.col("other"), 0)
        .when(F.col("share") < F.col("other"), 1)
        .otherwise(2)
        .alias("side"),
        "key",
        "fingerprint",
    )
    top = 64 - width
    return (
        units.repartition("unit")
        .sortWithinPartitions("unit", "key")
        .mapInPandas(lambda it: _join_units(it, top, max_bits), "a long, b long")
    )


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id), a row for each document.

    Documents link when their fingerprints differ in at most ``max_bits`` bits; the
    component is the smallest doc_id reachable. A null, empty or blank text has the
    fingerprint zero, which links like any other. Repeated rows stay repeated, a
    missing doc_id stays missing and is never the smallest, other columns are ignored
    and an empty table gives an empty result. Equal fingerprints are joined as one, so
    that thousands of copies cost as much as one document.
    """
    rows = stored(with_fingerprint(docs), "fingerprints")
    return _in_components(rows, max_bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _in_components(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (doc_id, fingerprint, others) with their ``component_id`` and ``root``, the
    component's smallest fingerprint, which no other component has."""
    distinct = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct"
    )
    labels = components(fingerprint_links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(
        labels.withColumnRenamed("id", "fingerprint"), "fingerprint", "left"
    )
    roots = (
        rooted.filter(F.col("component").isNotNull())
        .groupBy("component")
        .agg(F.min("first_id").alias("root_id"))
    )
    per_value = rooted.join(roots, "component", "left").select(
        "fingerprint",
        F.coalesce("component", "fingerprint").alias("root"),
        F.when(F.col("component").isNull(), F.col("first_id"))
        .otherwise(F.col("root_id"))
        .alias("component_id"),
    )
    return rows.join(per_value, "fingerprint")


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, in the columns of ``docs``: that of the smallest
    doc_id.

    A row is told by its doc_id and its text, so of several texts under one doc_id each is
    kept or goes with its own component; where a component has more than one under its
    smallest doc_id, a hash of the text decides. Of rows that repeat both, one stays.
    Rows without a doc_id all stay: nothing names them. An empty table gives an empty
    result.
    """
    own = F.xxhash64("doc_id", "text").alias("row")
    rows = stored(with_fingerprint(docs, own), "fingerprints")
    chosen = (
        _in_components(rows.filter(F.col("doc_id").isNotNull()), max_bits)
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "row")).alias("first"))
        .select("first.doc_id", "first.row")
    )
    same = (F.col("d.doc_id") == F.col("c.doc_id")) & (
        F.xxhash64("d.doc_id", "d.text") == F.col("c.row")
    )
    kept = docs.alias("d").join(chosen.alias("c"), same, "left_semi")
    unnamed = docs.filter(F.col("doc_id").isNull())
    return kept.dropDuplicates(["doc_id", "text"]).unionByName(unnamed)
