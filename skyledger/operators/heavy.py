"""Every key that holds more than a share of the rows, without shuffling all keys."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Counters of a task for each key that could hold the share; more make fewer candidates.
COUNTERS = 4

# What a task's row tells: the count of a key, its number of rows, its error.
COUNTED, SEEN, ERROR = range(3)


def _summaries(rows: DataFrame, counters: int) -> DataFrame:
    """(kind, key, n): at most ``counters`` counts of each task, none too high and none
    lower than the truth by more than the task's error; its rows and error, negative.

    Each batch's counts are added; when they are too many, the first that is over is
    subtracted from all.
    """

    # Inside, so that executors get it as it is and need not have this package.
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, seen, error = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            seen += batch.num_rows
            ones = pa.table(
                {"key": batch.column(0), "n": pa.array([1] * batch.num_rows, pa.int64())}
            )
            parts = [ones] if kept is None else [kept, ones]
            kept = pa.concat_tables(parts).group_by("key").aggregate([("n", "sum")])
            kept = pa.table({"key": kept.column("key"), "n": kept.column("n_sum")})
            if kept.num_rows > counters:
                order = pc.sort_indices(kept, sort_keys=[("n", "descending")])
                least = kept.column("n")[order[counters].as_py()].as_py()
                error += least
                kept = kept.filter(pc.greater(kept.column("n"), least))
                kept = pa.table(
                    {"key": kept.column("key"), "n": pc.subtract(kept.column("n"), least)}
                )
        if kept is None:
            return
        key = kept.column("key").combine_chunks()
        parts = [(COUNTED, key, kept.column("n").combine_chunks())]
        for kind, total in ((SEEN, seen), (ERROR, error)):
            if total:
                parts.append((kind, pa.array([None], key.type), pa.array([-total], pa.int64())))
        for kind, own, n in parts:
            kinds = pa.array([kind] * len(own), pa.int32())
            yield pa.RecordBatch.from_arrays([kinds, own, n], names=["kind", "key", "n"])

    return rows.mapInArrow(
        counted,
        T.StructType(
            [
                T.StructField("kind", T.IntegerType()),
                T.StructField("key", rows.schema[0].dataType),
                T.StructField("n", T.LongType()),
            ]
        ),
    )


def candidates(df: DataFrame, key: str, share: float, counters: int = COUNTERS) -> DataFrame:
    """(key, rows): every value of ``key`` that may hold more than ``share`` of the rows,
    and the number of rows in all. All that do are there, and few others: fewer than
    ``counters / (counters - 1) / share`` values in all, whatever the data."""
    if not 0 < share < 1:
        raise ValueError(f"share must be between 0 and 1, got {share}")
    summaries = _summaries(df.select(F.col(key).alias("key")), math.ceil(counters / share))
    per_key = summaries.groupBy(F.struct("kind", "key").alias("of")).agg(F.sum("n").alias("n"))
    # Told apart by the sign of their sums, so that both sides read one shuffle.
    kind = F.col("of.kind")
    totals = per_key.filter("n < 0").agg(
        F.sum(F.when(kind == SEEN, -F.col("n"))).alias("rows"),
        F.coalesce(F.sum(F.when(kind == ERROR, -F.col("n"))), F.lit(0)).alias("missed"),
    )
    possible = F.col("n") + F.col("missed") > F.col("rows") * share
    return (
        per_key.filter("n > 0")
        .join(F.broadcast(totals), possible)
        .select(F.col("of.key").alias("key"), "rows")
    )


def heavy_hitters(
    df: DataFrame, key: str, share: float, counters: int = COUNTERS
) -> DataFrame:
    """(``key``, n): every value, null too, that more than ``share`` of the rows have, and
    how many have it.

    A first pass keeps a bounded number of counters in each task, which are added up to
    find the candidates; a second counts the candidates, and these alone, exactly. Both
    read one column. What is shuffled is bounded by the tasks and the share, never by
    the number of keys.
    """
    found = candidates(df, key, share, counters).withColumnRenamed("key", "candidate")
    return (
        df.select(key)
        .join(F.broadcast(found), F.col(key).eqNullSafe(F.col("candidate")))
        .groupBy(key, "rows")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > F.col("rows") * share)
        .select(key, "n")
    )
