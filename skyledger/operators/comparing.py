"""What two reads of a table, rows told apart by a key, do not have in common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ONLY_LEFT, ONLY_RIGHT, DIFFERS = "only left", "only right", "differs"


def _text(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(column) if nested else column.cast("string")


def unmatched(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of either side that the other has not, or has less often, with ``n_left``
    and ``n_right``, how much more often. Nulls are equal to nulls.

    One aggregate over both sides: rows that agree are reduced in the tasks that read
    them and again where they meet, and nothing of them is left.
    """
    sides = left.withColumns({"n_left": F.lit(1), "n_right": F.lit(0)}).unionByName(
        right.withColumns({"n_left": F.lit(0), "n_right": F.lit(1)})
    )
    more = F.sum("n_left") - F.sum("n_right")
    return (
        sides.groupBy(*(f"`{name}`" for name in left.columns))
        .agg(more.alias("more"))
        .filter("more <> 0")
        .select(
            *(f"`{name}`" for name in left.columns),
            F.greatest("more", F.lit(0)).alias("n_left"),
            F.greatest(-F.col("more"), F.lit(0)).alias("n_right"),
        )
    )


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(kind, column, n): rows only one side has, and per column how many differ.

    ``keys`` tell which rows belong together; both sides have the same columns. Rows that
    agree in every column are matched first, as often as both sides have them. What is
    left of a key is matched by number, and rows beyond that are "only left" or "only
    right". A column "differs" in as many matched rows as there are, less those for which
    both sides have a value in common, however rows of one key are paired. Kinds and
    columns without a difference have no row. Nulls, in keys too, are equal to nulls.

    The rows are shuffled once, in an aggregate. Only rows that differ go on, and all that
    follows are sums per key and value: no task gathers a key that repeats.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("both sides must have the same columns")
    others = [field for field in left.schema if field.name not in keys]
    rest = unmatched(left, right)
    key = [f"`{name}`" for name in keys]
    sums = (F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    more = F.col("n_left") - F.col("n_right")
    sides = (
        rest.groupBy(*key)
        .agg(*sums)
        .select(
            F.explode(
                F.array(
                    F.struct(F.lit(ONLY_LEFT).alias("kind"), more.alias("n")),
                    F.struct(F.lit(ONLY_RIGHT).alias("kind"), (-more).alias("n")),
                )
            ).alias("side")
        )
        .select("side.kind", F.lit(None).cast("string").alias("column"), "side.n")
        .filter("n > 0")
    )
    result = sides
    if others:
        values = F.explode(
            F.array(
                *(
                    F.struct(F.lit(f.name).alias("column"), _text(f).alias("value"))
                    for f in others
                )
            )
        ).alias("cell")
        common = F.least("n_left", "n_right")
        columns = (
            rest.select(*key, "n_left", "n_right", values)
            .groupBy(*key, "cell.column", "cell.value")
            .agg(*sums)
            .groupBy(*key, "column")
            .agg(*sums, F.sum(common).alias("common"))
            .select(
                F.lit(DIFFERS).alias("kind"), "column", (common - F.col("common")).alias("n")
            )
            .filter("n > 0")
        )
        result = sides.unionByName(columns)
    return result.groupBy("kind", "column").agg(F.sum("n").cast("long").alias("n"))
