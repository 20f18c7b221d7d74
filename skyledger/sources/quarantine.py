"""CSV loads that set malformed lines aside instead of losing or bending them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that tell of a rejected line; null in accepted rows.
LINE, FILE, REASON = "reject_line", "reject_file", "reject_reason"
REJECT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (LINE, FILE, REASON)])
REJECTED = "rejected"

SURPLUS, OPEN_QUOTE, MISSING, VALUE = (
    "fields surplus",
    "open quote",
    "fields missing",
    "value of",
)

# A quoted part of a line, with Spark's default quote and escape.
QUOTED = r'"(?:[^"\\]|\\.)*"'


class Load(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def _reason(schema: T.StructType) -> Column:
    line = F.col(LINE)
    bare = F.regexp_replace(line, QUOTED, "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    texts = F.from_csv(line, ", ".join(f"`{name}` string" for name in schema.names))
    unfit = F.array_compact(
        F.array(
            *(
                F.when(texts[name].isNotNull() & F.col(f"`{name}`").isNull(), F.lit(name))
                for name in schema.names
            )
        )
    )
    return (
        F.when(fields > len(schema), F.lit(SURPLUS))
        .when(F.contains(bare, F.lit('"')), F.lit(OPEN_QUOTE))
        .when(fields < len(schema), F.lit(MISSING))
        .otherwise(F.concat_ws(" ", F.lit(VALUE), F.array_join(unfit, ", ")))
    )


def read_judged(
    spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True
) -> DataFrame:
    """Every line of ``path``: the columns of ``schema``, or why the line does not fit.

    A line is rejected for surplus or missing fields, a quote that is not closed, or
    values that their columns' types cannot hold. Its own columns are then null and
    ``reject_line``, ``reject_file`` and ``reject_reason`` tell of it. Empty fields are
    null and no fault. Blank lines are skipped.
    """
    # The parser only notices a wrong number of fields when it parses whole lines.
    reader = (
        spark.read.schema(T.StructType([*schema, REJECT_SCHEMA[LINE]]))
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)
    )
    if header:
        reader = reader.option("enforceSchema", False)
    lines = reader.csv(path)
    # Paths come encoded, but for plus signs.
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    bad = F.col(LINE).isNotNull()
    return lines.select(
        *(F.when(~bad, F.col(f"`{name}`")).alias(name) for name in schema.names),
        LINE,
        F.when(bad, file).alias(FILE),
        F.when(bad, _reason(schema)).alias(REASON),
    )


def load_csv(
    spark: SparkSession,
    path: str,
    out: str,
    schema: T.StructType,
    *,
    header: bool = True,
) -> Load:
    """Loads CSV files into Parquet at ``out``, accepted rows and rejected lines apart.

    One scan and no shuffle: each task writes what it accepts and what it rejects into
    the two directories of the table.
    """
    judged = read_judged(spark, path, schema, header=header)
    judged.withColumn(REJECTED, F.col(REASON).isNotNull()).write.partitionBy(
        REJECTED
    ).parquet(out)
    return read_load(spark, out, schema)


def read_load(spark: SparkSession, out: str, schema: T.StructType) -> Load:
    """What ``load_csv`` wrote at ``out``; each side reads its own directory."""
    flag = T.StructField(REJECTED, T.BooleanType())
    stored = spark.read.schema(T.StructType([*schema, *REJECT_SCHEMA, flag])).parquet(out)
    return Load(
        stored.filter(~F.col(REJECTED)).select(*(f"`{name}`" for name in schema.names)),
        stored.filter(F.col(REJECTED)).select(*REJECT_SCHEMA.names),
    )


def rejects_by_reason(load: Load) -> DataFrame:
    """(reason, n): rejected lines per reason, and the accepted rows."""
    rejected = load.rejected.groupBy(F.col(REASON).alias("reason"))
    accepted = load.accepted.groupBy(F.lit("accepted").alias("reason"))
    count = F.count(F.lit(1)).alias("n")
    return rejected.agg(count).unionByName(accepted.agg(count))
