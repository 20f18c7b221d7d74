"""Partitioned tables kept up to date: a load rewrites only the directories it changes.

A load is staged whole beside the table, with the table's new manifest, before any
directory is replaced. Publishing it can be repeated, so a load that is lost half-way
is finished by the next one, or forgotten if its staging was not complete.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources import files, layouts, schemas
from skyledger.sources.layouts import ROWS_PER_FILE, YEAR_CARRIER

# Folders beside the directories of a table; reads of the table do not see them.
MANIFEST, STAGING = "_manifest", "_staging"

DAY = "flight_date"

# Shuffle partitions before adaptive execution merges small ones, and Spark's name for
# them: an aggregate's partition cannot be split, so its memory would grow with the data.
PARTITIONS = 200
PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def _many_partitions(spark: SparkSession) -> Iterator[None]:
    """At least ``PARTITIONS`` for the shuffles of the jobs in it, merged where small."""
    before = spark.conf.get(PARTITIONS_CONF, None)
    session = before or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(PARTITIONS_CONF, str(max(PARTITIONS, int(session))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PARTITIONS_CONF)
        else:
            spark.conf.set(PARTITIONS_CONF, before)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b,
        (F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in keys),
    )


def _only(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of ``rows`` with ("left_semi") or without ("left_anti") their keys in ``other``."""
    return rows.alias("l").join(other.alias("r"), _same("l", "r", keys), how)


def manifest_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and a checksum that does not depend on their order, per directory and day."""
    columns = sorted(set(rows.columns) - {*keys, DAY})
    whole = F.xxhash64(*columns).cast("decimal(20,0)")
    return rows.groupBy(*keys, DAY).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(whole).alias("checksum")
    )


def _manifest_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    types = {field.name: field for field in schema}
    return T.StructType(
        [
            *(types[key] for key in [*keys, DAY]),
            T.StructField("rows", T.LongType()),
            T.StructField("checksum", T.DecimalType(30, 0)),
        ]
    )


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name) for name in files.names(spark, f"{root}/{MANIFEST}"))


def read_manifest(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """What the table holds, as of its last load; empty before the first."""
    versions = _versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{MANIFEST}/{versions[-1]}")


def _directory(spark: SparkSession, root: str, keys: Sequence[str], values: Sequence) -> str:
    """The directory of these keys, named as Spark's writers name it."""
    named = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = (
        named.getPartitionPathString(key, None if value is None else str(value))
        for key, value in zip(keys, values)
    )
    return "/".join([root, *parts])


def _without_blank(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with blank keys null, as a directory's name holds both alike."""
    texts = [f.name for f in rows.schema if f.name in keys and f.dataType == T.StringType()]
    return rows.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in texts})


def _publish(spark: SparkSession, staged: str, root: str, keys: Sequence[str]) -> None:
    """Moves the staged directories into the table, in place of those of the same keys.

    One that is no longer staged was moved before, so a lost publishing can be repeated.
    The driver holds one level's names at a time, as Spark's overwrite does all.
    """
    for name in files.names(spark, staged):
        if not name.startswith(f"{keys[0]}="):
            continue
        if len(keys) > 1:
            _publish(spark, f"{staged}/{name}", f"{root}/{name}", keys[1:])
        else:
            files.remove(spark, f"{root}/{name}")
            files.move(spark, f"{staged}/{name}", f"{root}/{name}")


def finish(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str]) -> bool:
    """Publishes a load that is staged whole; removes one that is not. Tells which."""
    staged = f"{root}/{STAGING}"
    if not files.exists(spark, f"{staged}/manifest/_SUCCESS"):
        files.remove(spark, staged)
        return False
    # Directories that lose their last row; at most those that the load touches.
    emptied = spark.read.schema(_keys(schema, keys)).parquet(f"{staged}/emptied")
    for row in emptied.toLocalIterator():
        files.remove(spark, _directory(spark, root, keys, row))
    _publish(spark, f"{staged}/rows", root, keys)
    version = max(_versions(spark, root), default=0) + 1
    files.move(spark, f"{staged}/manifest", f"{root}/{MANIFEST}/{version}")
    files.remove(spark, staged)
    return True


def _keys(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    return T.StructType([schema[key] for key in keys])


def _held_in(table: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``table`` in the directories ``touched``; no other year or country is
    listed or read. The driver holds these first keys as it holds a table's directories."""
    first = keys[0]
    values = [row[0] for row in touched.select(first).distinct().collect()]
    wanted = F.col(first).isin([value for value in values if value is not None])
    if None in values:
        wanted = wanted | F.col(first).isNull()
    return _only(table.filter(wanted), touched, keys, "left_semi")


def _load(
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    rows: DataFrame,
    touched: DataFrame,
    manifest: DataFrame,
) -> None:
    """Stages the rows of the directories ``touched``, then publishes them."""
    spark = rows.sparkSession
    staged = f"{root}/{STAGING}"
    layouts.write_partitioned(
        rows.select(*schema.names), f"{staged}/rows", keys, max_records_per_file=ROWS_PER_FILE
    )
    stored = layouts.read_partitioned(spark, f"{staged}/rows", schema)
    held = stored.select(*keys).distinct()
    _only(touched, held, keys, "left_anti").write.parquet(f"{staged}/emptied")
    # Last, because it tells that all of the load is there.
    manifest.write.parquet(f"{staged}/manifest")
    finish(spark, root, schema, keys)


def load_days(
    flights: DataFrame,
    root: str,
    *,
    keys: Sequence[str] = YEAR_CARRIER,
    schema: T.StructType = schemas.FLIGHTS,
) -> bool:
    """Puts the days of ``flights`` in place of the same days of the table at ``root``.

    A delivery holds its days whole: the table's flights of these days go, in whatever
    directory they are, and those of the delivery come. Only directories in which a day's
    rows or checksum change are written again; the files of all others stay as they are.
    The manifest tells which change, so a delivery that was loaded before changes nothing
    and does not read the table. Returns whether anything changed.

    Flights without a date are a day of their own. The same delivery may be loaded in any
    number of parts, as long as no day is divided, with the same rows in the end.
    """
    with _many_partitions(flights.sparkSession):
        return _load_days(flights, root, keys, schema)


def _load_days(
    flights: DataFrame, root: str, keys: Sequence[str], schema: T.StructType
) -> bool:
    spark = flights.sparkSession
    stored_as = T.StructType([*schema, T.StructField("year", T.IntegerType())])
    finish(spark, root, stored_as, keys)
    rows = _without_blank(layouts.with_year(flights.select(*schema.names)), keys)
    old = read_manifest(spark, root, _manifest_schema(stored_as, keys))
    unit = [*keys, DAY]
    # Written, because it is asked for several times and the delivery need not be small.
    new_path = f"{root}/{STAGING}/delivery"
    manifest_of(rows, keys).write.parquet(new_path)
    new = spark.read.schema(old.schema).parquet(new_path)
    days = F.broadcast(new.select(DAY).distinct())  # as many as the calendar has
    replaced = _only(old, days, [DAY], "left_semi")
    entry = [*unit, "rows", "checksum"]
    changes = _only(new, replaced, entry, "left_anti").unionByName(
        _only(replaced, new, entry, "left_anti")
    )
    touched = changes.select(*keys).distinct()
    if touched.isEmpty():
        files.remove(spark, f"{root}/{STAGING}")
        return False
    manifest = _only(old, days, [DAY], "left_anti").unionByName(new)
    arriving = _only(rows, touched, keys, "left_semi")
    if old.isEmpty():
        merged = arriving
    else:
        table = layouts.read_partitioned(spark, root, stored_as)
        kept = _held_in(table, touched, keys)
        merged = _only(kept, days, [DAY], "left_anti").unionByName(arriving)
    _load(root, stored_as, keys, merged, touched, manifest)
    return True


# Counts per tail, by country


ROLLUP_KEYS = ("country",)
DELTAS = T.StructType([T.StructField("delta", T.StringType())])
COUNTED = ("name", "carrier_code", "tail_number", "country")


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*COUNTED).agg(F.sum("count").alias("count")).filter("count <> 0")


def apply_delta(delta: DataFrame, root: str, name: str) -> bool:
    """Adds signed counts to the rollup at ``root``, reading and writing only the countries
    that the delta has.

    ``name`` names the delta: one that was applied before changes nothing, so a job that
    is run again does not count twice. Counts that reach zero go, and so does a country's
    directory with its last row; a count below zero is an error and nothing is changed.
    Returns whether the delta was applied. The first delta makes the table.
    """
    with _many_partitions(delta.sparkSession):
        return _apply_delta(delta, root, name)


def _apply_delta(delta: DataFrame, root: str, name: str) -> bool:
    spark = delta.sparkSession
    schema = schemas.COUNTRY_ROLLUP
    finish(spark, root, schema, ROLLUP_KEYS)
    applied = read_manifest(spark, root, DELTAS)
    if not applied.filter(F.col("delta") == name).isEmpty():
        return False
    # Written, because it is asked for several times.
    delta_path = f"{root}/{STAGING}/delta"
    _without_blank(delta.select(*schema.names), ROLLUP_KEYS).write.parquet(delta_path)
    delta = spark.read.schema(schema).parquet(delta_path)
    touched = delta.select(*ROLLUP_KEYS).distinct()
    merged = delta
    if not applied.isEmpty():
        table = layouts.read_country_rollup(spark, root)
        merged = _held_in(table, touched, ROLLUP_KEYS).unionByName(delta)
    count = F.col("count")
    checked = F.when(count > 0, count).otherwise(
        F.raise_error(F.concat(F.lit("fewer flights than none: "), F.to_json(F.struct(*COUNTED))))
    )
    merged = _summed(merged).withColumn("count", checked.cast("long"))
    manifest = applied.unionByName(spark.createDataFrame([(name,)], DELTAS))
    _load(root, schema, ROLLUP_KEYS, merged, touched, manifest)
    return True
