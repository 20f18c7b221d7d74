"""Partitioned tables that let a query read only its year or its country."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources import schemas

YEAR_CARRIER = ("year", "carrier_code")
YEAR_ONLY = ("year",)

# Rows per file unless told otherwise: tens of megabytes, and a year or country of any
# size is read by several tasks.
ROWS_PER_FILE = 1_000_000

# A cap below this makes small files, which cost more to open than their rows to write. Their
# tasks make about so many files each, so that no task keeps the other cores waiting; rows
# count as so many bytes of a shuffle, wider ones make fewer files.
SMALL_CAP = 10_000
FILES_PER_TASK = 250
BYTES_PER_ROW = 16

# Spark's own settings: the bytes adaptive execution merges tasks to, and the least it merges
# them to where there are cores for more.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"

# Directories a table may have before carriers share them: a directory costs a file, a
# rename and a place in the driver's listing, whatever it holds. Those of shared ones hold
# about so many rows, as the published files do.
MOST_DIRECTORIES = 10_000
ROWS_PER_DIRECTORY = 100_000

# The directories that carriers share, by a hash of the code.
CARRIERS = "carrier_group"


@contextmanager
def _tasks_of_files(spark: SparkSession, max_records_per_file: int) -> Iterator[None]:
    """Until left, adaptive execution merges tasks to ``FILES_PER_TASK`` files of so many
    rows at most."""
    before = {name: spark.conf.get(name) for name in (ADVISORY, LEAST)}
    size_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    wanted = max_records_per_file * FILES_PER_TASK * BYTES_PER_ROW
    try:
        for name, size in before.items():
            spark.conf.set(name, min(size_of(size), wanted))
        yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    sort_within: Sequence[str] = (),
    replace: bool = False,
) -> None:
    """Write ``df`` in directories by ``keys``.

    ``rebalance`` brings the rows of a directory together and lets adaptive execution
    split a directory that is too large for one task and merge those that are small.
    Under a cap of less than ``SMALL_CAP`` rows they are dealt in ranges instead, as a
    directory then is work for many tasks however few bytes it has, and may have come from
    one task, which ``rebalance`` does not split.
    ``replace`` writes into a table that exists: the directories of which ``df`` has rows
    are replaced, the others stay.
    """
    small = max_records_per_file is not None and 0 < max_records_per_file < SMALL_CAP
    if small:
        rows = df.repartitionByRange(*keys, *sort_within, F.xxhash64(*df.columns))
    else:
        rows = df.hint("rebalance", *(F.col(key) for key in keys))
    if sort_within:
        rows = rows.sortWithinPartitions(*keys, *sort_within)
    writer = rows.write.partitionBy(*keys).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    tasks = _tasks_of_files(df.sparkSession, max_records_per_file) if small else nullcontext()
    with tasks:
        writer.save(path)


def read_partitioned(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
) -> DataFrame:
    """The whole table; filters on partition columns then choose directories.

    The schema is given because inference would read carrier 007 as the number 7.
    """
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.load(path)


# Flights by year and carrier


def with_year(flights: DataFrame) -> DataFrame:
    return flights.withColumn("year", F.year("flight_date"))


def _carrier_groups(rows: DataFrame, most_directories: int) -> int:
    """Groups of carriers a year is divided into; 0 if each carrier may have its own."""
    keys = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.approx_count_distinct(F.struct("year")).alias("years"),
        F.approx_count_distinct(F.struct("year", "carrier_code")).alias("directories"),
    ).first()
    if keys["directories"] <= most_directories:
        return 0
    years = max(1, keys["years"])
    wanted = ceil(keys["rows"] / ROWS_PER_DIRECTORY / years)
    return max(1, min(wanted, most_directories // years))


def write_flights_by_year(
    flights: DataFrame,
    path: str,
    *,
    keys: Sequence[str] = YEAR_CARRIER,
    fmt: str = "parquet",
    max_records_per_file: int | None = ROWS_PER_FILE,
    most_directories: int | None = MOST_DIRECTORIES,
) -> None:
    """Flights in directories by ``keys``, sorted by carrier where that is no directory.

    Where years and carriers would make more than ``most_directories`` (about, as they are
    estimated; None: however many), the carriers of a year share directories by a hash of
    their code, and the files hold the code.
    """
    rows = with_year(flights)
    if "carrier_code" in keys and most_directories is not None:
        groups = _carrier_groups(rows, most_directories)
        if groups:
            group = F.pmod(F.xxhash64("carrier_code"), F.lit(groups)).cast("int")
            rows = rows.withColumn(CARRIERS, group)
            keys = [CARRIERS if key == "carrier_code" else key for key in keys]
    sort_within = [] if "carrier_code" in keys else ["carrier_code"]
    write_partitioned(
        rows,
        path,
        keys,
        fmt=fmt,
        max_records_per_file=max_records_per_file,
        sort_within=sort_within,
    )


def read_flights_by_year(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    schema: T.StructType = schemas.FLIGHTS,
) -> DataFrame:
    """The flights of ``write_flights_by_year``, in whichever directories carriers are."""
    with_partition = T.StructType([*schema, T.StructField("year", T.IntegerType())])
    return read_partitioned(spark, path, with_partition, fmt=fmt).drop(CARRIERS)


# Tables by country


def write_country_rollup(
    per_tail: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    max_records_per_file: int | None = ROWS_PER_FILE,
) -> None:
    """Per-tail flight counts of all airlines, in directories by country."""
    write_partitioned(
        per_tail.select("name", "carrier_code", "tail_number", "count", "country"),
        path,
        ["country"],
        fmt=fmt,
        max_records_per_file=max_records_per_file,
    )


def read_country_rollup(
    spark: SparkSession, path: str, *, fmt: str = "parquet"
) -> DataFrame:
    return read_partitioned(spark, path, schemas.COUNTRY_ROLLUP, fmt=fmt)


def write_country_flights(
    flights: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    max_records_per_file: int | None = ROWS_PER_FILE,
    by_tail: bool = False,
) -> None:
    """Flights that carry their airline's name and country, in directories by country.

    ``by_tail`` sorts the rows by tail number, so that a read of a few aircraft skips
    most of the files and row groups of a country.
    """
    write_partitioned(
        flights,
        path,
        ["country"],
        fmt=fmt,
        max_records_per_file=max_records_per_file,
        sort_within=["tail_number"] if by_tail else [],
    )


def read_country_flights(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    schema: T.StructType = schemas.COUNTRY_FLIGHTS,
) -> DataFrame:
    return read_partitioned(spark, path, schema, fmt=fmt)


def write_country_tail(
    flights: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    max_records_per_file: int | None = ROWS_PER_FILE,
    parts: int | None = None,
) -> None:
    """Flights by country, every file holding a narrow range of tail numbers.

    Rows are dealt in ranges of country, tail and a hash of the flight, so that a hot
    country or tail spreads over tasks while a tail stays in few files. ``parts`` is the
    number of ranges (the session's shuffle partitions unless given; these are not split
    later), the cap ends files within a range. Parquet files get a Bloom filter of their
    tail numbers, so that a look-up of one aircraft skips row groups whose range of
    numbers holds its number without having it.
    """
    turn = F.xxhash64("flight_id")
    ranges = ["country", "tail_number", turn]
    dealt = (
        flights.repartitionByRange(*ranges)
        if parts is None
        else flights.repartitionByRange(parts, *ranges)
    )
    writer = (
        dealt.sortWithinPartitions("country", "tail_number")
        .write.partitionBy("country")
        .format(fmt)
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    else:
        # Not written for a column that a dictionary holds whole.
        writer = (
            writer.option("parquet.bloom.filter.enabled#tail_number", True)
            .option("parquet.bloom.filter.adaptive.enabled", True)
            .option("parquet.enable.dictionary#tail_number", False)
        )
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)
