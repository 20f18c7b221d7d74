"""Folders of CSV files whose headers differ in order or lack a column."""

from __future__ import annotations

import csv
import re
from collections.abc import Collection, Iterator, Mapping
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources import schemas

# As much as the scan may put in one task: with each file said to cost as much to open,
# every task has one file.
ONE_FILE_BYTES = 2**40


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of each file that has a line, read in the executors.

    Each task opens one file and stops after its first line. The settings that bring
    this about are those of a session of its own, so the caller's stay as they are.
    """

    # Inside, so that executors get it as it is and need not have this package.
    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(ONE_FILE_BYTES))
    apart.conf.set("spark.sql.files.openCostInBytes", str(ONE_FILE_BYTES))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = apart.read.text(path).filter(F.col("_metadata.file_block_start") == 0)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("header")
    ).mapInArrow(first_line, "file string, header string")


def header_names(header: str) -> tuple[str, ...]:
    names = next(csv.reader([header.removeprefix("\ufeff")]), [])
    return tuple(name.strip() for name in names)


def _checked(
    names: tuple[str, ...], files: list[str], known: Mapping[str, str], needed: Collection[str]
) -> None:
    meant = [known.get(name) for name in names]
    faults = [f"unknown column {name!r}" for name, own in zip(names, meant) if own is None]
    repeated = sorted({own for own in meant if own is not None and meant.count(own) > 1})
    faults += [f"column {name!r} more than once" for name in repeated]
    faults += [f"no column {name!r}" for name in needed if name not in meant]
    if faults:
        more = f" and {len(files) - 1} more" if len(files) > 1 else ""
        raise ValueError(f"header of {files[0]}{more}: {', '.join(faults)}")


def _literal(path: str) -> str:
    """``path`` with nothing in it that a reader would take for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_csv_by_header(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    needed: Collection[str] = (),
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """The columns of ``schema`` from CSV files that each have a header of their own.

    Files are grouped by header and every group is read by its order of columns, so a
    value is never taken for its neighbour's. A column that a header lacks is null, or an
    error if it is ``needed``; so is a header that names a column twice or one that
    neither ``schema`` nor ``aliases`` (another name of a column) has. Files without a
    line are skipped. What reaches the driver is the list of files, which every reader
    holds there, with a header each.
    """
    known = {name: name for name in schema.names} | dict(aliases or {})
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in file_headers(spark, path).collect():
        groups.setdefault(header_names(row["header"]), []).append(unquote(row["file"]))
    parts = []
    for names, files in sorted(groups.items()):
        _checked(names, files, known, needed)
        fields = [T.StructField(name, schema[known[name]].dataType) for name in names]
        rows = (
            spark.read.schema(T.StructType(fields))
            .option("header", True)
            .csv([_literal(file) for file in sorted(files)])
        )
        found = {known[name]: name for name in names}
        parts.append(
            rows.select(
                *(
                    F.col(f"`{found[f.name]}`").alias(f.name)
                    if f.name in found
                    else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in schema
                )
            )
        )
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def read_flights_by_header(spark: SparkSession, path: str) -> DataFrame:
    """Flights from such a folder; the departure column may have either name."""
    return read_csv_by_header(
        spark,
        path,
        schemas.FLIGHTS,
        needed=schemas.NEEDED,
        aliases={schemas.MISSPELT_SCHEDULED: schemas.SCHEDULED},
    )
