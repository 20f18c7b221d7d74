"""Folders of a table on any file system Hadoop knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _opened(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    files, place = _opened(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def move(spark: SparkSession, path: str, to: str) -> None:
    files, place = _opened(spark, path)
    _, target = _opened(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(place, target):
        raise OSError(f"{path} could not be moved to {to}")


def remove(spark: SparkSession, path: str) -> None:
    files, place = _opened(spark, path)
    files.delete(place, True)
