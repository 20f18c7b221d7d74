"""Session set-up and the shared scratch folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session for these jobs; what is not set here stays as the cluster has it."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even where that costs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **(conf or {}),
    }
    if partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder below the one that ``spark.checkpoint.dir`` names.

    A local session that names none uses its warehouse; a cluster is refused. Hadoop
    removes the folder when the session's JVM ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    root = f"{shared.rstrip('/')}/skyledger-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid4().hex}"
