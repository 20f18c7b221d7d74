from __future__ import annotations

import sys
from collections.abc import Iterator
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skyledger.operators.joins import BROADCAST_BYTES_CONF  # noqa: E402
from skyledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    return build_session(
        "skyledger-tests",
        master="local[4]",
        partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )


@pytest.fixture(params=["broadcast", "shuffle"])
def join_path(request: pytest.FixtureRequest, spark: SparkSession) -> Iterator[str]:
    """Run a test once with small sides broadcast and once with every side shuffled."""
    auto = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(auto)
    if request.param == "shuffle":
        spark.conf.set(BROADCAST_BYTES_CONF, "0")
        spark.conf.set(auto, "-1")
    yield request.param
    spark.conf.unset(BROADCAST_BYTES_CONF)
    spark.conf.set(auto, before)
