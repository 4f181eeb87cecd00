"""The session every entry point shares: UTC clock, ANSI arithmetic, adaptive plans."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that decide results, not only speed; they are applied to any session.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

#: Settings of a session started here; a cluster gives its own through spark-submit.
START_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tripwright", **settings: str) -> SparkSession:
    """A session with the engine's settings; an existing one is reused.

    Shuffle partitions are left to Spark's own setting on a cluster (AQE coalesces
    them); on local masters twice the cores are enough.
    """
    cores = os.cpu_count() or 4
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.setdefault("spark.sql.shuffle.partitions", str(2 * cores))
            settings.setdefault("spark.driver.memory", "8g")
    for key, value in {**RESULT_SETTINGS, **START_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return reachable(builder.getOrCreate())


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package wherever they are started.

    On a cluster the package comes by ``--py-files`` or is installed.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])
    return spark
