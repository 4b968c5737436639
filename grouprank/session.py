"""Spark session helpers.

The library never creates a session itself; these helpers are for tests,
the benchmark and command-line use. On a cluster the session comes from the
platform and ``spark.checkpoint.dir`` points at shared storage.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # partition values such as "007" stay strings when read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "grouprank") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    active = SparkSession.getActiveSession()
    if active is None or not active.sparkContext.getConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="grouprank-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``; an error if it names none."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return d.rstrip("/")
