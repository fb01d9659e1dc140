"""Session helpers.

The library never creates a session behind the caller's back: operators take
the caller's DataFrames. ``build_session`` is for scripts and tests; on a
cluster the platform's session is used as is.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Settings every operator relies on. Timestamps in the trip data carry no
# zone, so the session default for parsed timestamps is zone-free.
REQUIRED_CONF = {
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide projections (24-field text records) generate methods above
    # HotSpot's 8000-bytecode JIT limit; let the JIT compile them anyway.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "veloframe", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(REQUIRED_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``; that is used when
    present (as the context's checkpoint directory, or the setting itself).
    Only a ``local[...]`` session without the setting, as in a test, gets a
    folder below its SQL warehouse: its driver and executors are one process.
    Any other session without the setting fails with a clear message.
    Nothing in the session is changed.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                           "executors share; intermediate tables are written there")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse"
    return warehouse.rstrip("/") + "/_veloframe_checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``Dataset.checkpoint`` usable: set the context's checkpoint
    directory to ``shared_folder`` when it is unset, and return it."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return sc.getCheckpointDir() or shared_folder(spark)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
