"""Session settings the library relies on."""

import gc
import os
import time

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split an overloaded join partition even when a later step must shuffle again for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Recording the Python line of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MB = 1024 * 1024


def sized_for(input_bytes: int, shuffled_bytes: int, task_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings that keep a task near ``task_bytes``.

    Scans are cut by their own size. Shuffles are sized by what they move, which after the counting aggregations is a
    small part of ``input_bytes``: the reports shuffle station-days, the fact its narrow rides once. Small inputs are
    cut finer, so that a cluster's cores all have work.
    """
    scan = max(16 * MB, min(task_bytes, input_bytes // 200))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffled_bytes // task_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
    }


def build_session(
    app_name: str = "dockflow", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("SPARK_LOG_LEVEL", "ERROR"))
    return spark


def let_go(spark: SparkSession) -> None:
    """Free what the driver no longer uses: Python's handles, objects, then broadcasts, which Spark drops once their handles are gone."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)  # for Spark's cleaner
