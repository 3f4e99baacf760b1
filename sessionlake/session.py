"""SparkSession defaults for local runs and tests, and the shared checkpoint
folder. On a cluster the session comes from the caller and its settings win."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "sessionlake", cpus: str | int = "*", shuffle_partitions: int | None = None,
              driver_memory: str = "8g") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app).config("spark.driver.memory", driver_memory)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or (os.cpu_count() if cpus == "*" else cpus)))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``). Only
    when the deployment names none (local runs, tests) is a private temporary
    folder used, one per application; on a cluster that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not d and current.isDefined():
        return current.get()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sessionlake-ckpt-")
    if current.isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d
