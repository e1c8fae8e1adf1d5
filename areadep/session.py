"""Session settings the jobs are designed for. A caller's own session is never reconfigured."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "areadep", cores: str | int = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster passes its own session instead."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",   # call sites per expression cost more than small plans
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the cluster's own setting. Only a session of one machine gets a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not shared and sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return sc.getCheckpointDir()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by key over all shuffle partitions, which adaptive execution then leaves as they are: it would join them by the bytes
    shuffled, however large rows become in the task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
