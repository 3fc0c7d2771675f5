"""The Spark session that the engine expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, **options: str) -> SparkSession:
    b = SparkSession.builder.appName("tidegrid")
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **options}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    checkpoints(spark)
    return spark


def checkpoints(spark: SparkSession) -> str:
    """The folder of checkpoint(): spark.checkpoint.dir; a temporary one only where all runs in one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidegrid-checkpoints-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
