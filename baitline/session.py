"""Session helpers shared by tests, the benchmark and stand-alone use."""

from __future__ import annotations

import os
import sys
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session; on a cluster the session comes from spark-submit instead."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("baitline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where that is unset, on a local master only, a folder of our own."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_dir = tempfile.mkdtemp(prefix="baitline-checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir
