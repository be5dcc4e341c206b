"""Reading tables, and an input order to break ties by."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """The same rows, dealt by ``keys`` into as many partitions as a shuffle has.

    For work that costs far more than reading its rows: a file of a few megabytes
    is one split, and so one task, however long each of its rows takes.
    """
    return frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def shared_path(spark, name: str) -> str:
    """A new path in the folder that driver and executors share, ``spark.checkpoint.dir``.

    Only a local session may go without it and gets a temporary folder.
    """
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    folder = current.get() if current.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="evidence-shared-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"
