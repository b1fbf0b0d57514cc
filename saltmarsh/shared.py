"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; where that is unset, below a temporary folder, on one machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="saltmarsh-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of numbers that a task sorts at once, about: tables that grow get more tasks and not larger ones.
TASK_ROWS = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df, of about so many rows, partitioned by keys into as many parts as TASK_ROWS asks for, and as the session has at least.

    Windows and aggregates by these keys, or by more, need no other shuffle.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet and read back, which cuts the lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
