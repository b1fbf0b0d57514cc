"""Intermediate tables in the folder that the cluster shares.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and reading it back, so that a lost executor
costs a re-read and never a recomputation of the whole plan.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, a temporary one, on one machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="saltmarsh-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Bytes of rows that a Python worker gets at once: texts may be long, so rows alone don't bound its memory.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Limit the batches of the session to BATCH_BYTES, where they aren't smaller already; plans read the setting when they run."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind them where df has such a column already."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Scratch:
    """Named tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        bounded_batches(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.serial = 0

    def path(self, name: str) -> str:
        self.serial += 1
        return f"{self.root}/{self.serial:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete stored tables that no later plan reads."""
        for table in tables:
            delete(self.spark, table.scratch_path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """While stored tables are computed inside, tasks get so many rows at a time: long texts, so memory follows their number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    system, at = _file(spark, path)
    system.delete(at, True)


#: Rows of identifiers, 8 to 16 bytes each, up to which they are broadcast rather than shuffled against the texts.
BROADCAST_ROWS = 1_000_000


def small_side(stored: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """A stored table of short rows (or ``rows``, made of it), hinted for a join with texts: broadcast where counted small, else the built side of a hash join."""
    rows = stored if rows is None else rows
    return rows.hint("broadcast") if stored.count() <= BROADCAST_ROWS else rows.hint("shuffle_hash")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
