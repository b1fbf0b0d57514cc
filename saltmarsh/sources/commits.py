"""Tables that are replaced or grow as a whole: immutable parts, and a log whose newest entry names the live ones.

A part is a folder that is written once. An entry is a numbered file that is written aside and then moved to its number, which fails where the number is taken; so it
is there whole or not at all, and of two writers who started from the same entry one gets a ``Conflict``. Readers resolve the newest entry and read its parts,
which stay until they are no longer among the newest entries. Whatever a lost job leaves is named by no entry: it is never read, and goes when it is old.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has added the entry."""


@dataclass(frozen=True)
class Entry:
    number: int
    state: dict


class Log:
    """Numbered entries in a folder, each a small JSON file."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        at = self.hadoop.Path(self.folder)
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = at.getFileSystem(self.conf)

    def _numbers(self) -> list[int]:
        at = self.hadoop.Path(self.folder)
        names = [f.getPath().getName() for f in self.system.listStatus(at)] if self.system.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _path(self, number: int):
        return self.hadoop.Path(f"{self.folder}/{number:020d}.json")

    def read(self, number: int) -> Entry:
        source = self.system.open(self._path(number))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        return Entry(number, json.loads(text))

    def newest(self, many: int = 1) -> list[Entry]:
        """The newest entries, the last one first."""
        return [self.read(n) for n in self._numbers()[::-1][:many]]

    def add(self, state: dict, after: int) -> Entry:
        """The entry behind number ``after`` (0: the first one); Conflict where there is one already."""
        if (self._numbers() or [0])[-1] != after:
            raise Conflict(f"entry {after} of {self.folder} isn't the newest one")
        text, name = json.dumps(state, sort_keys=True), uuid.uuid4().hex
        if self.system.getScheme() == "file":
            self._link(text, name, after + 1)
        else:
            self._move(text, name, after + 1)
        return Entry(after + 1, state)

    def _link(self, text: str, name: str, number: int) -> None:
        """In a folder of the operating system, where Hadoop's moves replace what is there: a link is made or fails."""
        folder = Path(self.hadoop.Path(self.folder).toUri().getPath())
        folder.mkdir(parents=True, exist_ok=True)
        aside = folder / f"{name}.aside"
        aside.write_text(text)
        try:
            os.link(aside, folder / f"{number:020d}.json")
        except FileExistsError as e:
            raise Conflict(f"entry {number} of {self.folder} is taken") from e
        finally:
            aside.unlink()

    def _move(self, text: str, name: str, number: int) -> None:
        """In a store of Hadoop's: a move that never replaces a file."""
        aside = self.hadoop.Path(f"{self.folder}/{name}.aside")
        out = self.system.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            self.hadoop.FileContext.getFileContext(aside.toUri(), self.conf).rename(aside, self._path(number), none)
        except Exception as e:
            self.system.delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"entry {number} of {self.folder} is taken") from e
            raise

    def forget(self, before: int) -> None:
        """Delete entries with smaller numbers."""
        for n in self._numbers():
            if n < before:
                self.system.delete(self._path(n), False)


class Table:
    """A table in ``root``: ``log`` has its entries, ``parts`` its parts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = Log(spark, f"{self.root}/log")

    def entry(self) -> Entry | None:
        return next(iter(self.log.newest()), None)

    def _written(self, df: DataFrame) -> dict:
        path = f"{self.root}/parts/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return {"path": path, "rows": self.spark.read.schema(df.schema).parquet(path).count()}

    def _committed(self, parts: list[dict], schema: T.StructType, sync: str, base: Entry | None) -> Entry:
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        return self.log.add({"parts": parts, "schema": nullable.jsonValue(), "sync": sync}, base.number if base else 0)

    def publish(self, df: DataFrame, sync: str, base: Entry | None, expected: str | None = None) -> Entry:
        """Replace the table's rows with df's, as seen from entry ``base`` (None: there was none): Conflict, where another one has come since.

        With ``expected``, the base must be the entry of that sync.
        """
        if expected is not None and (base is None or base.state["sync"] != expected):
            raise ValueError(f"built on sync {base and base.state['sync']}, not on {expected}")
        return self._committed([self._written(df)], df.schema, sync, base)

    def extend(self, df: DataFrame, sync: str, base: Entry | None) -> Entry:
        """Add rows that were made with what entry ``base`` shows (None: nothing): Conflict, where another one has come since."""
        return self._committed([*(base.state["parts"] if base else []), self._written(df)], df.schema, sync, base)

    def append(self, df: DataFrame, sync: str, tries: int = 10) -> Entry:
        """Add rows; another writer's entry meanwhile does no harm, so the part is named again behind it."""
        part = self._written(df)
        for _ in range(tries):
            base = self.entry()
            if base and T.StructType.fromJson(base.state["schema"]).simpleString() != df.schema.simpleString():
                raise ValueError("the columns differ from the table's")
            try:
                return self._committed([*(base.state["parts"] if base else []), part], df.schema, sync, base)
            except Conflict:
                continue
        raise Conflict(f"{tries} other entries came first")

    def read(self, entry: Entry | None = None) -> DataFrame:
        """The rows of the newest entry, or of another that hasn't gone."""
        entry = entry or self.entry()
        if entry is None:
            raise FileNotFoundError(f"{self.root} has no entry")
        return self.spark.read.schema(T.StructType.fromJson(entry.state["schema"])).parquet(*[p["path"] for p in entry.state["parts"]])

    def history(self) -> DataFrame:
        """number, sync, parts and rows of every entry that is kept."""
        rows = [(e.number, e.state["sync"], len(e.state["parts"]), sum(p["rows"] for p in e.state["parts"])) for e in self.log.newest(1 << 30)]
        return self.spark.createDataFrame(rows, "number long, sync string, parts int, rows long")

    def retain(self, keep: int = 2, hours: float = 12, now: float | None = None) -> list[str]:
        """Keep the newest entries and delete parts that only older ones name, and parts that none names once they are so old; returns those deleted."""
        kept = self.log.newest(max(1, keep))
        if not kept:
            return []
        live = {p["path"].rsplit("/", 1)[1] for e in kept for p in e.state["parts"]}
        named = {p["path"].rsplit("/", 1)[1] for e in self.log.newest(1 << 30) for p in e.state["parts"]}
        old = (time.time() if now is None else now) * 1000 - hours * 3_600_000
        gone = []
        # first the entries, so that none names a part that is gone
        self.log.forget(kept[-1].number)
        for f in self.log.system.listStatus(self.log.hadoop.Path(f"{self.root}/parts")):
            name = f.getPath().getName()
            if name not in live and (name in named or f.getModificationTime() <= old):
                self.log.system.delete(f.getPath(), True)
                gone.append(name)
        return gone


def upsert(table: Table, rows: DataFrame, keys: list[str], sync: str) -> Entry:
    """Publish the table's rows with those of ``rows`` in place of the ones with equal keys; within ``rows`` keys are distinct."""
    base = table.entry()
    if base is None:
        return table.publish(rows, sync, None)
    rest = table.read(base).join(rows.select(*keys), keys, "left_anti")
    return table.publish(rest.select(*rows.columns).unionByName(rows), sync, base)
