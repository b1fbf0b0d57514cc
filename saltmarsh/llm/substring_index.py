"""Removal of repeated passages through a log-structured index of window fingerprints.

A window is WINDOW consecutive words. Each window is represented by the smallest hash among its runs of GRAM words (its
minimiser), so two equal windows always share their fingerprint, although only about one run in twenty is kept. Fingerprints go
into immutable runs, bucketed and sorted by fingerprint, in a folder that later jobs open again; a batch of new documents is written as a run of its own,
merge-joined with itself and with every older run without a further shuffle, and runs are compacted into one when they are many.
Matched fingerprints only nominate: the windows behind them are then compared by a hash of all their words beside the
fingerprint (128 bits together), and words are removed where the same window starts in a document with a smaller identifier.

Hot passages: within a task only the first holder of a window stays open, all others are decided at once, so a passage in a third
of all documents sends one row a task to the next shuffle. What arrives for a fingerprint is read in document order with
the distinct windows of that fingerprint in memory.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.commits import Log
from .hashing import batches, run_hashes, words_of
from .scratch import Scratch, delete, partitions

GRAM = 12
LAST = (1 << 63) - 1


def minimisers(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a text: the hash that represents it, and the place of the run that has it (its first, on ties)."""
    span = window - gram + 1
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = run_hashes(words, gram)
    out = np.empty(len(words) - window + 1, np.int64)
    for i in range(0, len(out), 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(grams[i : i + (1 << 16) + span - 1], span)
        out[i : i + (1 << 16)] = view.argmin(1) + np.arange(i, i + len(view))
    return grams[out], out


#: Rows without a doc_id get an identifier from here on, by their text; doc_ids are smaller.
UNNAMED = 1 << 62


def did() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(UNNAMED) + F.xxhash64("text").bitwiseAND(F.lit(UNNAMED - 1)))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, did (never null), a hash of the text that tells rows with one doc_id apart, and text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), did().alias("did"), F.xxhash64("text").alias("tk"), F.coalesce("text", F.lit("")).alias("text"))


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


FACTS = "doc_id long, did long, tk long, n_words long, sha string, fps array<long>"


def facts(docs: DataFrame, window: int, gram: int = GRAM) -> DataFrame:
    """For each document: number of words, sha256 of the words joined by blanks, and its distinct fingerprints."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = _texts(batch, "text")
            for a, b in batches(texts):
                words, bounds = words_of(texts[a:b])
                n, sha, fps = [], [], []
                for k, text in enumerate(texts[a:b]):
                    own = words[bounds[k] : bounds[k + 1]]
                    n.append(len(own))
                    sha.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                    at = minimisers(own, window, gram)
                    keep = np.flatnonzero(np.diff(at[1], prepend=-1))
                    fps.append(np.unique(at[0][keep]).view(np.int64))
                ends = np.concatenate(([0], np.cumsum([len(x) for x in fps]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(fps)))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("did"), part.column("tk"), pa.array(n, pa.int64()), pa.array(sha), lists], names=["doc_id", "did", "tk", "n_words", "sha", "fps"])

    return keyed(docs).mapInArrow(run, FACTS)


class FingerprintIndex:
    """Sorted immutable runs of (fp, did) in a folder, with a manifest: an index that is there already is opened.

    A run is a table bucketed and sorted by fingerprint, so a merge-join of runs shuffles nothing. The newest entry of a log names the live runs, the
    texts and the batches with their reports. A batch is named last, when its report is stored, so a job that is lost leaves the index as
    it was and can be repeated; of two jobs that add at once, one gets a Conflict. Runs that were compacted stay for an entry more, for those who read them.
    """

    def __init__(self, spark: SparkSession, root: str, fan_in: int = 4):
        self.spark, self.root, self.fan_in = spark, root, fan_in
        self.buckets, self.runs, self.texts, self.last, self.batches = partitions(spark), [], [], None, {}
        self.log = Log(spark, f"{root}/log")
        self.number = 0
        for entry in self.log.newest():
            known, self.number = entry.state, entry.number
            self.buckets, self.texts, self.last, self.batches = known["buckets"], known["texts"], known["last"], known["batches"]
            self.runs = [(self._registered(path), path) for path in known["runs"]]

    def _registered(self, path: str) -> str:
        name = f"run_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} (fp BIGINT, did BIGINT) USING parquet OPTIONS (path '{path}') CLUSTERED BY (fp) SORTED BY (fp) INTO {self.buckets} BUCKETS")
        return name

    def note(self, batch: str, report: str, texts: str, last: int) -> None:
        """Name the runs added since the last entry, with a batch's identifier, the folders of its report and its texts, and its greatest did."""
        if len(self.runs) > self.fan_in:
            self.compact()
        self.texts, self.last, self.batches = [*self.texts, texts], last, self.batches | {batch: report}
        state = {"buckets": self.buckets, "runs": [path for _, path in self.runs], "texts": self.texts, "last": last, "batches": self.batches}
        self.number = self.log.add(state, self.number).number
        newest = [set(e.state["runs"]) for e in self.log.newest(3)]
        for path in newest[-1] - newest[0] - newest[1] if len(newest) == 3 else ():
            delete(self.spark, path)

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name = f"run_{uuid.uuid4().hex}"
        path = f"{self.root}/{name}"
        rows.select("fp", "did").repartition(self.buckets, "fp").write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", path).saveAsTable(name)
        return name, path

    def add(self, rows: DataFrame) -> DataFrame:
        """Append a batch as a run; returns, stored, the fingerprints that one of its documents shares with another document."""
        run = self._write(rows)
        new = self.spark.table(run[0])
        own = new.groupBy("fp").agg(F.min("did").alias("lo"), F.max("did").alias("hi"))
        found = own.where("lo < hi").select("fp")
        for name, _ in self.runs:
            old = self.spark.table(name).groupBy("fp").agg(F.min("did").alias("lo"), F.max("did").alias("hi"))
            found = found.unionByName(own.alias("n").join(old.alias("o"), "fp").where("n.lo <> o.lo or n.hi <> o.hi or n.lo <> n.hi").select("fp"))
        found = Scratch(self.spark, "found").store(found.distinct(), "found")
        self.runs.append(run)
        return found

    def rows(self) -> DataFrame:
        out = self.spark.table(self.runs[0][0])
        for name, _ in self.runs[1:]:
            out = out.unionByName(self.spark.table(name))
        return out

    def compact(self) -> None:
        """Merge all runs into one; the files of those that an entry names stay."""
        if len(self.runs) > 1:
            old, self.runs = self.runs, [self._write(self.rows())]
            named = {path for e in self.log.newest() for path in e.state["runs"]}
            for name, path in old:
                self.spark.sql(f"DROP TABLE {name}")
                if path not in named:
                    delete(self.spark, path)

    def close(self) -> None:
        """Forget the tables; the files stay."""
        for name, _ in self.runs:
            self.spark.sql(f"DROP TABLE {name}")
        self.runs = []

    def delete(self) -> None:
        self.close()
        delete(self.spark, self.root)


WINDOWS = "fp long, did long, tk long, at long, hashes binary"


def _windows(named: DataFrame, window: int, gram: int) -> DataFrame:
    """Runs of windows behind named fingerprints, still open; or, with a null fp, words decided to go: at and a length in hashes."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts, fps = _texts(batch, "text"), batch.column("fps")
            dids, tks = batch.column("did").to_numpy(), batch.column("tk").to_numpy()
            for a, b in batches(texts):
                words, bounds = words_of(texts[a:b])
                parts = []
                for k in range(a, b):
                    own = words[bounds[k - a] : bounds[k - a + 1]]
                    fp, _ = minimisers(own, window, gram)
                    at = np.flatnonzero(np.isin(fp, np.array(fps[k].values.to_numpy(), np.int64).view(np.uint64)))
                    parts.append((np.full(len(at), k), at, fp[at], run_hashes(own, window)[at]))
                doc, at, fp, h = (np.concatenate(x) for x in zip(*parts, strict=True))
                if not len(doc):
                    continue
                order = np.lexsort((dids[doc], h, fp))
                head = np.concatenate(([True], (fp[order][1:] != fp[order][:-1]) | (h[order][1:] != h[order][:-1])))
                first = dids[doc][order][np.flatnonzero(head)[np.cumsum(head) - 1]]
                gone = np.zeros(len(doc), bool)
                gone[order] = dids[doc][order] > first
                cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1) | (fp[1:] != fp[:-1]) | (gone[1:] != gone[:-1]))))
                ends = np.append(cut[1:], len(doc))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(fp[cut].view(np.int64), mask=gone[cut]),
                        pa.array(dids[doc[cut]]),
                        pa.array(tks[doc[cut]]),
                        pa.array(at[cut]),
                        pa.array([np.int64(e - c).tobytes() if g else h[c:e].tobytes() for c, e, g in zip(cut.tolist(), ends.tolist(), gone[cut].tolist(), strict=True)], pa.binary()),
                    ],
                    names=["fp", "did", "tk", "at", "hashes"],
                )

    return named.mapInArrow(run, WINDOWS)


SPANS = "did long, tk long, start long, stop long"


def _spans(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["did", "tk", "start", "stop"])


#: Windows of a fingerprint that a task reads; those of a hotter one are dealt to SHARES tasks by their hashes.
HOT, SHARES = 1 << 20, 64


def _dealt(hot: DataFrame) -> DataFrame:
    """A row for each window, with the share that its hash falls into."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for fp, did, tk, at, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = np.frombuffer(hashes, np.uint64)
                same = [pa.array(np.full(len(h), x), pa.int64()) for x in (fp, did, tk)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(at + np.arange(len(h))), pa.array([x.tobytes() for x in h], pa.binary()), pa.array((h % np.uint64(SHARES)).astype(np.int32) + 1)], names=["fp", "did", "tk", "at", "hashes", "share"])

    return hot.mapInArrow(run, f"{WINDOWS}, share int")


def _settle(opened: DataFrame, window: int) -> DataFrame:
    """Spans of words whose window also starts in an earlier document, of stored windows. Rows of a fingerprint, or of a hot one's share, come in document order."""
    sizes = opened.groupBy("fp").agg(F.sum(F.octet_length("hashes")).alias("bytes")).where(F.col("bytes") > 8 * HOT).select("fp")
    opened, whole = opened.withColumn("share", F.lit(0)), opened
    if not sizes.isEmpty():
        hot = F.broadcast(sizes)  # one row for HOT windows, at most
        opened = opened.join(hot, "fp", "left_anti").unionByName(_dealt(whole.join(hot, "fp", "left_semi").select("fp", "did", "tk", "at", "hashes")))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, did_now, earlier, own = None, None, set(), set()
        for batch in stream:
            rows = []
            for fp, did, tk, at, hashes, share in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (fp, share) != now:
                    now, did_now, earlier, own = (fp, share), did, set(), set()
                elif did != did_now:
                    earlier |= own
                    did_now, own = did, set()
                hs = np.frombuffer(hashes, np.uint64).tolist()
                if earlier:
                    start = None
                    for i, h in enumerate(hs):
                        if h in earlier:
                            start = i if start is None else start
                        elif start is not None:
                            rows.append((did, tk, at + start, at + i - 1 + window))
                            start = None
                    if start is not None:
                        rows.append((did, tk, at + start, at + len(hs) - 1 + window))
                own.update(hs)
            yield _spans(rows)

    return opened.select("fp", "did", "tk", "at", "hashes", "share").repartition(partitions(opened.sparkSession), "fp", "share").sortWithinPartitions("fp", "share", "did").mapInArrow(run, SPANS)


def _decided(rows: DataFrame, window: int) -> DataFrame:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            n = np.array([np.frombuffer(x, np.int64)[0] for x in batch.column("hashes").to_pylist()], np.int64)
            at = batch.column("at").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("tk"), pa.array(at), pa.array(at + n - 1 + window)], names=["did", "tk", "start", "stop"])

    return rows.mapInArrow(run, SPANS)


class Repeats:
    """What is repeated in a table of documents.

    ``facts``: doc_id, did, tk, n_words, sha, copy (the same words stand in a document with a smaller identifier).
    ``texts``: did, tk, text of documents that share a passage with another, copies left out.
    ``spans``: did, tk, spans: array of (start, stop) in words, of what goes from those.

    Words are runs of characters other than ASCII white space. A null or empty text has no words. Rows without a doc_id count as
    larger than all others (which are below 2**62), in an order of their own. Rows with one doc_id are never copies of each other, as neither has the smaller identifier. An empty table gives
    empty tables; other columns are ignored. ``batch_count`` batches in order of doc_id go through the index one after another.
    """

    def __init__(self, docs: DataFrame, window: int = 50, batch_count: int = 2, gram: int = GRAM):
        spark = docs.sparkSession
        self.docs, self.window = docs, window
        self.scratch = scratch = Scratch(spark, "substrings")
        known = scratch.store(facts(docs, window, gram), "facts")
        # stored, so that the join's two sides are plain shuffles, of which adaptive execution splits a hot one (as that of empty texts)
        first = scratch.store(known.where(F.col("n_words") >= window).groupBy("sha").agg(F.min("did").alias("first"), F.max("did").alias("last")).where("first < last").drop("last"), "first")
        self.facts = scratch.store(known.join(first, "sha", "left").select("doc_id", "did", "tk", "n_words", "sha", F.coalesce(F.col("did") > F.col("first"), F.lit(False)).alias("copy")), "copies")
        copies = self.facts.where("copy").select("did", "tk").distinct()
        live = scratch.store(known.where(F.size("fps") > 0).select("did", "tk", "fps").join(copies, ["did", "tk"], "left_anti").select("did", F.explode("fps").alias("fp")), "fingerprints")
        scratch.drop(known)
        cuts = live.agg(F.percentile_approx("did", [i / batch_count for i in range(1, batch_count)], 1000)).first()[0] or [] if batch_count > 1 else []
        index, found, low = FingerprintIndex(spark, scratch.path("index")), None, None
        for high in [*cuts, None]:
            part = live if low is None else live.where(F.col("did") > int(low))
            part = part if high is None else part.where(F.col("did") <= int(high))
            more = index.add(part)
            found = more if found is None else found.unionByName(more)
            low = high
        index.compact()
        scratch.drop(live)
        named = index.rows().join(found.distinct(), "fp").groupBy("did").agg(F.collect_set("fp").alias("fps"))
        texts = keyed(docs).select("did", "tk", "text").join(named.hint("shuffle_hash"), "did").join(copies, ["did", "tk"], "left_anti")
        self.texts = scratch.store(texts, "texts")
        index.delete()
        windows = scratch.store(_windows(self.texts, window, gram), "windows")
        spans = _settle(windows.where("fp is not null"), window).unionByName(_decided(windows.where("fp is null"), window))
        self.spans = scratch.store(spans.distinct().groupBy("did", "tk").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
        scratch.drop(windows)


def deduplicate(docs: DataFrame, root: str, window: int = 50, gram: int = GRAM, fan_in: int = 4) -> DataFrame:
    """Add a batch to the index in ``root`` (made, if there is none) and report on the batch: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window over it also starts in a document of an earlier batch or with a smaller doc_id, as if all batches were one
    table. Batches come in order of doc_id, and every row has one: others are refused; a batch that is there already, the same rows,
    gets its report again. A job that is lost on the way leaves the index as it was. The index keeps its runs of fingerprints and the texts
    with windows, from which the windows behind shared fingerprints are read again and compared. Other cases are those of ``Repeats``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "batch")
    known = scratch.store(facts(docs, window, gram), "facts")
    mark = F.sum(F.xxhash64("doc_id", "tk").cast("decimal(38,0)"))
    low, high, nameless, many, mark = known.agg(F.min("did"), F.max("did"), F.count_if(F.col("doc_id").isNull()), F.count("*"), mark).first()
    index = FingerprintIndex(spark, root, fan_in)
    batch = f"{low}-{high}-{many}-{mark}"
    if batch in index.batches:
        index.close()
        return spark.read.schema(REPORT).parquet(index.batches[batch])
    if nameless or low is not None and index.last is not None and low <= index.last:
        raise ValueError("batches must come in order of doc_id, without null ones")
    before = index.last
    if low is None:
        index.close()
        return known.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"))
    live = known.where(F.size("fps") > 0)
    path, report = (f"{root}/{kind}-{uuid.uuid4().hex}" for kind in ("texts", "report"))
    keyed(docs).select("did", "tk", "text").join(live.select("did", "tk").distinct().hint("shuffle_hash"), ["did", "tk"], "left_semi").write.parquet(path)
    found = index.add(scratch.store(live.select("did", F.explode("fps").alias("fp")), "fingerprints"))
    named = index.rows().join(found, "fp").groupBy("did").agg(F.collect_set("fp").alias("fps"))
    texts = scratch.store(spark.read.parquet(*index.texts, path).join(named.hint("shuffle_hash"), "did"), "texts")
    windows = scratch.store(_windows(texts, window, gram), "windows")
    spans = _settle(windows.where("fp is not null"), window).unionByName(_decided(windows.where("fp is null"), window))
    spans = spans if before is None else spans.where(F.col("did") > before)
    spans = scratch.store(spans.distinct().groupBy("did", "tk").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    _reported(known.withColumn("copy", F.lit(False)), texts, spans).write.parquet(report)
    index.note(batch, report, path, high)
    index.close()
    return spark.read.schema(REPORT).parquet(report)


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
CLEANED = "n_words long, n_removed long, kept string"


def _without(rows: DataFrame, keys: list[str], keep_untouched: bool) -> DataFrame:
    """Texts without the words in their spans: kept words joined by blanks, or the text itself where nothing goes."""
    schema = T.StructType([*(rows.schema[k] for k in keys), *T.StructType.fromDDL(CLEANED)])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            n, gone, kept = [], [], []
            for text, spans in zip(_texts(batch, "text"), batch.column("spans").to_pylist(), strict=True):
                words = text.split()
                mask = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    mask[s["start"]] += 1
                    mask[min(s["stop"], len(words))] -= 1
                stays = np.cumsum(mask)[:-1] == 0
                n.append(len(words))
                gone.append(len(words) - int(stays.sum()))
                kept.append(text if not gone[-1] and keep_untouched else b" ".join(words[i] for i in np.flatnonzero(stays).tolist()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.select(*keys, "text", "spans").mapInArrow(run, schema)


def _reported(rows: DataFrame, texts: DataFrame, spans: DataFrame) -> DataFrame:
    cut = _without(texts.join(spans, ["did", "tk"]), ["did", "tk"], False)
    cut = cut.select("did", "tk", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("new_sha")).dropDuplicates(["did", "tk"])
    gone = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    sha = F.when(F.col("copy"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("new_sha", "sha"))
    return rows.join(cut, ["did", "tk"], "left").select("doc_id", "n_words", gone.cast("long").alias("n_removed"), sha.alias("kept_sha256"))


def report(docs: DataFrame, window: int = 50, batch_count: int = 2) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs (see Repeats for the cases)."""
    r = Repeats(docs, window, batch_count)
    return _reported(r.facts, r.texts, r.spans)


def clean(docs: DataFrame, window: int = 50, batch_count: int = 2) -> DataFrame:
    """docs with repeated words taken out of their texts; a document of which nothing is left goes.

    Where words go, the others are joined by one blank; other texts stay as they are, null and empty ones too.
    """
    r = Repeats(docs, window, batch_count)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(LAST).alias("stop")))
    spans = r.spans.unionByName(r.facts.where("copy").select("did", "tk").distinct().withColumn("spans", whole))
    # a row's other columns travel as one, whatever their names are
    row = F.struct(*[F.col(f"`{n}`") for n in docs.columns if n != "text"]).alias("row")
    rows = docs.select(row, "text", did().alias("did"), F.xxhash64("text").alias("tk")).join(spans.hint("shuffle_hash"), ["did", "tk"], "left")
    cut = _without(rows.where("spans is not null").select("row", "text", "spans"), ["row"], True).where("kept <> '' or n_words = 0")
    both = rows.where("spans is null").select("row", "text").unionByName(cut.select("row", F.col("kept").alias("text")))
    return both.select(*[F.col("text") if n == "text" else F.col("row")[n].alias(n) for n in docs.columns])
