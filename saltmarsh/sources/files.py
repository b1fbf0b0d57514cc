"""Files in and out: bars by symbol, trees of mixed formats, JSON with error rows, feeds, and sinks that append or merge."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Extensions that are read, and what a feed's entry needs one of each of.
EXTENSIONS = ("csv", "json", "jsonl", "md", "txt")
TITLE_KEYS = ("title", "headline", "subject")
TIME_KEYS = ("published", "published_at", "publisheddate", "pubdate", "date", "datetime", "timestamp")
LINK_KEYS = ("link", "url", "href")
PREVIEW = 400


def file_stem() -> Column:
    """The name of the file that a row comes from, without folder and extension."""
    # from the name alone: a pattern over whole paths takes longer than reading a row
    name = F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))  # Spark gives the name as in a URI, where a plus is one


def per_symbol_csv(spark: SparkSession, folder: str, schema: str, universe: DataFrame | None = None) -> DataFrame:
    """All CSV files of a folder as one table; the symbol is the file's name. With ``universe`` (code) only its symbols' files are opened.

    The folder is listed first, as Spark does itself on the driver, and the scan is planned over the listed files whose names the universe has.
    Columns not asked for aren't parsed. A value that doesn't fit its type is null.
    """
    reader = spark.read.schema(schema).option("header", True)
    if universe is None:
        return reader.option("pathGlobFilter", "*.csv").csv(folder).withColumn("symbol", file_stem())
    # of the listed files' columns only the path is asked for, so none is opened
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", file_stem().alias("code"))
    wanted = [r["path"] for r in listed.join(universe.select("code"), "code", "left_semi").select("path").collect()]  # files of one folder, as many as were listed at most
    return reader.csv(wanted).withColumn("symbol", file_stem()) if wanted else spark.createDataFrame([], schema).withColumn("symbol", F.lit(None).cast("string"))


def _opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of an absolute URI as Arrow opens it, and the path there."""
    return (pa.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")) if uri.startswith("file:") else pa.fs.FileSystem.from_uri(uri)


def csv_files(df: DataFrame, folder: str, name: str) -> None:
    """Write ``folder/value.csv``, with header, for each value of column ``name`` that isn't null; a value's rows must lie in one partition.

    Tasks have their rows in order of the values and write file after file, each under a name of its own first, so what an attempt leaves behind is no CSV file.
    Spark's writer would make a folder for each value, whose file is left to the driver to rename; that is done where Arrow can't open the file system.
    """
    spark, rows = df.sparkSession, df.where(F.col(name).isNotNull())
    columns = [c for c in df.columns if c != name]
    system, at = _fs(spark, folder)
    uri = at.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    try:
        _opened(uri)
    except (pa.ArrowInvalid, OSError):
        return _csv_folders(rows, folder, name)
    system.mkdirs(at)
    header = (",".join(columns) + "\n").encode()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _opened(uri)
        own = f"{root}/.{uuid.uuid4().hex}"
        now, out, files = None, None, 0
        for batch in batches:
            lines = iter(batch["line"].to_pylist())
            for value, run in groupby(batch["name"].to_pylist()):
                if value != now:
                    if out:
                        out.close()
                        fs.move(own, f"{root}/{now}.csv")
                    now, out, files = value, fs.open_output_stream(own), files + 1
                    out.write(header)
                out.write("".join(f"{next(lines)}\n" for _ in run).encode())
        if out:
            out.close()
            fs.move(own, f"{root}/{now}.csv")
        yield pa.RecordBatch.from_pydict({"files": [files]})

    lines = rows.select(F.col(name).cast("string").alias("name"), F.to_csv(F.struct(*columns)).alias("line"))
    lines.sortWithinPartitions("name").mapInArrow(write, "files long").agg(F.sum("files")).collect()


def _csv_folders(rows: DataFrame, folder: str, name: str) -> None:
    """The same files by Spark's writer: one folder a value becomes one file a value."""
    rows.write.partitionBy(name).csv(folder, header=True)
    system, root = _fs(rows.sparkSession, folder)
    for value in system.listStatus(root):
        if value.isDirectory():
            part = next(f.getPath() for f in system.listStatus(value.getPath()) if f.getPath().getName().endswith(".csv"))
            system.rename(part, rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{value.getPath().getName().removeprefix(f'{name}=')}.csv"))
            system.delete(value.getPath(), True)


def tree(spark: SparkSession, folder: str, extensions: Sequence[str] = EXTENSIONS) -> DataFrame:
    """path, extension, size, modified, text of each file below a folder with one of the extensions, whole."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{{{','.join(extensions)}}}").text(folder, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(path.alias("path"), F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1)).alias("extension"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("text"))


def csv_columns(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Some columns of CSV files as strings; Spark splits large files, so no chunk size is needed. Missing columns are null."""
    rows = spark.read.option("header", True).csv(folder)
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def jsonl(spark: SparkSession, folder: str, schema: str, one_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines by schema, with path, and rows of errors: path, line_no (from 1), reason, raw_preview.

    Large files are read in splits. Only splits with an error have their lines numbered, which is where rows are shuffled;
    the lines before a split are known from counts by split. Blank lines count but give nothing. Reasons: jsonl_parse_error,
    jsonl_row_not_object. ``one_text``: the folder's files are parts of one text in order of their paths, and lines are numbered throughout.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.trim("value").alias("line"))
    reason = F.when(F.col("line") == "", None).when(F.try_parse_json("line").isNull(), "jsonl_parse_error").when(~F.col("line").startswith("{"), "jsonl_row_not_object")
    marked = lines.withColumn("reason", reason)
    good = marked.where("reason is null and line <> ''").select("path", F.from_json("line", schema).alias("r")).select("path", "r.*")
    wrong = marked.where("reason is not null").select("path", "split").distinct()
    before = lines.groupBy("path", "split").count().select("path", "split", F.coalesce(F.sum("count").over((Window.orderBy("path", "split") if one_text else Window.partitionBy("path").orderBy("split")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = Window.partitionBy("path", "split").orderBy("place")
    numbered = marked.withColumn("place", F.monotonically_increasing_id()).join(wrong, ["path", "split"], "left_semi").withColumn("n", F.row_number().over(own)).where("reason is not null")
    bad = numbered.join(before, ["path", "split"]).select("path", (F.col("before") + F.col("n")).alias("line_no"), "reason", F.substring("line", 1, PREVIEW).alias("raw_preview"))
    return good, bad


def feed_entries(files: DataFrame) -> DataFrame:
    """path, feed, place (from 1) and entry, a map of strings, of feeds' JSON texts (path, text): lists, or maps of lists or of entries."""
    rows = files.select("path", F.trim("text").alias("text"))
    # elements and values as JSON texts first: what is no object among them mustn't spoil the others
    listed = rows.where("text like '[%'").select("path", F.lit("").alias("feed"), F.posexplode(F.from_json("text", "array<string>")).alias("at", "v"))
    named = rows.where("text like '{%'").select("path", F.explode(F.from_json("text", "map<string,string>")).alias("feed", "v"))
    lists = named.where("trim(v) like '[%'").select("path", "feed", F.posexplode(F.from_json("v", "array<string>")).alias("at", "v"))
    single = named.where("trim(v) like '{%'").select("path", "feed", F.lit(0).alias("at"), "v")
    objects = listed.unionByName(lists).unionByName(single).where("trim(v) like '{%'")
    return objects.select("path", "feed", (F.col("at") + 1).alias("place"), F.from_json("v", "map<string,string>").alias("entry"))


def _has(entry: Column | str, keys: Sequence[str]) -> Column:
    return F.exists(F.map_entries(entry), lambda e: F.lower(F.trim(e["key"])).isin(*keys) & (F.trim(F.coalesce(e["value"], F.lit(""))) != ""))


def feeds_checked(files: DataFrame, rss: bool = True) -> DataFrame:
    """path and reason of JSON files: invalid_json, empty_json; for feeds also rss_no_entries and rss_missing_required_fields."""
    rows = files.select("path", "text", F.try_parse_json("text").alias("v"))
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"\s", "")
    reason = F.when(F.col("v").isNull(), "invalid_json").when(bare.isin("{}", "[]", "null", '""', "0", "false"), "empty_json")
    rows = rows.select("path", reason.alias("reason"))
    if not rss:
        return rows
    whole = _has("entry", TITLE_KEYS) & _has("entry", TIME_KEYS) & _has("entry", LINK_KEYS)
    per = feed_entries(files).groupBy("path").agg(F.count_if(whole).alias("whole"))
    late = F.when(F.col("whole").isNull(), "rss_no_entries").when(F.col("whole") == 0, "rss_missing_required_fields(title/datetime/url)")
    return rows.join(per, "path", "left").select("path", F.coalesce("reason", late).alias("reason"))


def latest_file(files: DataFrame, n: int = 1) -> DataFrame:
    """The newest files (path, modified), ties to the greater path."""
    return files.orderBy(F.desc("modified"), F.desc("path")).limit(n)


def active_below(paths: DataFrame, prefix: str) -> DataFrame:
    """Active rows (path, is_active) of a path and of what lies below it."""
    return paths.where(F.col("is_active") & ((F.col("path") == prefix) | F.col("path").startswith(prefix.rstrip("/") + "/")))


def upserted(old: DataFrame, new: DataFrame, sync: str) -> DataFrame:
    """The state of a raw tree after a sync: path, size, mtime, sha1, is_active, first_sync, last_sync, action.

    old: such a state without action; new: path, size, mtime, sha1 as found. Rows with equal size and time, or equal content, are
    unchanged; what isn't found any more stays, inactive.
    """
    o, n = old.select("path", F.struct("*").alias("o")), new.select("path", F.struct("size", "mtime", "sha1").alias("n"))
    j = o.join(n, "path", "full")
    same = F.coalesce(((F.col("o.size") == F.col("n.size")) & (F.col("o.mtime") == F.col("n.mtime"))) | (F.col("o.sha1") == F.col("n.sha1")), F.lit(False))
    action = F.when(F.col("n").isNull(), F.when(F.col("o.is_active"), "deactivate").otherwise("gone")).when(F.col("o").isNull(), "insert").when(same, "unchanged").otherwise("update")
    now = [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in ("size", "mtime", "sha1")]
    return j.select("path", *now, F.col("n").isNotNull().alias("is_active"), F.coalesce("o.first_sync", F.lit(sync)).alias("first_sync"), F.when(F.col("n").isNull(), F.col("o.last_sync")).otherwise(F.lit(sync)).alias("last_sync"), action.alias("action"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def saved(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists") -> None:
    """Parquet, or CSV with header, JSON lines or text (one column) for export."""
    writer = df.write.mode(mode)
    writer.csv(path, header=True) if kind == "csv" else getattr(writer, {"jsonl": "json"}.get(kind, kind))(path)


def appended(df: DataFrame, path: str) -> None:
    """Add rows; nothing is rewritten, so repeated keys are for the reader (``last_rows``)."""
    df.write.mode("append").parquet(path)


def last_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Of the rows with one key the last by ``order``."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and new rows, of one key the new one; within a side its rows must be distinct by key."""
    rest = old.join(new.select(*keys), list(keys), "left_anti")
    return rest.select(*new.columns).unionByName(new)


def manifest(spark: SparkSession, run: str, inputs: str, outputs: str, notes: dict[str, str] | None = None) -> DataFrame:
    """run_id, role, path, size, sha256 of each file read and written, and notes: what a run worked on."""
    def files(folder: str, role: str) -> DataFrame:
        f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        return f.select(F.lit(run).alias("run_id"), F.lit(role).alias("role"), "path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.lit(json.dumps(notes or {}, sort_keys=True)).alias("notes"))

    return files(inputs, "input").unionByName(files(outputs, "output"))
