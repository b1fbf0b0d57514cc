"""Joins of market tables, ledgers and texts, each with its rule for repeats and misses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored
from .validation import to_number


def last_of(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key; aggregated, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def with_signal(bars: DataFrame, features: DataFrame) -> DataFrame:
    """bars with qualitative_signal, clipped to +-1, of their symbol and day (last row wins; 0 and missing = 1 without)."""
    own = last_of(features.select("symbol", "date", "row_no", F.greatest(F.least(F.coalesce(to_number(F.col("qualitative_signal").cast("string")), F.lit(0.0)), F.lit(1.0)), F.lit(-1.0)).alias("s")), ["symbol", "date"], "row_no")
    joined = bars.join(own.select("symbol", "date", F.col("s").alias("_s")), ["symbol", "date"], "left")
    return joined.withColumns({"qualitative_signal": F.coalesce("_s", F.lit(0.0)), "missing": F.col("_s").isNull().cast("int")}).drop("_s")


def spread(series: DataFrame, a: str, b: str) -> DataFrame:
    """date and the difference of two series on their common days."""
    x, y = (series.where(F.col("series") == s).select("date", F.col("value").alias(n)) for s, n in ((a, "x"), (b, "y")))
    return x.join(y, "date").select("date", (F.col("x") - F.col("y")).alias("spread"))


def paired(expected: DataFrame, actual: DataFrame, phases: Sequence[Sequence[Column | str]]) -> DataFrame:
    """One-to-one pairs, phase by phase: within a key both sides count off in order of (ts, row_no); pairs leave the pool.

    Rows with a null in a phase's key wait for the next. Returns phase, e_row, a_row.
    """
    found: list[DataFrame] = []

    def counted(df: DataFrame, keys: Sequence[Column | str], side: str) -> DataFrame:
        named = [(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)]
        rows = df.select(*named, "ts", "row_no").dropna(subset=[f"k{i}" for i in range(len(keys))])
        ks = [f"k{i}" for i in range(len(keys))]
        return rows.select(*ks, F.col("row_no").alias(side), F.row_number().over(Window.partitionBy(*ks).orderBy("ts", "row_no")).alias("n"))

    for i, keys in enumerate(phases, 1):
        ks = [f"k{j}" for j in range(len(keys))]
        # stored: each later phase would compute the earlier ones again, twice
        pairs = stored(counted(expected, keys, "e_row").join(counted(actual, keys, "a_row"), [*ks, "n"]).select(F.lit(i).alias("phase"), "e_row", "a_row"), "pairs")
        found.append(pairs)
        expected = expected.join(pairs.select(F.col("e_row").alias("row_no")), "row_no", "left_anti")
        actual = actual.join(pairs.select(F.col("a_row").alias("row_no")), "row_no", "left_anti")
    return reduce(DataFrame.unionByName, found)


def words_known(texts: DataFrame, names: DataFrame) -> DataFrame:
    """id, name, entry of texts' words that are names; of a repeated name the first entry. An equi-join on words."""
    first = names.groupBy("name").agg(F.min("entry").alias("entry"))
    words = texts.select("id", F.explode(F.array_distinct(F.split("text", r"[^\w]+"))).alias("name"))
    return words.join(first, "name").select("id", "name", "entry")


def compared_ids(wanted: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """key and status: missing, unexpected or duplicate (among those got)."""
    missing = wanted.select(key).join(got, key, "left_anti").distinct().withColumn("status", F.lit("missing"))
    extra = got.select(key).join(wanted, key, "left_anti").distinct().withColumn("status", F.lit("unexpected"))
    twice = got.groupBy(key).count().where("count > 1").select(key).withColumn("status", F.lit("duplicate"))
    return missing.unionByName(extra).unionByName(twice)


def unequal_weights(a: DataFrame, b: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Rows (date, code) whose weights differ by more than the tolerance or stand on one side only."""
    both = a.select("date", "code", F.col("weight").alias("a")).join(b.select("date", "code", F.col("weight").alias("b")), ["date", "code"], "full")
    return both.where(F.coalesce(F.abs(F.col("a") - F.col("b")) > tolerance, F.lit(True)))


def page_mismatches(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents whose stated number of pages isn't that of their page rows."""
    counts = pages.groupBy("doc_key").agg(F.count("*").alias("found"))
    return documents.join(counts, "doc_key", "left").withColumn("found", F.coalesce("found", F.lit(0))).where("found <> stated").select("doc_key", "stated", "found")


#: Tasks of a resource that meet in one place; those of one that more tasks want are dealt to places for each two of their tiles.
TILE = 1024


def conflicts(tasks: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs (a < b) of active tasks (id, active, resources) that want a common resource.

    A pair is found at the smallest resource that both want and nowhere else, so no pairs are compared with each other. The pairs of a resource that n tasks want are n * (n - 1) / 2,
    made in pieces of at most ``tile`` squared. Rows of one id are one task's; null ids and resources conflict with nothing.
    """
    wants = tasks.where("active and id is not null").select("id", F.array_compact(F.coalesce("resources", F.array())).alias("rs")).groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("rs")))).alias("rs"))
    rows = stored(wants.select("id", "rs", F.explode("rs").alias("r")), "wants")
    sizes = rows.groupBy("r").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"), F.count("*").alias("n")).where("n > 1")
    dealt = rows.join(sizes.drop("n"), "r").withColumn("t", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("r", F.least("t", "o").alias("low"), F.greatest("t", "o").alias("high"), "t", "id", "rs")
    x, y = dealt.where("t = low").alias("x"), dealt.where("t = high").alias("y")
    met = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("r", "low", "high")]).where("x.low < x.high or x.id < y.id")
    once = met.where(F.get(F.array_intersect("x.rs", "y.rs"), F.lit(0)) == F.col("x.r"))
    return once.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def ready(tasks: DataFrame) -> DataFrame:
    """id, ready: all tasks that it refers to are DONE (a missing one isn't; no reference is ready)."""
    refs = tasks.select("id", F.explode("refs").alias("ref"))
    states = refs.join(tasks.select(F.col("id").alias("ref"), "status"), "ref", "left").groupBy("id").agg(F.bool_and(F.coalesce(F.col("status") == "DONE", F.lit(False))).alias("ready"))
    return tasks.select("id").join(states, "id", "left").withColumn("ready", F.coalesce("ready", F.lit(True)))


def resolved(blocks: DataFrame, explicit: DataFrame, flat: DataFrame, legacy: DataFrame) -> DataFrame:
    """Each block's artifact by the first way that finds one, with confidence; a foreign identifier makes it a mismatch.

    blocks: block_id, marker, flat_key, legacy_key, message_id; the others: key, path, owner (one row a key).
    """
    j = blocks
    for name, key, side in (("e", "marker", explicit), ("f", "flat_key", flat), ("l", "legacy_key", legacy)):
        j = j.join(side.select(F.col("key").alias(key), F.struct("path", "owner").alias(name)), key, "left")
    hit = F.coalesce("e", "f", "l")
    way = F.when(F.col("e").isNotNull(), "strong").when(F.col("f").isNotNull(), "medium").when(F.col("l").isNotNull(), "weak").otherwise("none")
    off = hit.isNotNull() & (hit["owner"] != F.col("message_id"))
    return j.select("block_id", hit["path"].alias("path"), way.alias("confidence"), F.when(off, "lineage_mismatch").when(hit.isNull(), "unresolved").otherwise("ok").alias("status"), (off | (way == "weak")).alias("diagnostics_only"))


def promoted(messages: DataFrame, found: DataFrame) -> DataFrame:
    """Messages cut at ``---``, with the text found for a block appended to it, joined again; and how many blocks got one."""
    blocks = messages.select("id", F.posexplode(F.split("text", "---")).alias("block", "part"))
    rows = blocks.join(found.select("id", "block", F.col("text").alias("more")), ["id", "block"], "left")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", F.concat("part", F.coalesce("more", F.lit(""))).alias("t")))), lambda x: x["t"]), "---")
    return rows.groupBy("id").agg(whole.alias("text"), F.count("more").alias("promoted"))


def sidecars(items: DataFrame, side: DataFrame) -> DataFrame:
    """Sidecar text by path; one made for other content (both hashes known and different) is ignored.

    Each item stays one row. Of several sidecars of a path that fit, one made for the same content goes before one of unknown content, then the smallest text.
    """
    known = side.where("sha1 is not null").groupBy("path", "sha1").agg(F.min("sidecar").alias("_known"))
    every = side.groupBy("path").agg(F.min("sidecar").alias("_any"), F.min(F.when(F.col("sha1").isNull(), F.col("sidecar"))).alias("_free"))
    found = items.join(known, ["path", "sha1"], "left").join(every, "path", "left")
    text = F.when(F.col("sha1").isNull(), F.col("_any")).otherwise(F.coalesce("_known", "_free"))
    return found.select(*[F.col(c) for c in items.columns if c != "sidecar"], text.alias("sidecar"))
