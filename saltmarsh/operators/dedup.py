"""Greedy removal of duplicate documents by several keys, and incremental processing of changed inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored
from ..sources import commits


def _keys_of(i: int, kind: str) -> Column:
    return F.transform(F.coalesce(kind, F.array().cast("array<string>")), lambda x: F.struct(F.lit(i).alias("k"), x.alias("v")))


def _key_rows(documents: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return documents.select("id", F.explode(F.array_distinct(F.concat(*[_keys_of(i, k) for i, k in enumerate(kinds)]))).alias("key")).where("key.v is not null and key.v <> ''").select("id", "key.k", "key.v")


def _parents(undecided: DataFrame) -> DataFrame:
    """id, ok and parent: ok, if a document comes first in all its keys; parent, if all that come before it in its keys are one document."""
    first = undecided.groupBy("k", "v").agg(F.min("id").alias("first"))
    with_first = undecided.join(first, ["k", "v"])
    second = with_first.where(F.col("id") > F.col("first")).groupBy("k", "v").agg(F.min("id").alias("second"))
    is_first, is_second = F.col("id") == F.col("first"), F.col("id") == F.col("second")
    before = F.when(is_second, F.col("first"))
    rows = with_first.join(second, ["k", "v"], "left").groupBy("id").agg(F.bool_and(is_first).alias("ok"), F.bool_or(~is_first & ~is_second).alias("more"), F.min(before).alias("lo"), F.max(before).alias("hi"))
    return rows.select("id", "ok", F.when(~F.col("ok") & ~F.col("more") & (F.col("lo") == F.col("hi")), F.col("lo")).alias("parent"))


def _chained(parents: DataFrame) -> DataFrame:
    """id, end, odd of documents with a parent: the first of their line that has none, and whether the number of steps to it is odd. Steps double each round."""
    line = stored(parents.where("parent is not null").select("id", F.col("parent").alias("end"), F.lit(True).alias("odd")), "chain")
    while not line.join(line.select(F.col("id").alias("end")), "end", "left_semi").isEmpty():
        on = line.select(F.col("id").alias("_id"), F.col("end").alias("_end"), F.col("odd").alias("_odd"))
        line = stored(line.join(on, F.col("end") == F.col("_id"), "left").select("id", F.coalesce("_end", "end").alias("end"), (F.col("odd") != F.coalesce("_odd", F.lit(False))).alias("odd")), "chain")
    return line


def _owners(keys: DataFrame) -> DataFrame | None:
    """id, k, v of the documents of stored keys that are kept; None where there are no keys."""
    undecided, owners = keys, None
    while not undecided.isEmpty():
        parents = stored(_parents(undecided), "parents")
        roots = parents.where("ok").select("id")
        # who has one document before it, alone, is kept if that one isn't: along a line of such documents every other one is
        every_other = _chained(parents).where("not odd").join(roots.withColumnRenamed("id", "end"), "end", "left_semi").select("id")
        new = stored(undecided.join(roots.unionByName(every_other), "id", "left_semi"), "kept")
        owners = new if owners is None else owners.unionByName(new)
        gone = undecided.join(new.select("k", "v").distinct(), ["k", "v"], "left_semi").select("id").distinct()
        undecided = stored(undecided.join(gone, "id", "left_anti"), "undecided")
    return owners


def greedy(documents: DataFrame, kinds: Sequence[str] = ("url", "title_date", "content"), registry: DataFrame | None = None) -> DataFrame:
    """id, kept, kind, matched: documents in order of id, each a duplicate if a kept one before it has one of its keys.

    documents: id and an array of keys a kind. Duplicates register nothing, so a key counts for its first *kept* owner. ``kind`` is
    the first in order of those shared, ``matched`` the owner there. With a registry (kind, v, owner) of earlier runs, its keys have their owners
    already, and every document comes behind those.

    A round keeps what comes first in all its keys, and every other document along lines whose members each depend on one other; such lines are followed with
    doubling steps. What shares a key with a kept one is out. A round is some joins on keys, none gathers a key's documents. Only documents that wait for
    several others, which wait in turn, need further rounds.
    """
    keys = stored(_key_rows(documents, kinds), "keys")
    known = None
    if registry is not None:
        number = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")) - 1
        known = registry.where(F.col("kind").isin(*kinds)).select(number.cast("int").alias("k"), "v", "owner")
    fresh = keys
    if known is not None:
        met = keys.join(known.select("k", "v"), ["k", "v"], "left_semi").select("id").distinct()
        fresh = stored(keys.join(met, "id", "left_anti"), "fresh")
    found = _owners(fresh)
    owners = None if found is None else found.withColumnRenamed("id", "owner").withColumn("now", F.lit(True))
    if known is not None:
        earlier = known.withColumn("now", F.lit(False))
        owners = earlier if owners is None else owners.unionByName(earlier)
    if owners is None:
        return documents.select("id", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast(documents.schema["id"].dataType).alias("matched"))
    # each key has one owner; documents without keys are kept
    hits = keys.join(owners, ["k", "v"]).where("not now or owner < id").groupBy("id").agg(F.min(F.struct("k", "owner")).alias("m"))
    name = F.when(F.col("m").isNotNull(), F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("m.k") + 1))
    return documents.select("id").join(hits, "id", "left").select("id", F.col("m").isNull().alias("kept"), name.alias("kind"), F.col("m.owner").alias("matched"))


def registered(documents: DataFrame, decided: DataFrame, kinds: Sequence[str] = ("url", "title_date", "content")) -> DataFrame:
    """kind, v and owner of the keys of documents that were kept (id, kept): what a registry gains by a run."""
    kept = _key_rows(documents, kinds).join(decided.where("kept").select("id"), "id", "left_semi")
    return kept.select(F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("k") + 1).alias("kind"), "v", F.col("id").alias("owner"))


def deduplicated(documents: DataFrame, registry: commits.Table, run: str, kinds: Sequence[str] = ("url", "title_date", "content")) -> DataFrame:
    """``greedy`` against a stored registry, which then has the kept documents' keys; ids grow from run to run.

    The registry gains a run's keys in one entry of its log, after the run's decisions are stored; where another run has come in between, that is a
    ``Conflict`` and nothing is registered, so the run can be repeated on the newer registry.
    """
    entry = registry.entry()
    known = registry.read(entry) if entry else None
    decided = stored(greedy(documents, kinds, known), "decided")
    registry.extend(registered(documents, decided, kinds), run, entry)
    return decided


def bootstrapped(keys: DataFrame) -> DataFrame:
    """The registry (kind, v, owner) that an earlier run's documents (id, kind, v) make up; the first with a key owns it."""
    return keys.where("v is not null and v <> ''").groupBy("kind", "v").agg(F.min("id").alias("owner"))


def against_registry(keys: DataFrame, registry: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """id, kind, owner: for each document (id, kind, v) the first kind in order by which another one is registered (kind, v, owner), and that one; else null."""
    order = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    met = keys.join(registry, ["kind", "v"]).where("owner <> id").groupBy("id").agg(F.min(F.struct(order.alias("o"), "owner", "kind")).alias("m"))
    return keys.select("id").distinct().join(met, "id", "left").select("id", F.col("m.kind").alias("kind"), F.col("m.owner").alias("owner"))


def first_records(records: DataFrame, order: Sequence[Column | str], by: Sequence[str] = ("record_id", "fingerprint")) -> DataFrame:
    """First by one key, then, among what is left, by the next: what goes on the first registers nothing for the second."""
    for key in by:
        r = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        records = records.withColumn("_r", r).where((F.col("_r") == 1) | F.col(key).isNull()).drop("_r")
    return records


def signature(*parts: Column | str) -> Column:
    """What an input's processing depends on."""
    return F.sha1(F.concat_ws("|", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]))


def changed(inputs: DataFrame, index: DataFrame) -> DataFrame:
    """Inputs (path, signature) that an index (path, signature, complete) doesn't hold complete with the same signature."""
    done = index.where("complete").select("path", F.col("signature").alias("_s"))
    return inputs.join(done, "path", "left").where("not (signature <=> _s)").drop("_s")


def needs_enrichment(text: Column | str, urls: Column, short: int = 80, least: float = 0.55) -> Column:
    """Short with a URL, or mostly URLs."""
    c = F.col(text) if isinstance(text, str) else text
    bare = F.length(F.regexp_replace(c, r"https?://\S+", ""))
    return (F.size(urls) > 0) & ((F.length(c) < short) | (bare / F.greatest(F.length(c), F.lit(1)) < least))


def injected(blocks: DataFrame, most: int = 12, cap: int = 4000) -> DataFrame:
    """Per document its first blocks (doc, place, text) not in the base text nor repeated, up to a total length; the last is cut."""
    first = F.row_number().over(Window.partitionBy("doc", "text").orderBy("place"))
    own = Window.partitionBy("doc").orderBy("place")
    rows = blocks.withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= most).withColumn("_r", first).where((F.col("_r") == 1) & ~F.contains("base", F.col("text")))
    before = F.coalesce(F.sum(F.length("text")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_b", before).where(F.col("_b") < cap)
    return rows.select("doc", "place", F.substring("text", F.lit(1), (F.lit(cap) - F.col("_b")).cast("int")).alias("text"))
