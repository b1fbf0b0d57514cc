"""Search for words in texts by a stored index of postings, newest first.

Texts are filed by segments of time. A segment of the index has a row for each token and block of BLOCK texts that have it: sorted by token, so a reader skips what it
doesn't ask for, and with whole numbers that ascend within a block, so Parquet keeps them in few bits. A search goes through the segments from the newest
on, some at first and twice as many each time, until it has found enough; older segments aren't opened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import stored

#: Texts a block; the segment of texts without a time, which comes behind all others.
BLOCK, NONE = 512, "0"
TOKEN = r"[^\p{L}\p{N}]+"


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, TOKEN), lambda t: t != ""))


def build(rows: DataFrame, folder: str, segment: Column | None = None) -> None:
    """Write texts (id, updated, text; other columns stay with them) and their index into a folder that has neither yet.

    ``segment`` is a text that ascends with ``updated``, by default its month. Texts are lower-cased; null ones have no words, and null times come last.
    """
    segment = F.date_format("updated", "yyyy-MM") if segment is None else segment
    texts = rows.withColumns({"_segment": F.coalesce(F.nullif(segment, F.lit("")), F.lit(NONE)), "_text": F.lower(F.coalesce("text", F.lit("")))})
    own = Window.partitionBy("_segment", F.spark_partition_id()).orderBy("id")
    # numbers within a segment: the part that a task writes, and the place in it
    placed = texts.repartition("_segment", F.pmod(F.xxhash64("id"), F.lit(8))).withColumn("_place", (F.spark_partition_id().cast("long") * (1 << 32)) + F.row_number().over(own))
    placed.write.partitionBy("_segment").parquet(f"{folder}/texts")
    read = rows.sparkSession.read.schema(placed.schema).parquet(f"{folder}/texts")
    postings = read.select("_segment", F.explode(_tokens(F.col("_text"))).alias("token"), "_place")
    block = F.floor((F.row_number().over(Window.partitionBy("_segment", "token").orderBy("_place")) - 1) / BLOCK).cast("int")
    blocks = postings.withColumn("block", block).groupBy("_segment", "token", "block").agg(F.array_sort(F.collect_list("_place")).alias("places"))
    blocks.repartition("_segment").sortWithinPartitions("_segment", "token", "block").write.partitionBy("_segment").parquet(f"{folder}/postings")


def scan(rows: DataFrame, words: Sequence[str], n: int) -> DataFrame:
    """The newest texts (id, updated, text) that contain all words, by reading each; ties to the smaller id."""
    ok = F.lit(True)
    for w in words:
        ok = ok & F.contains(F.lower("text"), F.lit(w.lower()))
    return rows.where(ok).orderBy(F.col("updated").desc_nulls_last(), "id").limit(n)


def runs_of(word: str) -> list[str]:
    """A word's runs of letters and digits."""
    out, run = [], ""
    for c in [*word, " "]:
        if c.isalpha() or c.isnumeric():
            run += c
        elif run:
            out.append(run)
            run = ""
    return out


class Found:
    """What a search gives: ``rows``, and how many segments and postings it read."""

    def __init__(self, rows: DataFrame, segments: int, postings: int):
        self.rows, self.segments, self.postings = rows, segments, postings


def search(rows_like: DataFrame, folder: str, words: Sequence[str], n: int) -> Found:
    """As ``scan`` of the texts that were filed, whose columns ``rows_like`` has. A word may be part of one or go over several: tokens nominate texts, which are then read."""
    spark = rows_like.sparkSession
    words = [w.lower() for w in words]
    parts = sorted({p for w in words for p in runs_of(w)})
    filed = T.StructType([*rows_like.schema.fields, *T.StructType.fromDDL("_text string, _place long, _segment string")])
    texts, index = spark.read.schema(filed).parquet(f"{folder}/texts"), spark.read.schema("token string, block int, places array<long>, _segment string").parquet(f"{folder}/postings")
    # a row a segment, some bytes each: the names of folders
    names = sorted((r[0] for r in texts.select(F.col("_segment").cast("string")).distinct().collect()), reverse=True)
    found, at, many, read = None, 0, 1, 0
    while at < len(names):
        some = names[at : at + many]
        here = texts.where(F.col("_segment").cast("string").isin(some))
        if parts:
            asked = F.lit(False)
            for p in parts:
                asked = asked | F.contains("token", F.lit(p))
            hits = stored(index.where(F.col("_segment").cast("string").isin(some) & asked).select("_segment", "token", F.explode("places").alias("_place")), "hits")
            both = hits.groupBy("_segment", "_place").agg(*[F.bool_or(F.contains("token", F.lit(p))).alias(f"_h{i}") for i, p in enumerate(parts)])
            for i in range(len(parts)):
                both = both.where(f"_h{i}")
            both = stored(both.select("_segment", "_place"), "candidates")
            read += hits.count()
            here = here.join(both, ["_segment", "_place"], "left_semi")
        for w in words:
            here = here.where(F.contains("_text", F.lit(w)))
        here = stored(here.select(*rows_like.columns), "found")
        found = here if found is None else found.unionByName(here)
        at += len(some)
        many *= 2
        if found.count() >= n:
            break
    out = rows_like.limit(0) if found is None else found.orderBy(F.col("updated").desc_nulls_last(), "id").limit(n)
    return Found(out, at, read)
