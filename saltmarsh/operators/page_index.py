"""A stored index of documents and their pages, in buckets of documents: a refresh rewrites the buckets of what has changed and no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import stored
from .aggregates import page_grade

BUCKETS = 64
#: Rows of a bucket that a task writes into one file, about: buckets that grow get more files and not larger ones.
FILE_ROWS = 500_000
DOCUMENTS = "doc_key string, channel string, kind string, message_date date, declared_pages int, signature string, bucket int"
PAGES = "doc_key string, page_no int, text_chars long, has_render boolean, bucket int"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_key"), F.lit(BUCKETS)).cast("int")


class PageIndex:
    """Tables ``documents`` and ``pages`` below a folder, each a folder a bucket."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def documents(self) -> DataFrame:
        return self._read("documents", DOCUMENTS)

    def pages(self) -> DataFrame:
        return self._read("pages", PAGES)

    def refresh(self, documents: DataFrame, pages: DataFrame) -> list[int]:
        """Make the index that of documents (doc_key, channel, kind, message_date, declared_pages, signature) and pages (doc_key, page_no, text_chars, has_render).

        All pages of new documents, and of those whose signature isn't the stored one, are replaced; documents that aren't there any more go with their pages; rows
        of one doc_key are one document, the greatest signature's. Pages count once a number from 1 on, the one with most text; those that are declared and missing are
        empty ones. Pages are written before documents, so that a refresh that was lost on its way is made again by the next. Returns the buckets that were rewritten.
        """
        columns = DOCUMENTS.replace(" string", "").replace(" date", "").replace(" int", "").split(", ")
        latest = documents.where("doc_key is not null").groupBy(F.col("doc_key").cast("string").alias("doc_key")).agg(F.max_by(F.struct(*[F.col(c) for c in columns[1:-1]]), F.coalesce("signature", F.lit(""))).alias("d")).select("doc_key", "d.*").withColumn("bucket", _bucket())
        old = self.documents()
        both = latest.withColumn("now", F.lit(True)).join(old.select("doc_key", F.col("bucket").alias("b"), F.col("signature").alias("s"), F.lit(True).alias("was")), "doc_key", "full")
        same = F.col("now") & F.col("was") & F.col("signature").eqNullSafe(F.col("s"))
        # with all their columns, as what the given documents are made of would be worked out again for each later step
        changed = stored(both.where(~F.coalesce(same, F.lit(False))).select(*columns[:-1], F.coalesce("bucket", "b").alias("bucket"), F.col("now").isNotNull().alias("present")), "changed")
        touched = sorted(r[0] for r in changed.select("bucket").distinct().collect())  # BUCKETS rows at most
        if not touched:
            return []
        fresh = changed.where("present").drop("present")
        given = pages.select(F.col("doc_key").cast("string").alias("doc_key"), F.col("page_no").cast("int").alias("page_no"), F.coalesce(F.col("text_chars").cast("long"), F.lit(0)).alias("text_chars"), F.coalesce("has_render", F.lit(False)).alias("has_render")).where("page_no > 0")
        declared = fresh.where("declared_pages > 0").select("doc_key", F.explode(F.sequence(F.lit(1), F.col("declared_pages"))).alias("page_no"), F.lit(None).cast("long").alias("text_chars"), F.lit(None).cast("boolean").alias("has_render"))
        every = given.join(fresh.select("doc_key"), "doc_key", "left_semi").unionByName(declared).groupBy("doc_key", "page_no")
        new = every.agg(F.coalesce(F.max("text_chars"), F.lit(0)).alias("text_chars"), F.coalesce(F.max("has_render"), F.lit(False)).alias("has_render")).withColumn("bucket", _bucket())
        for name, schema, rows in (("pages", PAGES, new), ("documents", DOCUMENTS, fresh)):
            rest = self._read(name, schema).where(F.col("bucket").isin(touched)).join(changed.select("doc_key"), "doc_key", "left_anti")
            names = [x.split(" ")[0] for x in schema.split(", ")]
            # stored first: a bucket can't be read while it is written
            whole = stored(rest.select(*names).unionByName(rows.select(*names)), name)
            sizes = {r["bucket"]: r["count"] for r in whole.groupBy("bucket").count().collect()}  # BUCKETS rows at most
            shares = -(-max(sizes.values(), default=0) // FILE_ROWS)
            dealt = whole.repartition(len(sizes) * shares, "bucket", F.pmod(F.hash("doc_key"), F.lit(shares))) if shares > 1 else whole.repartition("bucket")
            dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.folder}/{name}")
            for bucket in set(touched) - sizes.keys():  # nothing is left of these, so nothing has taken their place
                path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/bucket={bucket}")
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return touched

    def graded(self) -> DataFrame:
        """Documents with page rows, pages with text and with a picture, empty ones, and the grade of their text."""
        per = self.pages().groupBy("doc_key").agg(F.count("*").alias("pages"), F.count_if(F.col("text_chars") > 0).alias("with_text"), F.count_if("has_render").alias("with_render"), F.count_if((F.col("text_chars") <= 0) & ~F.col("has_render")).alias("placeholders"))
        rows = self.documents().drop("bucket").join(per, "doc_key", "left").fillna(0, ["pages", "with_text", "with_render", "placeholders"])
        return rows.withColumn("grade", page_grade(F.col("pages"), F.col("with_text")))

    def totals(self) -> DataFrame:
        """what (all, month, kind, grade), key, documents, pages, with_text, with_render, placeholders, channels, first and last date."""
        rows = self.graded()
        sums = [F.count("*").alias("documents"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "with_text", "with_render", "placeholders")], F.count_distinct("channel").alias("channels"), F.min("message_date").alias("first"), F.max("message_date").alias("last")]
        keys = {"all": F.lit(""), "month": F.date_format("message_date", "yyyy-MM"), "kind": F.col("kind"), "grade": F.col("grade")}
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("what"), F.coalesce(k, F.lit("")).alias("key")) for n, k in keys.items()])).alias("_k")
        # one pass for all keys: grades are sums over all pages
        return rows.select("*", each).groupBy("_k.key", "_k.what").agg(*sums).select("key", "documents", "pages", "with_text", "with_render", "placeholders", "channels", "first", "last", "what")
