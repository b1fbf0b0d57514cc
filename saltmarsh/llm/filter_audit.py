"""What each of five filters removes in every order of applying them, by a lattice of the sets of filters applied already.

An order of filters is a path of five edges through the lattice of their 32 subsets: at the edge (applied, next) stand the documents that
pass all of ``applied``, and ``next`` removes those of them that fail it. There are 80 such edges (five filters, sixteen subsets of the others) and 600 steps of
the 120 orders, so documents are counted on edges once, and a join lays the edges along the orders' steps.

All that an edge asks of a document is which filters it fails, so documents are first counted by part, set of failed filters and
labels: at most 32 rows a part take part in what follows. Only identifiers, digests of texts and counts are shuffled, never texts.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Filters, in the order of their bits in a set.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
WHOLE = (1 << len(FILTERS)) - 1
#: A word is a longest run of other characters; a space behind it in a class of characters.
SPACE = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = "#$%&*|"
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5


def own_failures(text: Column | str) -> Column:
    """The set of filters A to D that a text fails, as bits. A: too few words; B: too few distinct ones; C: many capitals; D: a sign of SIGNS."""
    return F.transform(F.array(F.col(text) if isinstance(text, str) else text), _own)[0]


def _own(t: Column) -> Column:
    words = F.filter(F.split(t, f"[{SPACE}]+"), lambda w: w != "")

    def judged(w: Column) -> Column:
        fails = [
            F.size(w) < LEAST_WORDS,
            F.lit(100) * F.size(F.array_distinct(w)) < F.lit(DISTINCT_PERCENT) * F.size(w),
            F.lit(100) * F.length(F.regexp_replace(t, "[^A-Z]+", "")) > F.lit(UPPER_PERCENT) * F.length(t),
            t.rlike(f"[{SIGNS}]"),
        ]
        return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails[1:], 1)), fails[0].cast("int"))

    return F.transform(F.array(words), judged)[0]


def failures(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """part, fails (bits of FILTERS), good, toxic, n: how many rows of documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), own_failures(text).alias("fails"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    keys = ["digest", "part", "fails", "good", "toxic"]
    marked = rows.join(marks, "doc_id", "left").select("doc_id", "digest", "part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # rows of a text by part and labels, with how many of them have the smallest doc_id
    one = marked.groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    texts = scratch.store(one.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("unnumbered")), "texts")
    first = texts.groupBy("digest").agg(F.min("least").alias("first"))
    joined = texts.join(first, "digest").select("part", "fails", "good", "toxic", "n", (F.coalesce("unnumbered", F.lit(0)) + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)).alias("originals"))
    either = F.explode(F.array(F.struct(F.col("fails"), F.col("originals").alias("n")), F.struct((F.col("fails") + COPY).alias("fails"), (F.col("n") - F.col("originals")).alias("n"))))
    split = joined.select("part", "good", "toxic", either.alias("x")).select("part", "good", "toxic", "x.*")
    out = scratch.store(split.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n")), "counted")
    scratch.drop(texts)
    return out


def edges(counted: DataFrame) -> DataFrame:
    """For each part and each of the 80 edges (applied, next): the documents kept, removed, and so on, and each filter's shapley."""
    lattice = F.array(*[F.struct(F.lit(s).alias("applied"), F.lit(f).alias("next"), F.lit(1 << f).alias("bit"), F.lit(factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())).cast("long").alias("orders")) for f in range(len(FILTERS)) for s in range(WHOLE + 1) if not s >> f & 1])
    n = F.col("n")
    alive = F.col("fails").bitwiseAND(F.col("applied")) == 0
    failing = F.col("fails").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).alias(name)

    # at most 32 sets of failed filters and four pairs of labels a part stand here, whatever the number of documents
    met = counted.withColumn("edge", F.explode(lattice)).select("part", "fails", "good", "toxic", "n", "edge.*")
    out = met.groupBy("part", "applied", "next", "orders").agg(
        total(alive & ~failing, "kept"),
        total(alive & failing, "removed"),
        total(~alive & failing, "redundant"),
        total(F.col("fails") == F.col("bit"), "unique_fails"),
        total(alive & failing & F.col("good"), "good_lost"),
        total(alive & failing & F.col("toxic"), "toxic_lost"),
    )
    shares = out.groupBy("part", "next").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    return out.drop("orders").join(shares, ["part", "next"])


def steps(spark) -> DataFrame:
    """The 600 steps of the 120 orders: filter_order, step (from 1), applied, next."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        applied = 0
        for k, f in enumerate(order, 1):
            rows.append(("".join(FILTERS[i] for i in order), k, applied, f))
            applied |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, applied int, next int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step (1 to 5; its filter is that letter), zeros included.

    A part is a value of ``source``; null belongs to the empty string. Documents are rows: one that is repeated counts again, and isn't a copy of itself, as
    E asks for a smaller doc_id. A null text is an empty one (it fails A only, and E where another empty text has a smaller doc_id). A row without doc_id
    neither fails E nor makes others fail it, and has no labels; of several label rows of a doc_id, any that says 1 counts.
    Other columns are ignored; no documents give no rows.
    """
    out = edges(failures(docs, labels, Scratch(docs.sparkSession, "audit"))).join(F.broadcast(steps(docs.sparkSession)), ["applied", "next"])  # 600 rows
    return out.select("part", "filter_order", "step", *(F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")))


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
             CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS fails
      FROM w JOIN f USING (text) LEFT JOIN l USING (doc_id) GROUP BY ALL),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM b a, b b, b c, b d, b e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, b.bit, coalesce((SELECT sum(x.bit) FROM b x WHERE contains(left(filter_order, step - 1), x.c)), 0)::INTEGER AS applied, b.c
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step), b WHERE substr(filter_order, step, 1) = b.c),
r AS (SELECT part, filter_order, step, c,
             sum(CASE WHEN fails & (applied | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN fails & applied = 0 AND fails & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN fails & applied <> 0 AND fails & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN fails & applied = 0 AND fails & bit <> 0 AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN fails & applied = 0 AND fails & bit <> 0 AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
      FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, c)::BIGINT AS shapley FROM r"""
