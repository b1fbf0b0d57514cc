"""Ordered selections: priorities, caps, quotas, leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A task's priority in order.
PRIORITIES = ("P0", "P1", "P2", "P3")
BUCKETS = ("active", "backlog", "done")


def place_in(c: Column | str, names) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(len(names))
    for i, n in reversed(list(enumerate(names))):
        out = F.when(c == n, i).otherwise(out)
    return out


def article_priority(hits: Column, recency: Column, weight: float, sitemap: Column, bonus: Column, paywall: Column, penalty: float = 15.0) -> Column:
    """10 a hit, weighted recency, 2 for a sitemap, the source's bonus, less a penalty behind a paywall."""
    return hits * 10 + recency * weight + F.when(sitemap, 2.0).otherwise(0.0) + bonus - F.when(paywall, penalty).otherwise(0.0)


def capped(items: DataFrame, group: str, cap: int, order: list[Column]) -> DataFrame:
    """The first ``cap`` items of each group in an order."""
    return items.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_r") <= cap).drop("_r")


def quota_then_fill(items: DataFrame, group: str, quota: int, most: int, score: str, key: str) -> DataFrame:
    """First each group's best up to a quota, then the best of the rest, at most ``most`` in all."""
    own = Window.partitionBy(group).orderBy(F.desc(score), key)
    first = items.withColumn("_q", (F.row_number().over(own) <= quota).cast("int"))
    return first.orderBy(F.desc("_q"), F.desc(score), key).limit(most).drop("_q")


def leaders(items: DataFrame, score: str, key: str, n: int = 10) -> DataFrame:
    return items.orderBy(F.desc(score), key).limit(n)


def task_order(tasks: DataFrame, n: int) -> DataFrame:
    """The next tasks: by priority, bucket, sort_order, id."""
    return tasks.orderBy(place_in("priority", PRIORITIES), place_in("bucket", BUCKETS), "sort_order", "id").limit(n)


def next_order(tasks: DataFrame) -> DataFrame:
    return tasks.agg((F.coalesce(F.max("sort_order"), F.lit(0)) + 1).alias("next_order"))
