"""Execution ledgers: first-in-first-out valuation and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .joins import paired

EPSILON = 1e-12


def by_fill() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("ts", "row_no")


def so_far() -> WindowSpec:
    return by_fill().rowsBetween(Window.unboundedPreceding, 0)


def side_of(c: Column | str) -> Column:
    """BUY, SELL or null."""
    s = F.upper(F.trim(c))
    return F.when(s.isin("BUY", "B", "LONG", "매수"), "BUY").when(s.isin("SELL", "S", "SHORT", "매도"), "SELL")


def covered(fills: DataFrame) -> DataFrame:
    """fills with ``held`` (inventory after the fill, never below 0), ``eff`` (quantity that counts) and ``uncovered``.

    What a sale exceeds the inventory by is dropped, so the inventory is the running net less its running minimum below zero.
    """
    signed = F.when(F.col("side") == "BUY", F.col("qty")).otherwise(-F.col("qty"))
    f = fills.withColumn("_net", F.sum(signed).over(so_far()))
    f = f.withColumn("held", F.col("_net") - F.least(F.lit(0.0), F.min("_net").over(so_far())))
    before = F.coalesce(F.lag("held").over(by_fill()), F.lit(0.0))
    f = f.withColumn("eff", F.when(F.col("side") == "BUY", F.col("qty")).otherwise(F.least(F.col("qty"), before)))
    return f.withColumn("uncovered", F.col("qty") - F.col("eff")).drop("_net")


def fifo(fills: DataFrame) -> DataFrame:
    """symbol, realised, uncovered, open_qty, open_cost, last_price.

    Purchases and sales of a symbol are intervals of its cumulated quantities. The ends of both, in order, cut the quantity into
    segments that belong to one purchase and one sale each: one sort, no pairing of all with all. Fees and taxes add to the
    cost of a purchase and reduce the proceeds of a sale; uncovered quantity has proceeds and no cost.
    """
    f = covered(fills)
    buy = F.col("side") == "BUY"
    costs = F.col("fee") + F.col("tax")
    f = f.withColumn("_end", F.sum(F.when(buy, F.col("eff")).otherwise(F.lit(0.0))).over(so_far())).withColumn("_sold", F.sum(F.when(~buy, F.col("eff")).otherwise(F.lit(0.0))).over(so_far()))
    ends = f.where(F.col("eff") > EPSILON).select("symbol", F.when(buy, F.col("_end")).otherwise(F.col("_sold")).alias("end"), F.when(buy, (F.col("qty") * F.col("price") + costs) / F.col("qty")).alias("cost"), (~buy).cast("int").alias("sale"), F.col("row_no"))
    order = Window.partitionBy("symbol").orderBy("end", "sale", "row_no")
    piece = F.col("end") - F.coalesce(F.lag("end").over(order), F.lit(0.0))
    # the next purchase, met from behind: a frame that only grows, where one that shrinks is read again for each row
    back = Window.partitionBy("symbol").orderBy(F.desc("end"), F.desc("sale"), F.desc("row_no"))
    own = F.last("cost", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    total = F.max(F.when(F.col("sale") == 1, F.col("end"))).over(Window.partitionBy("symbol"))
    pieces = ends.select("symbol", piece.alias("piece"), own.alias("own"), (F.col("end") <= F.coalesce(total, F.lit(0.0))).alias("sold"))
    cost = pieces.groupBy("symbol").agg(F.sum(F.when(F.col("sold"), F.col("piece") * F.col("own")).otherwise(0.0)).alias("cost"), F.sum(F.when(~F.col("sold"), F.col("piece") * F.col("own")).otherwise(0.0)).alias("open_cost"))
    ledger = f.groupBy("symbol").agg(F.sum(F.when(~buy, F.col("qty") * F.col("price") - costs).otherwise(0.0)).alias("proceeds"), F.sum("uncovered").alias("uncovered"), F.max_by("held", F.struct("ts", "row_no")).alias("open_qty"), F.max_by("price", F.struct("ts", "row_no")).alias("last_price"))
    return ledger.join(cost, "symbol").select("symbol", (F.col("proceeds") - F.col("cost")).alias("realised"), "uncovered", "open_qty", "open_cost", "last_price")


def reconcile(expected: DataFrame, actual: DataFrame, qty: float = 1e-9, money: float = 1e-6) -> DataFrame:
    """row, type of each mismatch: missing_in_ledger, unexpected_in_ledger, and per pair qty, price, fee, tax, side or symbol."""
    phases = [["execution_id"], ["order_id"], [F.to_date("ts"), "symbol", "side"]]
    pairs = paired(expected, actual, phases)
    e, a = expected.alias("e"), actual.alias("a")
    both = pairs.join(e, F.col("e.row_no") == F.col("e_row")).join(a, F.col("a.row_no") == F.col("a_row"))

    def off(c: str, tolerance: float) -> Column:
        return F.when(F.coalesce(F.abs(F.col(f"e.{c}") - F.col(f"a.{c}")) > tolerance, ~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))), f"{c}_mismatch")

    kinds = [off("qty", qty), off("price", money), off("fee", money), off("tax", money), *[F.when(~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}")), f"{c}_mismatch") for c in ("side", "symbol")]]
    found = both.select(F.col("e_row").alias("row"), F.explode(F.array_compact(F.array(*kinds))).alias("type"))
    missing = expected.join(pairs.select(F.col("e_row").alias("row_no")), "row_no", "left_anti").select(F.col("row_no").alias("row"), F.lit("missing_in_ledger").alias("type"))
    extra = actual.join(pairs.select(F.col("a_row").alias("row_no")), "row_no", "left_anti").select(F.col("row_no").alias("row"), F.lit("unexpected_in_ledger").alias("type"))
    return found.unionByName(missing).unionByName(extra)


def mismatch_counts(mismatches: DataFrame, most: int = 0) -> DataFrame:
    """type, n, and whether that many pass."""
    return mismatches.groupBy("type").agg(F.count("*").alias("n")).withColumn("ok", F.col("n") <= most)
