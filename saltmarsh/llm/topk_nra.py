"""Exact top-k inner products by aggregation of sorted lists without random access.

Queries meet candidates in tiles of about TILE candidates and QUERIES queries, so a task's memory doesn't grow with the table.
In a tile every dimension is a list of the candidates sorted by value. A query reads all lists in step, a block at a time, from the
high end where its own component is positive and from the low end where it is negative. A candidate's lower bound is what was read of
it and the lists' last values for the rest; its upper bound what was read and the values that the lists have come to. Once
an outsider, seen in no list, cannot reach the k-th best lower bound, candidates whose upper bound is below it are dropped; reading stops when
few are left, and their scores are resolved. A tile's queries read together: those that are at one depth get their bounds by one product of
matrices. Ties go to the smaller identifier.

The k-th best score carries over between tiles: each query first searches one tile, and takes the k-th score found there into all others
as a lower bound from the start.

Scores are sums of whole numbers below 2**53 and so exact. Vectors with larger components are compared in whole numbers of any size
instead; a score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

TILE, QUERIES = 8192, 8192
#: A list is read in so many blocks.
BLOCKS = 12
#: Queries whose bounds, and pairs whose scores, are worked out at once.
STEP, PAIRS = 128, 1 << 14
#: Components up to which sums of a few thousand products stay below 2**53.
ORDINARY = float(1 << 20)
EXACT = float(1 << 53)


def integers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and x = floor(scale * component) of rows with vec_id and a vector of finite components only."""
    doubles = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where("vec_id is not null and size(e) > 0")
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # doubles from 2**53 on are whole numbers already
    return doubles.where(finite).select("vec_id", F.transform("e", lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale)).alias("x"))


class Lists:
    """A tile's candidates as sorted lists, for each dimension one from the high and one from the low end, that queries read in step.

    At a depth, an entry has been read if its value isn't beyond what its list has come to. So the candidates' bounds are sums over their
    components, each held to what is known of it, and all queries at this depth get theirs by one product of matrices.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids, self.n = x, ids, len(x)
        self.values = np.sort(x, 0)
        self.by_id = np.argsort(ids, kind="stable")

    def front(self, at: int) -> np.ndarray:
        """The values that the lists have come to, the high ends' first."""
        return np.concatenate([self.values[self.n - 1 - at], self.values[at]])

    def upper(self, at: int) -> np.ndarray:
        """Components as the high and as the low lists bound them for a query that gains by them."""
        if at == self.n:
            return np.concatenate([self.x, self.x], 1)
        return np.concatenate([np.maximum(self.x, self.values[self.n - 1 - at]), np.minimum(self.x, self.values[at])], 1)

    def lower(self, at: int) -> np.ndarray:
        """Components that were read, and the lists' last values for the rest."""
        high = np.where(self.x >= self.values[self.n - at], self.x, self.values[0])
        return np.concatenate([high, np.where(self.x <= self.values[at - 1], self.x, self.values[-1])], 1)

    def _own(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of the rows that have their identifiers."""
        ids = self.ids[self.by_id]
        low, high = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        col = np.repeat(np.arange(len(own)), high - low)
        return col, self.by_id[np.arange(len(col)) - np.repeat(np.cumsum(high - low) - high, high - low)]

    def search(self, q: np.ndarray, own: np.ndarray, k: int, bars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Query row, candidate row and score of the k best candidates with another identifier and a score of at least the query's bar, and how many entries were read.

        Without a bar the k-th best lower bound becomes one, block by block; with one, candidates are looked at from where outsiders can't reach it.
        """
        n, bars, learning = self.n, bars.astype(float), bars == -np.inf
        w = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], 1)
        few, block, at, read = max(4 * k, n // 8), max(1, -(-n // BLOCKS)), 0, 0
        todo, out = np.arange(len(q)), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        while len(todo):
            at = min(n, at + block)
            front = w @ self.front(at) if at < n else np.full(len(w), -np.inf)
            if learning[todo].any():
                lower = self.lower(at)
                for part in _steps(todo[learning[todo]]):
                    if n < k:
                        break
                    low = w[part] @ lower.T
                    low[self._own(own[part])] = -np.inf
                    bars[part] = np.maximum(bars[part], np.partition(low, n - k, 1)[:, n - k])
            ready = todo[(front[todo] < bars[todo]) | (at == n)]  # for others an outsider might still qualify
            done = np.zeros(len(q), bool)
            if len(ready):
                upper = self.upper(at)
            for part in _steps(ready):
                high = w[part] @ upper.T
                alive = high >= bars[part, None]
                alive[self._own(own[part])] = False
                ended = (alive.sum(1) <= few) | (at == n)
                done[part[ended]] = True
                alive[~ended] = False
                col, row = np.divmod(np.flatnonzero(alive), n)
                score = high[col, row] if at == n else self._scores(q[part], col, row)
                keep = score >= bars[part[col]]
                out.append(_first(part[col[keep]], row[keep], score[keep], self.ids, k))
            read += at * int(np.count_nonzero(q[done]))
            todo = todo[~done[todo]]
        return *(np.concatenate(x) for x in zip(*out, strict=True)), read

    def _scores(self, q: np.ndarray, col: np.ndarray, row: np.ndarray) -> np.ndarray:
        out = np.empty(len(col))
        for i in range(0, len(col), PAIRS):
            at = slice(i, i + PAIRS)
            out[at] = np.einsum("ij,ij->i", q[col[at]], self.x[row[at]])
        return out


def _steps(rows: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(0, len(rows), STEP):
        yield rows[i : i + STEP]


def _first(col: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, best first, queries in order."""
    best = np.lexsort((ids[row], -score if score.dtype == float else ~score, col))  # ~ reverses the order without overflow
    col, row, score = col[best], row[best], score[best]
    keep = np.arange(len(col)) - np.searchsorted(col, col, "left") < k
    return col[keep], row[keep], score[keep]


def _whole(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Products in whole numbers of any size."""
    out = [sum(int(a) * int(b) for a, b in zip(row, q.tolist(), strict=True)) for row in x.tolist()]
    if any(not -(1 << 63) <= s < 1 << 63 for s in out):
        raise OverflowError("a score needs more than 64 bits")
    return out


def search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, k: int, bars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """query row, candidate row and score of each query's k best candidates with another identifier, of those that reach its bar; and the entries read."""
    limit = min(ORDINARY, np.sqrt(EXACT / x.shape[1]))
    plain, asked = np.abs(x).max(1, initial=0) <= limit, np.abs(q).max(1, initial=0) <= limit
    ordinary, large, few = np.flatnonzero(plain), np.flatnonzero(~plain), np.flatnonzero(asked)
    cols, rows, scores, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    if len(ordinary) and len(few):
        col, row, score, entries = Lists(x[ordinary], ids[ordinary]).search(q[few], qids[few], k, bars[few])
        cols, rows, scores = [few[col]], [ordinary[row]], [score.astype(np.int64)]
    for j in range(len(q)) if len(large) else np.flatnonzero(~asked):
        other = large if asked[j] else np.arange(len(x))
        other = other[ids[other] != qids[j]]
        cols.append(np.full(len(other), j))
        rows.append(other)
        scores.append(np.array(_whole(x[other], q[j]), np.int64))
    return *_first(*(np.concatenate(c) for c in (cols, rows, scores)), ids, k), entries


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


FOUND = "query_id long, twin long, vec_id long, score long"


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates (all, if fewer) with another vec_id.

    Both have vec_id and x, whole numbers held in doubles, as ``integers`` gives them. Vectors of another length than the query's take
    no part. Rows that repeat a vec_id are rows of their own as candidates, spread over the tiles like others; queries that
    repeat vec_id and vector count once. Empty inputs give no rows. A score that doesn't fit 64 bits is an error.

    Every query meets every tile, so the work is the product of both tables; a tile is read as far as the bounds ask for.
    """
    scratch = Scratch(candidates.sparkSession, "topk")
    cand = scratch.store(candidates.select("vec_id", "x", F.size("x").alias("d"), F.monotonically_increasing_id().alias("row")), "candidates")
    ask = scratch.store(queries.select("vec_id", "x", F.size("x").alias("d")).distinct(), "queries")
    blocks, asked = max(1, -(-cand.count() // TILE)), max(1, -(-ask.count() // QUERIES))
    c = cand.select(F.lit(False).alias("query"), "vec_id", F.lit(0).cast("long").alias("twin"), "x", "d", F.lit(None).cast("long").alias("bar"), F.lit(-1).cast("long").alias("home"), F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("b"))
    twin = F.xxhash64("x")
    q = ask.select(F.lit(True).alias("query"), "vec_id", twin.alias("twin"), "x", "d", F.pmod(F.xxhash64("vec_id", twin), F.lit(blocks)).alias("home"), F.pmod(F.xxhash64("vec_id"), F.lit(asked)).alias("q"))

    def tile(table: pa.Table) -> pa.Table:
        is_query = table["query"].to_numpy()
        x = table["x"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        ids, bars = table["vec_id"].to_numpy(), np.array(table["bar"].cast(pa.float64()).fill_null(-np.inf))
        col = row = score = np.zeros(0, np.int64)
        if is_query.any() and not is_query.all():
            col, row, score, _ = search(x[~is_query], ids[~is_query], x[is_query], ids[is_query], k, bars[is_query])
        return pa.table({"query_id": ids[is_query][col], "twin": table["twin"].to_numpy()[is_query][col], "vec_id": ids[~is_query][row], "score": score})

    names = ["query", "vec_id", "twin", "x", "d", "bar", "b"]
    none = F.lit(None).cast("long").alias("bar")
    first = c.select(*names).unionByName(q.withColumn("bar", none).withColumn("b", F.col("home")).select(*names)).groupBy("d", "b").applyInArrow(tile, FOUND)
    first = scratch.store(_best(first, k).drop("rank"), "first")
    bars = first.groupBy("query_id", "twin").agg(F.min("score").alias("bar"), F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "twin", "bar")
    # every query meets the tiles other than its first
    spread = q.join(bars, ["vec_id", "twin"], "left").withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).where("b <> home")
    dealt = c.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asked - 1).cast("long"))))
    rest = dealt.select(*names, "q").unionByName(spread.select(*names, "q")).groupBy("d", "b", "q").applyInArrow(tile, FOUND)
    return _best(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
