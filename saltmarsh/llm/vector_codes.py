"""Vectors as short codes: each of several equal parts is replaced by the nearest of its position's codebook entries, trained by Heap Lloyd.

Vectors stay together in blocks of some thousand, one row of a stored table each. A block keeps, for each part position and each entry, a
heap of the parts assigned to it, keyed by slack: the lower bound of the distance to any other entry, less the upper bound of the
distance to its own. When entries move, a part's slack falls by no more than its own entry's move and the longest move of the others, the
entry's drift; drifts add up over the rounds, and a key is a slack plus the drift at the time it was entered. So a heap whose least key exceeds
the entry's drift holds only parts that stay where they are, and isn't read further; the others are popped until that is so, and only
those are compared with all entries again, exactly, and entered anew.

Components are whole numbers and so are all distances that decide, so the result doesn't depend on blocks, partitions or the order of rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import BROADCAST_ROWS, Scratch

#: Rows of a block at most, and its components.
ROWS, COMPONENTS = 4096, 1 << 20
#: Components lie below this; results that 64 bits don't hold are an error.
LARGEST = 1 << 50
#: Up to here sums of products are exact in doubles.
EXACT = 1 << 53
#: Bounds are taken this much worse than computed, as roots are rounded.
ROUNDING = 1e-9
#: A label of many rows is joined in so many shares, where the labels are too many for a broadcast.
SHARES = 32


def _narrow(x: np.ndarray, books: np.ndarray) -> bool:
    most = max((int(np.abs(v).max()) if v.size else 0) for v in (x, books))
    return (2 * most + 1) ** 2 * max(1, x.shape[-1]) < EXACT


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows to all entries, exact: doubles while these hold them, else Python's integers."""
    if _narrow(x, book):
        a, b = x.astype(float), book.astype(float)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    a, b = x.astype(object), book.astype(object)
    out = np.empty((len(a), len(b)), object)
    for j in range(len(b)):
        out[:, j] = ((a - b[j]) ** 2).sum(1) if a.shape[1] else 0
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the lower one of equals, and its slack."""
    d = distances(x, book)
    best = d.argmin(1)
    rows = np.arange(len(x))
    upper = np.sqrt(d[rows, best].astype(float))
    if len(book) == 1:
        return best, np.full(len(x), np.inf)
    d[rows, best] = np.inf
    lower = np.sqrt(d.min(1).astype(float))
    return best, lower - upper - ROUNDING * (lower + upper)


class Block:
    """The parts of some vectors (rows, positions, width), their entries, and a heap of (key, row) for each position and entry."""

    def __init__(self, x: np.ndarray, entries: int, at: np.ndarray | None = None, heaps: list[list[tuple[float, int]]] | None = None):
        self.x, self.entries = x, entries
        self.at = np.zeros(x.shape[:2], np.int64) if at is None else at
        self.heaps = heaps

    def enter_all(self, books: np.ndarray, drift: np.ndarray) -> None:
        """Compare all parts with all entries."""
        self.heaps = []
        for p in range(self.x.shape[1]):
            self.at[:, p], slack = nearest(self.x[:, p], books[p])
            keys = slack + drift[p][self.at[:, p]]
            order = np.lexsort((keys, self.at[:, p]))  # ascending keys are a heap
            bounds = np.searchsorted(self.at[order, p], np.arange(self.entries + 1))
            pairs = list(zip(keys[order].tolist(), order.tolist(), strict=True))
            self.heaps += [pairs[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def move(self, books: np.ndarray, drift: np.ndarray) -> int:
        """After the entries moved: pop what may belong elsewhere now, compare it again. How many parts were compared."""
        compared = 0
        for p in range(self.x.shape[1]):
            popped: list[int] = []
            for e in range(self.entries):
                heap, limit = self.heaps[p * self.entries + e], drift[p, e] * (1 + ROUNDING)
                while heap and heap[0][0] <= limit:
                    popped.append(heapq.heappop(heap)[1])
            if popped:
                rows = np.array(popped)
                self.at[rows, p], slack = nearest(self.x[rows, p], books[p])
                for key, row, e in zip((slack + drift[p][self.at[rows, p]]).tolist(), popped, self.at[rows, p].tolist(), strict=True):
                    heapq.heappush(self.heaps[p * self.entries + e], (key, row))
                compared += len(popped)
        return compared

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """By position and entry: the componentwise sums of its parts, and their number. ROWS components below LARGEST fit."""
        n, parts, width = self.x.shape
        cell = self.at + np.arange(parts) * self.entries
        order = np.argsort(cell.ravel(), kind="stable")
        counts = np.bincount(cell.ravel(), minlength=parts * self.entries)
        total = np.zeros((parts * self.entries, width), np.int64)
        used = np.flatnonzero(counts)
        if len(used) and width:
            total[used] = np.add.reduceat(self.x.reshape(n * parts, width)[order], np.concatenate(([0], np.cumsum(counts)[:-1]))[used], axis=0)
        return total.ravel(), counts

    def errors(self, books: np.ndarray) -> list[int]:
        """Each vector's squared distances to its entries, summed over the positions."""
        if not self.x.size:
            return [0] * len(self.x)
        kind = np.int64 if _narrow(self.x.reshape(len(self.x), -1), books) else object
        gap = self.x.astype(kind) - books.astype(kind)[np.arange(self.x.shape[1]), self.at]
        return [int(v) for v in (gap * gap).sum((1, 2))]


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The most by which the slack of an entry's parts falls as the entries move: its own move and the longest of the others."""
    step = np.sqrt(((new.astype(object) - old.astype(object)) ** 2).sum(2).astype(float)) if old.size else np.zeros(old.shape[:2])
    if step.shape[1] < 2:
        return step
    first = step.argmax(1)
    top = np.sort(step, 1)[:, -2:]
    others = np.broadcast_to(top[:, 1:], step.shape).copy()
    others[np.arange(len(step)), first] = top[:, 0]
    return (step + others) * (1 + ROUNDING)


def _kept(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and x, the whole components as doubles, of vectors without null or non-finite components."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform(x, lambda c: F.lit(float(scale)) * c).alias("x"))


def _lists(flat: pa.Array, each: int, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * each + 1, each) if each else np.zeros(n + 1, int), pa.int32()), flat)


def encode(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """For each kept row vec_id, code, error, label_error and codebooks_sha256; and the final codebooks (position, entry, component).

    Components x become floor(scale * x). Rows whose vector is null or has a null or non-finite component are dropped; where lengths differ or don't divide into
    ``parts``, zeros are put behind. A codebook starts as the parts of the ``entries`` smallest vec_ids (of equal ones, the smaller vector; null after all others),
    fewer if there are fewer rows; rows that repeat count again. ``label_error`` sums over rows of equal label, null being one. Components of 2**50 or more, and
    errors beyond 64 bits, are an error. Other columns are ignored; an empty table gives no rows, and codebooks without entries.
    """
    if entries > 256:
        raise ValueError("an entry's number is a byte")
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "codes")
    kept = _kept(vectors, scale)
    longest, shortest, most = kept.agg(F.max(F.size("x")), F.min(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    if (most or 0) >= LARGEST:
        raise ValueError("components of 2**50 or more don't fit")
    width = -(-(longest or 0) // parts)
    d = width * parts
    kind = "int" if (most or 0) < 1 << 30 else "long"
    whole = F.transform("x", lambda c: F.floor(c).cast(kind))
    if shortest != d:
        whole = F.concat(whole, F.array_repeat(F.lit(0).cast(kind), F.lit(d) - F.size("x")))
    rows = kept.select("vec_id", "label", whole.alias("x"))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()  # the first codebooks: so many vectors
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    size = len(first)
    drift = np.zeros((parts, size))
    at_once = max(64, min(ROWS, COMPONENTS // max(d, 1)))
    label = rows.schema["label"].dataType.simpleString()
    element = pa.int32() if kind == "int" else pa.int64()

    def state(block: Block, ids: pa.Array, labels: pa.Array) -> pa.RecordBatch:
        keys = np.array([k for h in block.heaps for k, _ in h])
        members = np.array([r for h in block.heaps for _, r in h], np.int32)
        total, counts = block.sums()
        lists = [ids, labels, pa.array(block.x.ravel(), element), pa.array(keys), pa.array(members), pa.array([len(h) for h in block.heaps], pa.int32()), pa.array(total), pa.array(counts)]
        return pa.RecordBatch.from_arrays([_lists(a, len(a), 1) for a in lists], names=["ids", "labels", "x", "keys", "members", "sizes", "sums", "counts"])

    form = f"ids array<long>, labels array<{label}>, x array<{kind}>, keys array<double>, members array<int>, sizes array<int>, sums array<long>, counts array<long>"

    def entered(books: np.ndarray, drift: np.ndarray):
        def cut(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(batches)
            ids, labels, x = (table.column(c).combine_chunks() for c in ("vec_id", "label", "x"))
            block = Block(x.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), parts, width), size)
            block.enter_all(books, drift)
            return state(block, ids, labels)

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in stream:
                while len(batch):
                    held.append(batch.slice(0, at_once - n))
                    batch = batch.slice(len(held[-1]))
                    n += len(held[-1])
                    if n == at_once:
                        yield cut(held)
                        held, n = [], 0
            if held:
                yield cut(held)

        return run

    def reopened(batch: pa.RecordBatch, i: int, books: np.ndarray, drift: np.ndarray) -> tuple[Block, pa.Array, pa.Array]:
        get = {c: batch.column(c)[i].values for c in ("ids", "labels", "x", "keys", "members", "sizes")}
        n = len(get["ids"])
        bounds = np.concatenate(([0], np.cumsum(get["sizes"].to_numpy())))
        at = np.zeros((n, parts), np.int64)
        members = get["members"].to_numpy()
        cell = np.repeat(np.arange(parts * size), np.diff(bounds))
        at[members, cell // max(size, 1)] = cell % max(size, 1)
        pairs = list(zip(get["keys"].to_pylist(), members.tolist(), strict=True))
        block = Block(get["x"].to_numpy().astype(np.int64).reshape(n, parts, width), size, at, [pairs[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        block.move(books, drift)
        return block, get["ids"], get["labels"]

    def again(books: np.ndarray, drift: np.ndarray):
        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for i in range(len(batch)):
                    yield state(*reopened(batch, i, books, drift))

        return run

    def finished(books: np.ndarray, drift: np.ndarray):
        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for i in range(len(batch)):
                    block, ids, labels = reopened(batch, i, books, drift)
                    codes = [row.tobytes().hex() for row in block.at.astype(np.uint8)]
                    yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes), pa.array(block.errors(books), pa.int64())], names=["vec_id", "label", "code", "error"])

        return run

    table = scratch.store(rows.mapInArrow(entered(books, drift), form), "round-1")
    for r in range(1, rounds + 1):
        new = _means(table, books)
        drift, books = drift + moved(books, new), new
        if r < rounds:
            table, old = scratch.store(table.mapInArrow(again(books, drift), form), f"round-{r + 1}"), table
            scratch.drop(old)
    coded = scratch.store(table.mapInArrow(finished(books, drift), f"vec_id long, label {label}, code string, error long"), "coded")
    scratch.drop(table)
    named = sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()
    return _with_label_errors(coded, scratch).select("vec_id", "code", "error", "label_error", F.lit(named).alias("codebooks_sha256")), books


def _means(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries as the floors of their parts' means; unused ones as they were. A row for each component of the codebooks comes to the driver."""
    entry = F.floor(F.col("pos") / F.lit(max(books.shape[2], 1))).cast("int")
    total = table.select(F.posexplode("sums")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).withColumn("entry", entry)
    count = table.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n")).where("n > 0").select(F.col("pos").alias("entry"), "n")
    out = books.copy().reshape(-1)
    for r in total.join(F.broadcast(count), "entry").select("pos", "total", "n").collect():  # as many rows as a codebook has components
        out[r["pos"]] = int(r["total"]) // r["n"]
    return out.reshape(books.shape)


def _with_label_errors(coded: DataFrame, scratch: Scratch) -> DataFrame:
    totals = scratch.store(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "labels").withColumnRenamed("label", "of")
    same: Column = F.col("label").eqNullSafe(F.col("of"))
    if totals.count() <= BROADCAST_ROWS:
        return coded.join(F.broadcast(totals), same)
    shares = totals.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return coded.withColumn("share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SHARES)).cast("int")).join(shares, same & (F.col("share") == F.col("at")))


CODES_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
w AS (SELECT coalesce(max((len(x) + 15) // 16), 0) AS w FROM v),
p AS MATERIALIZED (SELECT r, p, list_transform(range(w), lambda i: coalesce(x[p * w + i + 1], 0)) AS x FROM v, w, (SELECT unnest(range(16)) AS p)),
c0 AS MATERIALIZED (SELECT p, entry, x FROM (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS entry FROM v) JOIN p USING (r) WHERE entry < 64),
"""
for _k in (0, 1, 2):
    CODES_SQL += f"""a{_k} AS MATERIALIZED (SELECT p.p, p.r, any_value(p.x) AS x, min({{'d': list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': entry}}) AS m FROM p JOIN c{_k} c ON p.p = c.p GROUP BY p.p, p.r),
"""
    if _k < 2:
        CODES_SQL += f"""s{_k} AS (SELECT p, e, list(y ORDER BY i) AS y FROM (SELECT p, e, i, (s - ((s % n) + n) % n) // n AS y FROM (SELECT p, m.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{_k}, (SELECT unnest(range(1, 1 + (SELECT w FROM w))) AS i) GROUP BY ALL)) GROUP BY p, e),
c{_k + 1} AS MATERIALIZED (SELECT c.p, entry, coalesce(y, x) AS x FROM c{_k} c LEFT JOIN s{_k} s ON c.p = s.p AND entry = e),
"""
CODES_SQL += """h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM c2),
f AS (SELECT r, string_agg(format('{:02x}', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN f USING (r), h"""
