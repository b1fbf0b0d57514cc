"""Near copies among embeddings, by randomised-rotation binary codes with correction factors.

A unit vector o is rotated by a random orthogonal matrix and kept as the signs of the result, a vertex c of the cube with sides
1/sqrt(d), together with f = <c, o>. For a unit vector q, rotated alike, <c, q> / f estimates <o, q> without bias, and
the error stays below sqrt((1 - f*f) / (d - 1)) / f times a confidence factor, except with a probability falling like a
Gaussian's tail in that factor. A pair is compared exactly, in double precision, unless the bound of either direction rules it out.

Candidates come from the same kind of codes: bands of some bits each, from further rotations. The number of bits grows with the
logarithm of the largest label's rows, so that most bands' members of unrelated vectors stand alone and go no further; the number of bands follows
from the recall wanted at the threshold. Equal vectors are collapsed into one first. A band's members are compared within
one task in tiles: a band with more than TILE members is dealt to a task for each pair of its tiles. A pair that meets
in several bands counts in the first only. Tasks return counts of links and a spanning forest of them, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch, partitions

TILE = 512
CONFIDENCE = 5.0


@cache
def rotation(d: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def plan_bands(rows: int, cosine: float, miss: float) -> tuple[int, int]:
    """Bits in a band and number of bands, so that a pair at the threshold is missed with a probability of at most ``miss``."""
    bits = max(6, math.ceil(math.log2(max(rows, 2))) + 2)
    agree = 1 - math.acos(cosine) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-(agree**bits))))


def band_keys(unit: np.ndarray, bits: int, bands: int, seed: int) -> np.ndarray:
    """For each vector its key in each band, made of the signs of its rotations."""
    d = unit.shape[1]
    spins = [rotation(d, seed + 1 + i) for i in range(math.ceil(bits * bands / d))]
    signs = np.concatenate([unit @ r.T > 0 for r in spins], 1)[:, : bits * bands].reshape(len(unit), bands, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def codes(unit: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their sign vectors of length one, and the correction factors <c, o>."""
    spun = unit @ rotation(unit.shape[1], seed).T
    signs = np.where(spun > 0, 1.0, -1.0) / math.sqrt(unit.shape[1])
    return spun, signs, np.einsum("ij,ij->i", signs, spun)


def ruled_out(spun: np.ndarray, signs: np.ndarray, factor: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float, confidence: float) -> np.ndarray:
    """Pairs whose estimate lies so far below the threshold, in one direction or the other, that they need no exact comparison."""
    out = np.zeros(len(a), bool)
    for x, y in ((a, b), (b, a)):
        f = factor[x]
        estimate = np.einsum("ij,ij->i", signs[x], spun[y]) / f
        out |= estimate + confidence * np.sqrt(np.maximum(0, 1 - f * f) / max(1, spun.shape[1] - 1)) / f < cosine
    return out


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy().astype(float).reshape(len(lists), -1)


def _plain(vectors: DataFrame) -> Column:
    """The embedding in floats, where it is stored in floats, else doubles; + 0 makes minus zero zero, so equal vectors are equal arrays."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    return F.transform(F.col("embedding").cast(kind), lambda x: x + F.lit(0.0).cast(kind[6:-1]))


def _good() -> Column:
    """Over vec_id, label and v."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v and d of rows that can link."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", _plain(vectors).alias("v")).where(_good()).withColumn("d", F.size("v"))


def near_components(vectors: DataFrame, cosine: float = 0.93, miss: float = 1e-3, seed: int = 20, confidence: float = CONFIDENCE) -> DataFrame:
    """For each row: vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable), kept.

    Only rows with equal, non-null labels and embeddings of equal length link, at a cosine of at least ``cosine`` in double precision.
    Null or zero vectors, and those with null or non-finite components, link with nothing. Rows that repeat a vec_id are rows
    of their own in counts; a row without vec_id links with nothing and has no component. Equal vectors always link; a
    pair of others at the threshold is missed with a probability of at most ``miss``. Other columns are ignored; an empty table
    gives no rows.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "vectors")
    usable = _usable(vectors)
    distinct = scratch.store(usable.groupBy("label", "d", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")).withColumn("k", F.xxhash64("label", "v", "node")), "distinct")
    largest = distinct.groupBy("label", "d").count().agg(F.max("count")).first()[0] or 0
    bits, bands = plan_bands(largest, cosine, miss)

    def banded(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            d = batch.column("d").to_numpy()
            for width in np.unique(d):
                part = batch.filter(pa.array(d == width))
                v = _matrix(part, "v")
                unit = v / np.abs(v).max(1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                keys = band_keys(unit, bits, bands, seed)
                offsets = pa.array(np.arange(0, len(part) * bands + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("label", "d", "k", "node", "copies", "v")), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel(), pa.int32() if bits < 32 else pa.int64()))], names=["label", "d", "k", "node", "copies", "v", "keys"])

    label, v = (distinct.schema[c].dataType.simpleString() for c in ("label", "v"))
    keyed = scratch.store(distinct.select("label", "d", "k", "node", "copies", "v").mapInArrow(banded, f"label {label}, d int, k long, node long, copies long, v {v}, keys array<{'int' if bits < 32 else 'long'}>"), "keyed")
    members = keyed.select("label", "d", "k", F.posexplode("keys").alias("band", "key"))
    sizes = members.groupBy("label", "d", "band", "key").count().where("count > 1")
    tiles = F.ceil(F.col("count") / TILE).cast("int")
    placed = members.join(sizes, ["label", "d", "band", "key"]).withColumn("tiles", tiles).withColumn("own", F.pmod("k", F.col("tiles")).cast("int"))
    # a tile meets itself and each other tile: task (low, high) gets the members of both
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("label", "d", "band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "k")
    cell = F.xxhash64("label", "d", "band", "key", "low", "high").alias("cell")
    dealt = dealt.select(cell, "band", "own", F.when(F.col("low") == F.col("high"), F.lit(False)).otherwise(F.lit(True)).alias("across"), "k").join(keyed, "k")

    def linked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in stream:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= 1 << 14:  # whole cells only: the last one may go on
                table = pa.Table.from_batches(waiting).combine_chunks()
                cells = table["cell"].to_numpy()
                end = int(np.searchsorted(cells, cells[-1]))
                if end:
                    yield from _linked(table.slice(0, end), cosine, confidence, seed)
                waiting = table.slice(end).to_batches()
                rows = table.num_rows - end
        if rows:
            yield from _linked(pa.Table.from_batches(waiting), cosine, confidence, seed)

    found = dealt.repartition(partitions(spark), "cell").sortWithinPartitions("cell", "own", "k").mapInArrow(linked, "k long, links long, a long, b long")
    found = scratch.store(found, "found")
    counts = found.where("links is not null").groupBy("k").agg(F.sum("links").alias("links"))
    whole = scratch.store(connected_components(found.where("a is not null").select("a", "b"), scratch), "components")
    facts = distinct.join(counts, "k", "left").join(whole, "node", "left")
    facts = facts.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    return _rejoined(vectors, usable, facts)


def _rejoined(vectors: DataFrame, usable: DataFrame, facts: DataFrame) -> DataFrame:
    ours = usable.select("vec_id", "label", "v").join(facts, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", _plain(vectors).alias("v")).where(~_good())
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ours.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _linked(table: pa.Table, cosine: float, confidence: float, seed: int) -> Iterator[pa.RecordBatch]:
    """Links within cells of rows sorted by cell and tile: counts of links for each node, and a forest of links."""
    for width in np.unique(table["d"].to_numpy()):
        part = table.filter(pa.array(table["d"].to_numpy() == width)).combine_chunks()
        batch = part.to_batches()[0]
        cell, band, own, k, node, copies = (batch.column(c).to_numpy() for c in ("cell", "band", "own", "k", "node", "copies"))
        across, label = batch.column("across").to_numpy(zero_copy_only=False), batch.column("label").to_numpy(zero_copy_only=False)
        v, keys = _matrix(batch, "v"), batch.column("keys").flatten().to_numpy().reshape(batch.num_rows, -1)
        unit = v / np.abs(v).max(1, keepdims=True)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        spun, signs, factor = codes(unit, seed)
        head = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        end = np.repeat(np.append(head[1:], len(cell)), np.diff(np.append(head, len(cell))))
        links, edges, a, d = np.zeros(len(cell), np.int64), [], np.arange(len(cell)), 1
        while len(a):
            a = a[a + d < end[a]]
            b = a + d
            fresh = (~across[a] | (own[a] != own[b])) & (label[a] == label[b])
            x, y = a[fresh], b[fresh]
            for i in range(0, len(x), 1 << 14):
                p, q = x[i : i + (1 << 14)], y[i : i + (1 << 14)]
                open_ = ~ruled_out(spun, signs, factor, p, q, cosine, confidence)
                p, q = p[open_], q[open_]
                same = keys[p] == keys[q]
                first = same.argmax(1) == band[p]
                p, q = p[first], q[first]
                exact = np.einsum("ij,ij->i", v[p], v[q]) / (np.sqrt(np.einsum("ij,ij->i", v[p], v[p])) * np.sqrt(np.einsum("ij,ij->i", v[q], v[q])))
                p, q = p[exact >= cosine], q[exact >= cosine]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                edges.append(np.stack([p, q], 1))
            d += 1
        some = np.flatnonzero(links)
        yield _found(k[some], links[some], None, None)
        if edges:
            forest = _forest(np.concatenate(edges), len(cell))
            yield _found(None, None, node[forest[:, 0]], node[forest[:, 1]])


def _forest(edges: np.ndarray, n: int) -> np.ndarray:
    """As many of the edges as keep what they connect connected, at most one a node."""
    root = list(range(n))
    keep = []
    for k, (a, b) in enumerate(edges.tolist()):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(k)
    return edges[np.array(keep, np.int64)]


def _found(*columns: np.ndarray | None) -> pa.RecordBatch:
    n = next(len(c) for c in columns if c is not None)
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], names=["k", "links", "a", "b"])
