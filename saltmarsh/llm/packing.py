"""Cost-balanced packing of tokenised documents into sequences of fixed length.

A piece of n tokens costs ``linear * n + quadratic * n * n``: the second term is attention, which within a sequence looks
at its own document only. Documents longer than a sequence fill whole sequences first. What is left is taken in
descending cost, each to the sequence of lowest cost that still has room for it; a document that fits nowhere is cut
over the sequences with most room. Capacities add up to exactly the tokens at hand: sequences of ``capacity`` and, for
what is left over, of falling powers of two, so nothing is padded.

The work is done in groups of consecutive documents within a partition, so there is no shuffle, a task's memory is bounded by
``group_tokens`` (or one document) and a lost task is repeated from its input alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import bounded_batches
from .tokenizing import encoder


def power_capacities(tokens: int, capacity: int) -> np.ndarray:
    """Lengths of the sequences for so many tokens: full ones, then falling powers of two."""
    rest = tokens % capacity
    return np.array([capacity] * (tokens // capacity) + [1 << b for b in range(capacity.bit_length() - 1, -1, -1) if rest >> b & 1], np.int64)


def assign(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; sequences are numbered from 0."""
    sequence = 0
    for d in np.flatnonzero(lengths >= capacity):
        for start in range(0, int(lengths[d]) // capacity * capacity, capacity):
            yield int(d), start, capacity, sequence, 0
            sequence += 1
    rest = lengths % capacity
    room = power_capacities(int(rest.sum()), capacity).tolist()
    size, cost = list(room), [0.0] * len(room)
    order = np.argsort(-(linear * rest + quadratic * rest.astype(float) ** 2), kind="stable")
    # sequences by cost, and those met without room for the document at hand by room: as documents get shorter, these come back
    cheap, aside = [(0.0, s) for s in range(len(room))], []
    for d in order.tolist():
        n, start = int(rest[d]), int(lengths[d] - rest[d])
        while n:
            while aside and -aside[0][0] >= n:
                s = heapq.heappop(aside)[1]
                heapq.heappush(cheap, (cost[s], s))
            while cheap and room[cheap[0][1]] < n:
                s = heapq.heappop(cheap)[1]
                heapq.heappush(aside, (-room[s], s))
            s = heapq.heappop(cheap or aside)[1]
            take = min(n, room[s])
            yield d, start, take, sequence + s, size[s] - room[s]
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start, n = start + take, n - take
            if room[s]:
                heapq.heappush(cheap, (cost[s], s))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 8192, group_tokens: int = 1 << 20, in_order: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian 32-bit binary).

    Each text is encoded whole, without special tokens, and ends with ``end_id``; a null or empty text is that id alone. Null and
    repeated doc_ids are documents like others; ties in length keep their order in the partition. Other columns are ignored,
    and an empty table gives no pieces. ``capacity`` is a power of two. ``sequence_id`` is unique over all partitions and grows with
    the partition and, in it, with the group. ``in_order`` numbers a group's sequences by the first document in each.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    fields = [("start", T.LongType()), ("length", T.LongType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(*f) for f in fields)])

    def packed(keys: list, ids: list[np.ndarray], kind: pa.DataType, base: int) -> tuple[list[pa.RecordBatch], int]:
        lengths = np.array([len(x) for x in ids], np.int64)
        rows = list(assign(lengths, capacity, linear, quadratic))
        d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        if in_order:
            first = np.full(int(sequence.max()) + 1, len(ids))
            np.minimum.at(first, sequence, d)
            sequence = np.argsort(np.argsort(first, kind="stable"))[sequence]
        pieces = [ids[i][a : a + n].tobytes() for i, a, n in zip(d.tolist(), start.tolist(), length.tolist(), strict=True)]
        columns = [pa.array([keys[i] for i in d.tolist()], kind), *(pa.array(x, pa.int64()) for x in (start, length, lengths[d], sequence + base, offset)), pa.array(pieces, pa.binary())]
        return [pa.RecordBatch.from_arrays(columns, names=schema.names)], int(sequence.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        encode, end = encoder(tokenizer_path).encode, np.array([end_id], np.uint32)
        keys: list = []
        ids: list[np.ndarray] = []
        tokens, kind = 0, None
        for batch in batches:
            kind = batch.column(0).type
            for key, x in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                keys.append(key)
                ids.append(np.concatenate((x, end)))
                tokens += len(ids[-1])
                if tokens >= group_tokens:
                    out, n = packed(keys, ids, kind, base)
                    yield from out
                    base, keys, ids, tokens = base + n, [], [], 0
        if keys:
            yield from packed(keys, ids, kind, base)[0]

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)
