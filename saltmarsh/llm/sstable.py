"""Token ids of documents in sorted-string-table shards, written, scanned and searched by Spark tasks.

Layout of a shard, integers little-endian:

    block*   entries in ascending key order: varint shared, varint own, varint value length, the key's own bytes, the value;
             every RESTART entries shared is 0. Then the offsets of those entries and their count (u32 each), and the block's crc32.
    index    for each block: u16 key length, last key, u64 offset, u32 length
    filter   Bloom filter over the keys
    footer   u64 index offset, u64 filter offset, u64 entries, u64 tokens, u32 hashes of the filter, 8 bytes MAGIC

A key is one byte 0 (null) or 1 and the identifier in eight big-endian bytes with its sign bit flipped, so that byte order is
number order. A value is one byte with the width of an id, 2 or 4, and the ids in that width.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import Scratch, partitions
from .tokenizing import encoder

MAGIC = b"SMSST01\n"
BLOCK, RESTART, BITS, HASHES = 64 << 10, 16, 10, 7
FOOTER = struct.Struct("<QQQQI8s")

MANIFEST = "shard int, path string, first_id long, last_id long, docs long, tokens long, bytes long"


def key_of(doc_id: int | None) -> bytes:
    return b"\0" if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return n, at


def _probes(key: bytes, bits: int, hashes: int) -> list[int]:
    a, b = struct.unpack("<QQ", blake2b(key, digest_size=16).digest())
    return [(a + i * (b | 1)) % bits for i in range(hashes)]


def pack_ids(ids: np.ndarray) -> bytes:
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\4" + ids.astype("<u4").tobytes()


def unpack_ids(value: bytes) -> np.ndarray:
    return np.frombuffer(value, f"<u{value[0]}", offset=1).astype("<u4")


class ShardWriter:
    """Appends entries in ascending key order to a stream; holds one block, the index and the keys' filter hashes."""

    def __init__(self, out):
        self.out, self.at = out, 0
        self.index: list[tuple[bytes, int, int]] = []
        self.keys: list[bytes] = []
        self.tokens = 0
        self._open()

    def _open(self) -> None:
        self.block, self.restarts, self.entries, self.last = bytearray(), [], 0, b""

    def add(self, key: bytes, ids: np.ndarray) -> None:
        value, shared = pack_ids(ids), 0
        if self.entries % RESTART:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.restarts.append(len(self.block))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.entries, self.last, self.tokens = self.entries + 1, key, self.tokens + len(ids)
        self.keys.append(key)
        if len(self.block) >= BLOCK:
            self._close()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _close(self) -> None:
        if self.entries:
            data = bytes(self.block) + struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
            self.index.append((self.last, self.at, len(data) + 4))
            self._write(data + struct.pack("<I", zlib.crc32(data)))
        self._open()

    def finish(self) -> None:
        self._close()
        index_at = self.at
        for key, at, n in self.index:
            self._write(struct.pack("<H", len(key)) + key + struct.pack("<QI", at, n))
        filter_at, bits = self.at, max(64, BITS * len(self.keys))
        table = bytearray((bits + 7) // 8)
        for key in self.keys:
            for p in _probes(key, len(table) * 8, HASHES):
                table[p >> 3] |= 1 << (p & 7)
        self._write(bytes(table))
        self._write(FOOTER.pack(index_at, filter_at, len(self.keys), self.tokens, HASHES, MAGIC))


class ShardReader:
    """Scans a shard block by block, or finds a key through filter, sparse index, restart points and one block."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        index_at, filter_at, self.docs, self.tokens, self.hashes, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        data, at = self._read(index_at, filter_at - index_at), 0
        self.keys, self.places = [], []
        while at < len(data):
            (n,) = struct.unpack_from("<H", data, at)
            self.keys.append(data[at + 2 : at + 2 + n])
            self.places.append(struct.unpack_from("<QI", data, at + 2 + n))
            at += 14 + n
        self.filter = self._read(filter_at, size - FOOTER.size - filter_at)

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def _block(self, i: int) -> tuple[bytes, list[int]]:
        raw = self._read(*self.places[i])
        data = raw[:-4]
        if zlib.crc32(data) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("a block's checksum is wrong")
        (n,) = struct.unpack_from("<I", data, len(data) - 4)
        end = len(data) - 4 - 4 * n
        return data[:end], list(struct.unpack_from(f"<{n}I", data, end))

    @staticmethod
    def _entries(data: bytes, at: int) -> Iterator[tuple[bytes, bytes]]:
        key = b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            own, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + own]
            yield key, data[at + own : at + own + n]
            at += own + n

    def scan(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.places)):
            yield from self._entries(self._block(i)[0], 0)

    def may_contain(self, key: bytes) -> bool:
        return all(self.filter[p >> 3] >> (p & 7) & 1 for p in _probes(key, len(self.filter) * 8, self.hashes))

    def find(self, key: bytes) -> list[bytes]:
        """Values of all entries with the key."""
        out: list[bytes] = []
        if not self.may_contain(key):
            return out
        for i in range(bisect_left(self.keys, key), len(self.keys)):
            data, restarts = self._block(i)
            low, high = 0, len(restarts)
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if next(self._entries(data, restarts[mid]))[0] < key else (low, mid)
            for k, v in self._entries(data, restarts[low]):
                if k == key:
                    out.append(v)
                elif k > key:
                    return out
        return out


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1) -> DataFrame:
    """Encode each whole text, end it with ``end_id`` and write shards in ascending doc_id order; returns the manifest.

    One range shuffle orders the documents; each task streams its range into one file, so memory holds a batch of texts, a block
    and the shard's keys. A file gets its name when it is complete, and only finished tasks' files are in the manifest: what a
    lost task left behind is never read. Null doc_ids come first; repeated ones are all kept; a null text is empty. Other
    columns are ignored. An empty table gives an empty manifest.
    """
    if docs.schema["doc_id"].dataType.typeName() not in ("long", "integer", "short", "byte"):
        raise TypeError("doc_id must be an integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, first, last = TaskContext.get().partitionId(), None, None, None
        encode, end = encoder(tokenizer_path).encode, np.array([end_id], np.uint32)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system, path = _at(f"{folder}/{shard:06d}-{uuid.uuid4().hex}.sst")
                system.create_dir(path.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(f"{path}.part")
                writer, first = ShardWriter(out), batch.column(0)[0].as_py()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                writer.add(key_of(doc_id), np.concatenate((ids, end)))
                last = doc_id
        if writer:
            writer.finish()
            out.close()
            system.move(f"{path}.part", path)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": f"{folder}/{path.rpartition('/')[2]}", "first_id": first, "last_id": last, "docs": len(writer.keys), "tokens": writer.tokens, "bytes": writer.at}], schema=MANIFEST_ARROW)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(run, MANIFEST)


MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("path", pa.string()), *((n, pa.int64()) for n in ("first_id", "last_id", "docs", "tokens", "bytes"))])


def read_shards(manifest: DataFrame, at_once: int = 4 << 20) -> DataFrame:
    """Each document in the shards: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit binary)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    placed = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _at(row["path"])
                rows, size, start = [], 0, row["start"]
                with system.open_input_file(path) as file:
                    for key, value in ShardReader(file).scan():
                        ids = unpack_ids(value)
                        rows.append((id_of(key), start, len(ids), ids.tobytes()))
                        start, size = start + len(ids), size + 4 * len(ids)
                        if size > at_once:
                            yield _rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return placed.repartition(partitions(manifest.sparkSession), "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "start", "n_tokens", "ids"])


def lookup(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id and ids of the entries whose doc_id is among ``keys``; absent keys give no row.

    The manifest has one short row a shard; keys go to the shards whose range holds them, and a shard is opened once a task.
    """
    keys = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    routed = keys.join(F.broadcast(manifest.select("path", "first_id", "last_id")), (F.col("doc_id") <= F.col("last_id")) & (F.col("doc_id") >= F.coalesce("first_id", F.lit(-(1 << 63)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader, file = None, None, None
        for batch in batches:
            rows = []
            for path, doc_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path != at:
                    system, name = _at(path)
                    if file:
                        file.close()
                    at, file = path, system.open_input_file(name)
                    reader = ShardReader(file)
                rows += [(doc_id, unpack_ids(v).tobytes()) for v in reader.find(key_of(doc_id))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["doc_id", "ids"])
        if file:
            file.close()

    return routed.select("path", "doc_id").repartition("path").sortWithinPartitions("path", "doc_id").mapInArrow(run, "doc_id long, ids binary")


def token_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> tuple[DataFrame, Scratch]:
    """Write shards into the shared folder; returns the stored manifest and the folder's handle."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "shards")
    return scratch.store(write_shards(docs, tokenizer_path, scratch.path("sst"), end_id), "manifest"), scratch
