"""Mixing sources to target weights by proportionate-fair scheduling.

Each source is a stream of blocks of ``block_size`` characters. A source with weight w, a part of the sum of all weights, has for
its block k (from 0) the release time floor(k / w) and the deadline ceil((k + 1) / w), in slots of one block. Of the blocks released,
the one with the earliest deadline gets a slot (ties: the source first by name). Every deadline is met and, while no source has
run out, at any time each has had less than one block more or less than its weight asks for. Weights are whole numbers of any size, so nothing is
rounded, and every source has its own. The driver walks over the blocks' numbers, one step a block and some dozen bytes of them at a
time, and stores each block's slot in the shared folder; no task walks over the corpus, and no text reaches the driver.

Within a source documents come in the order of a hash of their identifier, or in that of the files they are read from. A block's number follows from the characters before a document:
sums by shards of about SHARD documents, then within a shard, so the largest source is spread like any other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import batched
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, small_side

CYCLE, BLOCK, TEMPER = 1000, 1 << 15, 1.0
SHARD = 4096
#: Blocks that the driver holds at once.
AT_ONCE = 1 << 20
SLOTS = "stream string, block long, release long, deadline long, slot long"
#: Where times end: beyond it they count as this, for weights below about 1e-12.
END = (1 << 63) - 1


def whole_weights(masses: dict[str, int], weights: dict[str, float] | None, cycle: int = CYCLE, temper: float = TEMPER) -> dict[str, int]:
    """Whole numbers in the exact proportion of the sources' weights.

    ``weights`` are target weights by source, taken as the decimal numbers that they are written as. Sources of the corpus without one (or
    with 0) have 1 / ``cycle`` of the whole together, by mass; those not in the corpus are ignored. None: mass ** temper.
    """
    if weights is None:
        wanted = {x: Fraction(m) if temper == 1 else Fraction(float(m) ** temper) for x, m in masses.items()}
    else:
        wanted = {x: Fraction(str(weights[x])) for x in masses if weights.get(x)}
        rest = {x: m for x, m in masses.items() if x not in wanted}
        if any(w < 0 for w in wanted.values()):
            raise ValueError("weights must not be negative")
        least = sum(wanted.values()) / (cycle - 1) if wanted else Fraction(1)
        wanted |= {x: least * m / sum(rest.values()) for x, m in rest.items()}
    common = lcm(*(w.denominator for w in wanted.values()))
    return {x: int(w * common) for x, w in wanted.items()}


def earliest_deadlines(weights: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """source, block, release, deadline and slot of all blocks of all sources, in the order of their slots."""
    total = sum(weights.values())
    later = [(0, x) for x in weights if blocks[x]]
    heapq.heapify(later)
    ready: list[tuple[int, str, int]] = []
    turn = dict.fromkeys(weights, 0)
    slot = 0
    while later or ready:
        if not ready:
            slot = max(slot, later[0][0])
        while later and later[0][0] <= slot:
            release, x = heapq.heappop(later)
            heapq.heappush(ready, (-(-(turn[x] + 1) * total // weights[x]), x, release))
        deadline, x, release = heapq.heappop(ready)
        k = turn[x]
        yield x, k, release, deadline, slot
        turn[x] = k + 1
        if k + 1 < blocks[x]:
            heapq.heappush(later, ((k + 1) * total // weights[x], x))
        slot += 1


def cycle_slots(shared: DataFrame, cycle: int) -> DataFrame:
    """name, share, turn, slot: the slot within a cycle of each source's turn-th block, for whole shares that add up to ``cycle``."""
    share = {r["name"]: r["share"] for r in shared.collect()}
    rows = [(x, share[x], k, slot) for x, k, _, _, slot in earliest_deadlines(share, share) if slot < cycle]
    return shared.sparkSession.createDataFrame(rows, "name string, share long, turn long, slot long")


def _slots(scratch: Scratch, weights: dict[str, int], blocks: dict[str, int]) -> DataFrame:
    """Stored: stream, block, release, deadline, slot."""
    spark = scratch.spark
    path = scratch.path("slots")
    # no rows, and none from Python: for those executors would start workers besides the ones that they have
    spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, SLOTS.split(", "))]).write.parquet(path)
    for rows in batched(earliest_deadlines(weights, blocks), AT_ONCE):
        names, ks, releases, deadlines, slots = zip(*rows, strict=True)
        times = (pa.array([min(x, END) for x in part], pa.int64()) for part in (releases, deadlines, slots))
        table = pa.table([pa.array(names, pa.string()), pa.array(ks, pa.int64()), *times], names=["stream", "block", "release", "deadline", "slot"])
        spark.createDataFrame(table).write.mode("append").parquet(path)
    return spark.read.schema(SLOTS).parquet(path)


NAMES = ["stream", "mass", "start", "block", "release", "deadline", "slot", "selected"]


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block_size: int = BLOCK, cycle: int = CYCLE, temper: float = TEMPER, columns: Sequence[str] | None = None) -> DataFrame:
    """docs (all columns, or those named) with stream, mass, start, block, release, deadline, slot and selected.

    ``mass`` is the text's characters, at least 1; ``start`` the characters of its stream before it; ``slot`` that of the block in
    which it starts: a document isn't cut, so what stands in its source's order by a slot exceeds or falls short of the blocks
    scheduled by less than that document. ``selected`` is false for the surplus of sources that have more than their weight's part of the
    corpus: blocks that would be released after as many slots as the corpus has blocks. Only weights that the caller states (``weights``,
    or a ``temper`` other than 1) make a surplus; without them all are selected. Blocks have ``block_size`` characters
    whatever the size of the corpus. A null source counts as ''; null and
    repeated doc_ids are documents like others, in an order by their texts' hash; an empty table gives no rows. Columns of docs with
    these names are replaced.
    """
    kept = [c for c in columns or docs.columns if c.lower() not in NAMES]
    return _placed(docs, kept, weights, block_size, cycle, temper).select(*[F.col("row")[c].alias(c) for c in kept], *NAMES)


def _placed(docs: DataFrame, kept: Sequence[str], weights: dict[str, float] | None, block_size: int, cycle: int, temper: float, as_stored: bool = False) -> DataFrame:
    """row, the columns of docs that are kept in one, with the columns NAMES. ``as_stored``: a source's documents in the order of docs' files and of the rows in these."""
    mass = F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("long")
    keys = {"key": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), "doc": F.col("doc_id"), "hash": F.md5(F.coalesce("text", F.lit("")))}
    source = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("stream")
    scratch = Scratch(docs.sparkSession, "mixing")
    totals = scratch.store(docs.select(source, mass.alias("mass")).groupBy("stream").agg(F.sum("mass").alias("mass"), F.count("*").alias("documents")), "totals")
    masses = {r["stream"]: r["mass"] for r in totals.collect()}
    blocks = {x: -(-m // block_size) for x, m in masses.items()}
    table = _slots(scratch, whole_weights(masses, weights, cycle, temper), blocks)
    horizon = sum(blocks.values())
    if as_stored:
        place = docs.metadataColumn("_metadata")
        keys = {"key": place["row_index"], "shard": F.struct(place["file_path"].alias("file"), F.floor(place["row_index"] / SHARD).alias("piece"))}
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), source, mass.alias("mass"), *[c.alias(n) for n, c in keys.items()])
    if as_stored:
        sharded = rows
    else:
        sized = rows.join(small_side(totals.select("stream", F.ceil(F.col("documents") / SHARD).alias("shards"))), "stream")
        where = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
        sharded = sized.withColumn("shard", F.floor(where * F.col("shards") / F.lit(1 << 32)))
    sums = sharded.groupBy("stream", "shard").agg(F.sum("mass").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("stream").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("stream", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    inner = Window.partitionBy("stream", "shard").orderBy(*[k for k in keys if k != "shard"]).rowsBetween(Window.unboundedPreceding, -1)
    placed = sharded.withColumn("inner", F.coalesce(F.sum("mass").over(inner), F.lit(0))).join(sums, ["stream", "shard"])
    placed = placed.withColumn("start", F.col("before") + F.col("inner")).withColumn("block", F.floor(F.col("start") / block_size))
    out = placed.join(small_side(table), ["stream", "block"])
    out = out.withColumn("selected", (F.col("release") < F.lit(horizon)) | F.lit(weights is None and temper == 1))
    return out.select("row", *NAMES)


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, as_stored: bool = False) -> DataFrame:
    """The selected documents, without stated weights all of them, in the order of their slots: within a slot in their stream's order.

    ``as_stored``: docs is read from files, and a source's documents come in the order of these and of the rows in them; so what an earlier call mixed
    and a caller wrote comes back in its order. All columns of docs come back as they were, whatever their names.
    """
    rows = _placed(docs, docs.columns, weights, BLOCK, CYCLE, TEMPER, as_stored).where("selected")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "slot", "start").sortWithinPartitions("slot", "start")
    return ordered.select(*[F.col("row")[c].alias(c) for c in docs.columns])
