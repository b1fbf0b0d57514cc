"""Documents whose sets of word n-grams have a Jaccard similarity of at least a given percentage.

Prefix filtering with adaptive multi-match prefixes. Every set is ordered alike, rare n-grams first. Two sets of which the
larger has n members overlap in at least o = ceil(n * percent / 100), so with prefixes of n - o + l members they share at least l
prefix members. l is 1 at first; a document whose prefix holds frequent n-grams takes the l of 1, 2, 4, 8 with the least estimated
cost (prefix members read, and candidates to expect, falling with l), and a pair must share the smaller l of the two before its
sets are compared.

What keeps large groups cheap, without losing a link between different texts:

* equal sets are one class from the start;
* prefix members that no other prefix holds can't be shared up to the next one that is held, which bounds the overlap from above
  (with what stands behind in the smaller set) before any pair is formed, and again for each pair;
* in each list of documents with one prefix n-gram, all are first compared with its most connected document only;
* after the components of those links are known, only pairs from different components remain candidates.

Frequencies for the order come from all documents: every task reports n-grams that it met more than once, and the
FREQUENT most frequent of the sums are broadcast (that bound is its size). The order is the same everywhere, so any frequencies
give right results; good ones give short lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .hashing import batches, mix, run_hashes, words_of
from .scratch import BROADCAST_ROWS, Scratch, arrow_rows, free, partitions, small_side
from .substring_index import did, keyed

FREQUENT = 200_000
COUNTED = 1 << 21
OFTEN = pa.list_(pa.struct([("g", pa.int64()), ("c", pa.int64())]))
MATCHES = (1, 2, 4, 8)
#: Rows of one list that a task holds, and members of a list that are compared with each other in one task.
LONGEST, TILE = 1 << 20, 20_000
#: Names of classes that a task keeps so as not to send their prefixes again.
SEEN = 500_000
#: Guests that one copy of a host's set is compared with.
HOSTED = 64


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of n words; of all its words, where there are fewer; empty without words."""
    if len(words) >= n:
        return np.unique(run_hashes(words, n))
    return mix(run_hashes(words, len(words)) + np.uint64(len(words))) if len(words) else np.zeros(0, np.uint64)


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[np.ndarray]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for a, b in batches(texts):
        words, bounds = words_of([t.lower() for t in texts[a:b]])
        for k in range(b - a):
            yield shingle_set(words[bounds[k] : bounds[k + 1]], n)


def _class(members: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(mix(mix(members ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(members)))[0].view(np.int64))


def _facts(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, did, tk, the set's name and size; and, in rows without did, n-grams that a task met in several sets.

    A task counts about COUNTED n-grams at a time.
    """

    def rows(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "did", "tk", "name", "n", "often"])

    def met(sets: list[np.ndarray]) -> pa.RecordBatch:
        grams, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts > 1
        pairs = pa.StructArray.from_arrays([pa.array(grams[often].view(np.int64)), pa.array(counts[often])], names=["g", "c"])
        lists = pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs)
        return rows([*[pa.nulls(1, pa.int64())] * 5, lists])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, known, size = [], set(), 0
        for batch in stream:
            names, sizes = [], []
            for members in _sets(batch, n):
                name = _class(members) if len(members) else None
                names.append(name)
                sizes.append(len(members))
                if name is not None and name not in known:
                    known.add(name)
                    waiting.append(members)
                    size += len(members)
                if size > COUNTED:
                    yield met(waiting)
                    waiting, known, size = [], set(), 0
            yield rows([batch.column("doc_id"), batch.column("did"), batch.column("tk"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(len(names), OFTEN)])
        if waiting:
            yield met(waiting)

    return keyed(docs).mapInArrow(run, "doc_id long, did long, tk long, name long, n long, often array<struct<g: long, c: long>>")


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with any set similar enough."""
    return -(-n * percent // 100)


def prefix(members: np.ndarray, grams: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """A set's prefix in the common order, and the matches it asks for. grams: frequent ones, sorted, with their counts."""
    n, least = len(members), needed(len(members), percent)
    at = np.searchsorted(grams, members)
    at[at == len(grams)] = 0
    met = np.where(grams[at] == members, counts[at], 1) if len(grams) else np.ones(n, np.int64)
    order = np.argsort(met, kind="stable") if met.max(initial=1) > 1 else slice(None)
    others = np.concatenate(([0], np.cumsum(met[order] - 1)))
    best, fewest = 1, None
    for matches in MATCHES:
        if matches > least:
            break
        # pairs of like size are met up to here only
        size = n - -(-2 * percent * n // (100 + percent)) + matches
        cost = size + others[size] + others[size] / matches * (50 + n / 16)
        if fewest is None or cost < fewest:
            best, fewest = matches, cost
    return members[order][: n - least + best], best


def _prefixes(docs: DataFrame, n: int, percent: int, table: Broadcast) -> DataFrame:
    """table: frequent n-grams, sorted, and their counts."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = table.value
        seen: set[int] = set()  # classes that the task has sent
        for batch in stream:
            if len(seen) > SEEN:
                seen = set()
            out: list[tuple[np.ndarray, int, int]] = []
            size = 0
            for members in _sets(batch, n):
                if len(members) and (name := _class(members)) not in seen:
                    seen.add(name)
                    some, matches = prefix(members, grams, counts, percent)
                    out.append((some, name, len(members) << 36 | matches))
                    size += len(some)
                    if size > 200_000:
                        yield _prefix_rows(out)
                        out, size = [], 0
            if out:
                yield _prefix_rows(out)

    return keyed(docs).mapInArrow(run, "gram long, name long, meta long")


def _prefix_rows(out: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
    """meta: the set's size from bit 36 on, the place in its order from bit 4 on, the matches it asks for."""
    sizes = np.array([len(x[0]) for x in out])
    places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[0] for x in out]).view(np.int64)), pa.array(np.repeat(np.array([x[1] for x in out], np.int64), sizes)), pa.array(np.repeat(np.array([x[2] for x in out], np.int64), sizes) | places << 4)], names=["gram", "name", "meta"])


def _bounded(lists: DataFrame, percent: int) -> DataFrame:
    """Rows that can be part of a link by the n-grams held elsewhere up to there: size, place, matches asked, and connectedness."""
    place, n = F.shiftright("meta", 4).bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("meta", 36)
    of = Window.partitionBy("name")
    rows = lists.select("gram", "name", n.alias("n"), place.alias("place"), F.col("meta").bitwiseAND(F.lit(15)).alias("asked"), "df")
    rows = rows.withColumn("upto", F.row_number().over(of.orderBy("place")).cast("long")).withColumn("own", F.sum(F.col("df") - 1).over(of))
    return rows.where((F.col("upto") + F.col("n") - 1 - F.col("place")) * 100 >= F.col("n") * percent).drop("upto")


def _in_parts(stream: Iterator[pa.RecordBatch], keys: int, limit: int | None = None, at_once: int = 1 << 18) -> Iterator[list[np.ndarray]]:
    """The columns of sorted rows, many rows at a time; rows that agree in the first ``keys`` columns, if any, stay together.

    With a limit, so many of those rows go on without the rest.
    """
    waiting: list[list[np.ndarray]] = []
    size = 0
    for batch in stream:
        if not batch.num_rows:
            continue
        waiting.append([c.to_numpy() for c in batch.columns])
        size += batch.num_rows
        if size >= at_once:
            columns = [np.concatenate(x) for x in zip(*waiting, strict=True)]
            last = np.full(size, keys > 0)  # rows without keys needn't stay together
            for c in columns[:keys]:
                last &= c == c[-1]
            end = size - int(last.sum())
            if not end and limit and size >= limit:
                end = size
            if end:
                yield [c[:end] for c in columns]
            waiting, size = [[c[end:] for c in columns]], size - end
    if size:
        yield [np.concatenate(x) for x in zip(*waiting, strict=True)]


def _shared(prefixes: DataFrame) -> DataFrame:
    """Rows of n-grams that stand in several classes' prefixes, with their number of classes.

    Lists stream through in order; of one that is longer than LONGEST, each part has the number so far.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_gram, open_name, before = None, None, 0  # of the list that may go on, and the classes of it that have been sent
        for batch in _in_parts(stream, 1, LONGEST):
            gram, name, meta = batch
            new = np.concatenate(([gram[0] != open_gram or name[0] != open_name], (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])))
            gram, name, meta = gram[new], name[new], meta[new]
            if not len(gram):
                continue
            head = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            size = np.diff(np.append(head, len(gram)))
            if gram[0] == open_gram:
                size[0] += before
            df = np.repeat(size, np.diff(np.append(head, len(gram))))
            before = int(size[-1])
            open_gram, open_name = gram[-1], name[-1]
            keep = df > 1
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (gram, name, meta, df)], names=["gram", "name", "meta", "df"])

    ordered = prefixes.repartition(partitions(prefixes.sparkSession), "gram").sortWithinPartitions("gram", "name")
    return ordered.mapInArrow(run, "gram long, name long, meta long, df long")


LIST = ("gram", "name", "n", "place", "asked", "own")


def _able(size: np.ndarray, behind: np.ndarray, asked: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the n-gram can be one of the first shared ones, as many as the pair is asked for, of a similar pair.

    What holds for a shared n-gram holds for those before it, so the shared ones met are the first of all shared ones.
    """
    return (np.minimum(asked[a], asked[b]) + np.minimum(behind[a], behind[b])) * (100 + percent) >= percent * (size[a] + size[b])


def _summed(pairs: DataFrame) -> DataFrame:
    pairs = pairs.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("asked").alias("asked"), F.min("rest").alias("rest"), F.min("least").alias("least"))
    return pairs.where("shared + rest >= least").select("a", "b", "shared", "asked")


PAIR = "a long, b long, shared long, asked long, rest long, least long"


def _star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each class (a) with the most connected one (b) of each of its lists, where they may be similar by size.

    lists: gram, name, n, place, asked, own. The most connected one comes first in its list, so a list of any length streams by.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = None
        for columns in _in_parts(stream, 0):
            if leader is not None:
                columns = [np.concatenate((x, c)) for x, c in zip(leader, columns, strict=True)]
            gram, name, size, place, asked, _ = columns
            head = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            b = np.repeat(head, np.diff(np.append(head, len(gram))))
            a, behind = np.arange(len(gram)), size - 1 - place
            leader = [c[head[-1] : head[-1] + 1] for c in columns]
            a, b = a[a != b], b[a != b]
            fits = _able(size, behind, asked, a, b, percent)
            yield from _counted(a[fits], b[fits], name, size, behind, asked, percent, False)

    ordered = lists.select(*LIST).repartition(partitions(lists.sparkSession), "gram").sortWithinPartitions("gram", F.desc("own"), F.desc("name"))
    return _summed(ordered.mapInArrow(run, PAIR))


def _all_pairs(lists: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of classes of one list with different ``own`` that may be similar by size, with the n-grams they share and the matches asked for.

    A list of more than TILE members is dealt to a task for each pair of its tiles.
    """
    long = lists.where(F.col("df") > TILE).groupBy("gram").count().where(F.col("count") > TILE)
    long = scratch.store(long.select("gram", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), "long")
    rows, keys = lists.select(*LIST), ["gram"]
    if not long.isEmpty():
        keys = ["gram", "low", "high"]
        rows = rows.join(small_side(long), "gram", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        rows = rows.withColumn("tile", F.pmod(F.xxhash64("name"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        rows = rows.select("gram", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), *LIST[1:], "tile")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _in_parts(stream, len(keys)):
            if len(keys) == 1:
                none = np.zeros(len(columns[0]), np.int32)
                columns = [columns[0], none, none, *columns[1:], none]
            gram, low, high, name, size, place, asked, own, tile = columns
            behind, across = size - 1 - place, low != high
            head = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
            tail = np.append(head[1:], len(gram))
            # row d places behind in the same list, for each d; sizes ascend, so lists soon have no partner of fitting size
            end = np.repeat(tail, tail - head)
            a, d, got, many = np.arange(len(gram)), 1, [], 0
            while len(a):
                a = a[a + d < end[a]]
                a = a[100 * size[a] >= percent * size[a + d]]
                some = a[(own[a] != own[a + d]) & (~across[a] | (tile[a] != tile[a + d]))]
                some = some[_able(size, behind, asked, some, some + d, percent)]
                if len(some):
                    got.append((some, some + d))
                    many += len(some)
                if many > 250_000:
                    yield from _counted(*(np.concatenate(x) for x in zip(*got, strict=True)), name, size, behind, asked, percent, True)
                    got, many = [], 0
                d += 1
            if got:
                yield from _counted(*(np.concatenate(x) for x in zip(*got, strict=True)), name, size, behind, asked, percent, True)

    ordered = rows.repartition(partitions(lists.sparkSession), *keys).sortWithinPartitions(*keys, "n", "name")
    return _summed(ordered.mapInArrow(run, PAIR))


def _counted(a: np.ndarray, b: np.ndarray, name: np.ndarray, size: np.ndarray, behind: np.ndarray, asked: np.ndarray, percent: int, ordered: bool) -> Iterator[pa.RecordBatch]:
    """Each pair once: n-grams shared, what can follow the last of them at most, and the least overlap of a link."""
    if not len(a):
        return
    x, y = name[a], name[b]
    if ordered:
        x, y = np.minimum(x, y), np.maximum(x, y)
    rest = np.minimum(behind[a], behind[b])
    order = np.lexsort((rest, y, x))
    x, y, a, b, rest = (c[order] for c in (x, y, a, b, rest))
    head = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]))))
    a, b = a[head], b[head]
    least = -(-percent * (size[a] + size[b]) // (100 + percent))
    yield pa.RecordBatch.from_arrays([pa.array(x[head]), pa.array(y[head]), pa.array(np.diff(np.append(head, len(x)))), pa.array(np.minimum(asked[a], asked[b])), pa.array(rest[head]), pa.array(least)], names=["a", "b", "shared", "asked", "rest", "least"])


def _addressed(pairs: DataFrame) -> DataFrame:
    """name, to: where a class's set goes, an array of (host, share, guest).

    Of a pair's two classes the one in more pairs is the host, so a guest has few hosts; a host's guests are dealt to shares of
    about HOSTED, each of which gets the host's set.
    """
    degree = pairs.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").count()
    sided = pairs.join(degree.select(F.col("name").alias("a"), F.col("count").alias("x")), "a").join(degree.select(F.col("name").alias("b"), F.col("count").alias("y")), "b")
    first = F.struct("x", "a") >= F.struct(F.col("y").alias("x"), F.col("b").alias("a"))
    sided = sided.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("host"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("name"), F.ceil(F.greatest("x", "y") / HOSTED).alias("shares"))
    guests = sided.select("name", "host", F.pmod(F.xxhash64("name"), F.col("shares")).cast("int").alias("share"), F.lit(True).alias("guest"))
    hosts = guests.select(F.col("host").alias("name"), "host", "share", F.lit(False).alias("guest")).distinct()
    return guests.unionByName(hosts).groupBy("name").agg(F.collect_list(F.struct("host", "share", "guest")).alias("to"))


SENT = pa.schema([("host", pa.int64()), ("share", pa.int32()), ("guest", pa.bool_()), ("cid", pa.int64()), ("members", pa.binary())])


def packed(members: np.ndarray) -> bytes:
    """Ascending numbers as their gaps, all first bytes first: gaps of large sets have small last bytes, which a shuffle's compression removes."""
    gaps = np.diff(members, prepend=np.uint64(0))
    return gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: memoryview | pa.Buffer) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, scratch: Scratch, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of class identifiers that are similar enough, from pairs of names; sets are compared whole.

    A set is made from the text of one document of its class, and travels once to each share where it is compared.
    """
    wanted = scratch.store(_addressed(pairs).join(reps, "name").select(F.col("cid").alias("did"), "tk", "to"), "wanted")
    many = wanted.agg(F.sum(F.size("to"))).first()[0] or 0
    texts = keyed(docs).select("did", "tk", "text").join(wanted.hint("broadcast" if many <= BROADCAST_ROWS else "shuffle_hash"), ["did", "tk"])

    def sent(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows, size = [], 0
            for did, to, members in zip(batch.column("did").to_pylist(), batch.column("to").to_pylist(), _sets(batch, words), strict=True):
                data = packed(members)
                for t in to:
                    rows.append((t["host"], t["share"], t["guest"], did, data))
                    size += len(data)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SENT, strict=True)], schema=SENT)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SENT, strict=True)], schema=SENT)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, own = None, np.zeros(0, np.uint64)
        for batch in stream:
            good = []
            for guest, cid, data in zip(batch.column("guest").to_pylist(), batch.column("cid").to_pylist(), batch.column("members"), strict=True):
                members = unpacked(data.as_buffer())
                if not guest:  # the first row of its share
                    host, own = cid, members
                    continue
                both = np.concatenate((own, members))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(both) - shared):
                    good.append((cid, host))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in good], pa.int64()) for i in (0, 1)], names=["a", "b"])

    sets = texts.mapInArrow(sent, "host long, share int, guest boolean, cid long, members binary")
    return sets.repartition(partitions(docs.sparkSession), "host", "share").sortWithinPartitions("host", "share", "guest").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """For each row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable over links, itself included).

    Words are runs of characters other than ASCII white space, A-Z lower-cased. A text with fewer than ``words`` words is one
    n-gram; null, empty and blank texts have none and link with nothing. Rows without a doc_id link like others, and a
    component of such rows alone has a null component_id; rows that repeat a doc_id are one document. Other columns are ignored; an empty
    table gives no rows. n-grams are compared by 64-bit hashes.
    """
    return _components(docs, words, percent).select("doc_id", "n_shingles", F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"))


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    with arrow_rows(docs.sparkSession, 1000):
        return _linked(docs, words, percent)


def _prepared(docs: DataFrame, words: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts of rows, classes of equal sets, and the lists of those that can be part of a link."""
    facts = scratch.store(_facts(docs, words), "facts")
    often = facts.where("did is null").select(F.explode("often").alias("o")).groupBy("o.g").agg(F.sum("o.c").alias("c"))
    facts = facts.where("did is not null").drop("often")
    frequent = often.orderBy(F.desc("c"), "g").limit(FREQUENT).toArrow()
    reps = facts.where("n > 0").groupBy("name").agg(F.min(F.struct("did", "tk")).alias("r"), F.min("doc_id").alias("low")).select("name", F.col("r.did").alias("cid"), F.col("r.tk").alias("tk"), "low")
    reps = scratch.store(reps, "classes")

    order = np.argsort(frequent["g"].to_numpy().view(np.uint64))
    table = docs.sparkSession.sparkContext.broadcast((frequent["g"].to_numpy().view(np.uint64)[order], frequent["c"].to_numpy()[order]))
    lists = scratch.store(_shared(_prefixes(docs, words, percent, table)), "lists")
    table.destroy()
    bounded = scratch.store(_bounded(lists, percent), "bounded")
    scratch.drop(lists)
    return facts, reps, bounded


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "jaccard")
    facts, reps, bounded = _prepared(docs, words, percent, scratch)
    stars = _star_pairs(bounded, percent)
    best = scratch.store(stars.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("x")).select("a", F.col("x.b").alias("b")), "best")
    links = scratch.store(_verified(best, reps, docs, scratch, words, percent), "links")
    first = scratch.store(connected_components(links, scratch), "components")

    label = bounded.select("name").distinct().join(reps.select("name", "cid"), "name")
    label = label.join(first.select(F.col("node").alias("cid"), F.col("component").alias("own")), "cid", "left").select("name", "cid", F.coalesce("own", "cid").alias("own"))
    label = scratch.store(label, "labels")
    rest = scratch.store(_all_pairs(bounded.drop("own").join(label.select("name", "own"), "name"), percent, scratch).where("shared >= asked"), "rest")
    more = _verified(rest, reps, docs, scratch, words, percent)
    own = label.select("cid", "own").distinct()
    more = more.join(own.select(F.col("cid").alias("a"), F.col("own").alias("x")), "a").join(own.select(F.col("cid").alias("b"), F.col("own").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = scratch.store(connected_components(scratch.store(more.distinct(), "more"), scratch), "merged")
    final = label.join(merged.select(F.col("node").alias("own"), F.col("component").alias("whole")), "own", "left").select("name", F.coalesce("whole", "own").alias("component"))
    final = scratch.store(reps.join(final, "name", "left").select("name", "low", "cid", F.coalesce("component", "cid").alias("component")), "final")
    # the least doc_id of components of several classes, from the classes other than the one that names the component
    least = scratch.store(final.where("component <> cid").groupBy("component").agg(F.min("low").alias("other")), "least")
    lowest = final.join(small_side(least), "component", "left").select("name", "cid", "component", F.least("low", "other").alias("low"))
    roots = scratch.store(lowest.where("component = cid").join(least.select("component"), "component", "left_semi").select("component", F.col("low").alias("whole")), "roots")
    final = scratch.store(lowest.join(small_side(roots), "component", "left").select("name", "component", F.coalesce("whole", "low").alias("low")), "lowest")
    scratch.drop(bounded)
    return facts.select("doc_id", "did", "name", F.col("n").alias("n_shingles")).join(final, "name", "left")


def jaccard_links(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links between different texts, and who has which text.

    Links: a, b (a < b), classes of rows with equal sets whose sets are similar enough; each pair once. Members: doc_id and class_id of
    each row with words. A class's identifier is its smallest doc_id, or a number from 2**62 on where none of its rows has one. Copies of one
    text link with each other and share their class's links, so they aren't written out in pairs. Other cases are those of ``jaccard_components``.
    """
    scratch = Scratch(docs.sparkSession, "links")
    with arrow_rows(docs.sparkSession, 1000):
        facts, reps, bounded = _prepared(docs, words, percent, scratch)
        pairs = scratch.store(_all_pairs(bounded.withColumn("own", F.col("name")), percent, scratch).where("shared >= asked"), "pairs")
        links = scratch.store(_verified(pairs, reps, docs, scratch, words, percent), "links")
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return links, facts.where("name is not null").join(reps.select("name", "cid"), "name").select("doc_id", F.col("cid").alias("class_id"))


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs without all but one document of each component: the one of the smallest doc_id stays, of rows without any doc_id one.

    Documents without words stay, and so do all rows that repeat the doc_id that stays.
    """
    stays = F.coalesce("low", "component")
    extra = _components(docs, words, percent).where(F.col("name").isNotNull() & (F.col("did") != stays)).select("did").distinct()
    key = free(docs, "did")[0]
    return docs.withColumn(key, did()).join(extra.withColumnRenamed("did", key), key, "left_anti").select(*docs.columns)
