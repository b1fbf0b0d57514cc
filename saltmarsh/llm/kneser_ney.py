"""Document perplexity under an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Counts stay sharded tables: n-grams of the highest order are counted per task and summed by key; the lower orders' continuation
counts, the discounts (from counts of counts) and the interpolation weights follow by aggregations, and each order's
probabilities by two joins, with its contexts' weights and with the order below. The finished table goes to the scoring
tasks by broadcast while it has at most TABLE_ROWS rows. A larger one stays sharded: the corpus' distinct n-grams are joined with
it once, the COMMON most frequent of them go to the tasks that read the texts, and only documents' rarer n-grams are shuffled, so no
n-gram that stands in much of the corpus is a hot key. Both give the same perplexities.

A character is its code point, so every one keeps its own n-grams; what a model hasn't seen shares the lowest order's uniform part.

Every document, trusted or not, is scored by a model that hasn't seen it: there are two, each trained on the trusted documents of
one half (by a hash of the identifier) and used for the other half.

A document is rejected if its perplexity exceeds a threshold of its language: a quantile over the trusted documents in that
language, and a margin on top. Short texts say little, so a text's mean is first drawn towards the language's median with the
weight of PRIOR characters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import mix
from .scratch import Scratch, free, small_side
from .substring_index import did

ORDER = 5
#: Bits of a symbol: a code point and the two symbols below it. Three symbols are one long, ``lo``; those before them another, ``hi``.
WIDTH = 21
SYMBOL, TRIPLE = (1 << WIDTH) - 1, (1 << 3 * WIDTH) - 1
TABLE_ROWS, COMMON = 2_000_000, 200_000
#: Trusted documents that a language's own threshold needs; other languages share one.
ENOUGH = 30
QUANTILE, MARGIN, PRIOR = 0.99, 0.5, 50
#: What stands before a text and behind it; a character is its code point + CHARACTERS.
BEFORE, BEHIND, CHARACTERS = 0, 1, 2
#: Characters of text, and distinct n-grams, that a task works on at once.
AT_ONCE, COUNTED = 1 << 19, 1 << 20


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``half``, 0 or 1, which of the two models a document trains."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), did().alias("did"), F.xxhash64("text").alias("tk"), "lang", F.coalesce("text", F.lit("")).alias("text")).withColumn("half", F.pmod(F.xxhash64("did"), F.lit(2)))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def characters(docs: DataFrame) -> int:
    """How many different characters the texts have."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << WIDTH, bool)
        for batch in stream:
            text = "".join(batch.column(0).to_pylist())
            for i in range(0, len(text), AT_ONCE):
                seen[_points(text[i : i + AT_ONCE])] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int64())], names=["c"])

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "c long").distinct().count()


def keys_of(symbols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """hi and lo of n-grams, given their first symbols, their second ones and so on."""
    hi, lo = np.zeros(len(symbols[0]), np.int64), np.zeros(len(symbols[0]), np.int64)
    for s in symbols:
        hi = hi << WIDTH | lo >> 2 * WIDTH
        lo = (lo << WIDTH | s) & TRIPLE
    return hi, lo


def names_of(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """64-bit names of n-grams of one length."""
    return mix(hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(lo.view(np.uint64)))


#: Symbols before a part, its characters, and whether the text ends with it.
Part = tuple[int, str, bool]


def parts_of(text: str, order: int) -> Iterator[Part]:
    """A text with what stands before and behind it; a long one in parts, each n-gram in one of them."""
    for i in range(0, len(text) + 1, AT_ONCE):
        yield max(0, order - 1 - i), text[max(0, i - order + 1) : i + AT_ONCE], i + AT_ONCE > len(text)


def symbols_of(parts: list[Part]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of several parts, one behind the other, and how many each has."""
    before, behind = np.array([x[0] for x in parts]), np.array([x[2] for x in parts])
    n = np.array([len(x[1]) for x in parts])
    ends = np.cumsum(before + n + behind)
    symbols = np.full(ends[-1], BEFORE, np.int64)
    symbols[np.arange(n.sum()) + np.repeat(ends - behind - np.cumsum(n), n)] = _points("".join(x[1] for x in parts)) + np.uint32(CHARACTERS)
    symbols[ends[behind] - 1] = BEHIND
    return symbols, before + n + behind


def _ranks(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each of the codes below ``size``, from 0, equal ones alike; and a place of each number.

    Codes are sorted together with their places where both fit a long: numbers alone sort much quicker than they can be looked up.
    """
    bits = len(codes).bit_length()
    if size > 1 << 62 - bits:
        _, place, at = np.unique(codes, return_index=True, return_inverse=True)
        return at, place
    packed = codes << bits
    packed |= np.arange(len(codes))
    packed.sort()
    places = packed & (1 << bits) - 1
    packed >>= bits
    new = np.ones(len(codes), bool)
    np.not_equal(packed[1:], packed[:-1], out=new[1:])
    at = np.empty(len(codes), np.int64)
    at[places] = np.cumsum(new) - 1
    return at, places[new]


def grams(parts: list[Part], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hi and lo of the distinct n-grams of several parts; which of them stands at each place; and the parts' bounds in that."""
    symbols, length = symbols_of(parts)
    bounds = np.concatenate(([0], np.cumsum(length - order + 1)))
    inside = np.ones(len(symbols) - order + 1, bool)
    inside[(np.cumsum(length)[:-1, None] - np.arange(1, order)).ravel()] = False  # they'd reach into the next part
    seen = np.zeros(symbols.max() + 1, bool)
    seen[symbols] = True
    local = np.cumsum(seen) - 1
    many, ids = int(local[-1]) + 1, local[symbols]
    codes, size = ids[: len(inside)].copy(), many
    for j in range(1, order):
        if size > (1 << 62) // many:  # ranks of what was met stand in for it
            codes, place = _ranks(codes, size)
            size = len(place)
        codes *= many
        codes += ids[j : len(inside) + j]
        size *= many
    at, place = _ranks(codes[inside], size)
    place = np.flatnonzero(inside)[place]
    hi, lo = keys_of([symbols[place + j] for j in range(order)])
    return hi, lo, at, bounds


def _by_half(texts: list[str], halves: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, list[Part]]]:
    """half, rows, and the parts of their texts, about AT_ONCE characters at a time."""
    for half in (0, 1):
        rows, parts, size = [], [], 0
        for row in np.flatnonzero(halves == half).tolist():
            for part in parts_of(texts[row], order):
                if parts and size + len(part[1]) > AT_ONCE:
                    yield half, np.array(rows), parts
                    rows, parts, size = [], [], 0
                rows.append(row)
                parts.append(part)
                size += len(part[1])
        if parts:
            yield half, np.array(rows), parts


def _find(names: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where own names stand among the sorted ones, and which do; looked up in order, which is quicker by far."""
    order = np.argsort(own)
    at = np.empty(len(own), np.int64)
    at[order] = np.searchsorted(names, own[order])
    at[at == len(names)] = 0
    return at, names[at] == own if len(names) else np.zeros(len(own), bool)


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """half, hi, lo, c: how often each n-gram of the highest order occurs in the texts (text, half) of either half."""
    names = ["half", "hi", "lo", "c"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, ...]]] = [[], []]
        size = [0, 0]

        def summed(half: int) -> None:
            if len(held[half]) > 1:
                name, hi, lo, c = (np.concatenate(x) for x in zip(*held[half], strict=True))
                at = np.argsort(name)
                first = np.flatnonzero(np.diff(name[at], prepend=~name[at[:1]]))
                c, at = np.add.reduceat(c[at], first), at[first]
                held[half] = [(name[at], hi[at], lo[at], c)]
            size[half] = 0

        def sent(half: int) -> pa.RecordBatch:
            summed(half)
            _, hi, lo, c = held[half].pop() if held[half] else [np.zeros(0, np.int64)] * 4
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(c), half)), pa.array(hi), pa.array(lo), pa.array(c)], names=names)

        for batch in stream:
            for half, _, own in _by_half(batch.column(0).to_pylist(), batch.column(1).to_numpy(), order):
                hi, lo, at, _ = grams(own, order)
                held[half].append((names_of(hi, lo), hi, lo, np.bincount(at, minlength=len(hi))))
                size[half] += len(hi)
                if size[half] > COUNTED // 2:
                    summed(half)
                    if len(held[half][0][0]) > COUNTED:
                        yield sent(half)
        yield sent(0)
        yield sent(1)

    return texts.select("text", "half").mapInArrow(run, "half long, hi long, lo long, c long").groupBy("half", "hi", "lo").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> Column:
    """D1 to D3+ of each row's count, from the numbers of its half's n-grams with counts one to four."""
    tallies = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    out = F.lit(None).cast("double")
    for half, *n in counts.groupBy("half").agg(*tallies).collect():
        d = [0.5, 0.5, 0.5]
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(float(i), max(0.0, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 for i in (1, 2, 3)]
        out = F.when(F.col("half") == half, F.element_at(F.array(*[F.lit(x) for x in d]), F.least("c", F.lit(3)).cast("int"))).otherwise(out)
    return out


def suffix(n: int) -> list[Column]:
    """hi and lo of the last n symbols."""
    hi = F.col("hi").bitwiseAND(F.lit((1 << WIDTH * (n - 3)) - 1)) if n > 3 else F.lit(0).cast("long")
    lo = F.col("lo") if n >= 3 else F.col("lo").bitwiseAND(F.lit((1 << WIDTH * n) - 1))
    return [hi.alias("hi"), lo.alias("lo")]


def context(hi: Column, lo: Column) -> list[Column]:
    """hi and lo of all symbols but the last."""
    return [F.shiftright(hi, WIDTH).alias("hi"), F.shiftright(lo, WIDTH).bitwiseOR(F.shiftleft(hi.bitwiseAND(F.lit(SYMBOL)), 2 * WIDTH)).alias("lo")]


KEY = ["half", "hi", "lo"]
CONTEXT = ["half", "x", "y"]


def _as(df: DataFrame, **names: str) -> DataFrame:
    """df with its columns renamed: new name = old name."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def train(counts: DataFrame, vocabulary: int, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """half, n, hi, lo, p, gamma: each half's n-grams of each order with their probability (null for what is a context only, as before a
    text's start), and the weight that they leave to the order below as contexts (null for those that are none). n = 0 is the empty context.

    counts: half, hi, lo, c; the halves are models of their own. ``vocabulary`` is the number of characters among which the lowest order
    spreads what is left. Orders up to 6 fit the keys.
    """
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = scratch.store(levels[n + 1].select("half", *suffix(n)).groupBy(*KEY).agg(F.count("*").alias("c")), "grams")
    below = None
    tables, weights = [], {}
    for n in range(1, order + 1):
        x, y = context(F.col("hi"), F.col("lo"))
        rows = levels[n].select(*KEY, "c", x.alias("x"), y.alias("y"), _discounts(levels[n]).alias("d"))
        contexts = scratch.store(rows.groupBy(*CONTEXT).agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma")), "contexts")
        weights[n - 1] = _as(contexts, half="half", hi="x", lo="y", gamma="gamma")
        rows = rows.join(contexts, CONTEXT).select(*KEY, ((F.col("c") - F.col("d")) / F.col("total")).alias("own"), "gamma")
        if below is None:
            p = rows.select(*KEY, (F.col("own") + F.col("gamma") / vocabulary).alias("p"))
        else:
            x, y = suffix(n - 1)
            p = rows.select("*", x.alias("x"), y.alias("y")).join(_as(below, half="half", x="hi", y="lo", q="p"), CONTEXT).select(*KEY, (F.col("own") + F.col("gamma") * F.col("q")).alias("p"))
        below = scratch.store(p, "probabilities")
        tables.append((n, below))
    zero = F.lit(0).cast("long")
    whole = weights[0].select(F.lit(0).alias("n"), "half", zero.alias("hi"), zero.alias("lo"), F.lit(1 / vocabulary).alias("p"), "gamma")
    for n, p in tables:
        rows = p.join(weights[n], KEY, "full") if n in weights else p.withColumn("gamma", F.lit(None).cast("double"))
        whole = whole.unionByName(rows.select(F.lit(n).alias("n"), *KEY, "p", "gamma"))
    return scratch.store(whole, "model")


class Model:
    """The finished table in arrays, for a task."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], order: int):
        self.levels, self.order = levels, order

    @classmethod
    def of(cls, table: pa.Table, order: int) -> Model:
        levels, n = [], table["n"].to_numpy()
        for k in range(order + 1):
            part = table.filter(pa.array(n == k))
            names = names_of(part["hi"].to_numpy(), part["lo"].to_numpy())
            at = np.argsort(names)
            levels.append((names[at], *(np.array(part[c].fill_null(math.nan))[at] for c in ("p", "gamma"))))
        return cls(levels, order)

    def probabilities(self, hi: np.ndarray, lo: np.ndarray, n: int | None = None) -> np.ndarray:
        n = self.order if n is None else n
        names, p, _ = self.levels[n]
        if n == 0:
            return np.full(len(lo), p[0])
        at, hit = _find(names, names_of(hi, lo))
        hit &= ~np.isnan(p[at])
        out = p[at]
        if not hit.all():
            hi, lo = hi[~hit], lo[~hit]
            contexts, _, gamma = self.levels[n - 1]
            before = names_of(hi >> WIDTH, lo >> WIDTH | (hi & SYMBOL) << 2 * WIDTH)
            at, known = _find(contexts, before)
            weight = np.where(known & ~np.isnan(gamma[at]), gamma[at], 1.0)
            hi, lo = (hi & (1 << WIDTH * (n - 4)) - 1, lo) if n > 4 else (np.zeros_like(hi), lo & (1 << WIDTH * (n - 1)) - 1)
            out[~hit] = weight * self.probabilities(hi, lo, n - 1)
        return out


OWN = ["doc_id", "did", "tk", "lang"]
SCORES = "doc_id long, did long, tk long, lang string, n long, total double"


def score(docs: DataFrame, model: DataFrame, scratch: Scratch, order: int = ORDER, table_rows: int = TABLE_ROWS, common: int = COMMON) -> DataFrame:
    """Stored: for each document the number of its n-grams, its end included, and the sum of their negative log probabilities.

    model: as ``train`` gives it, but ``half`` is that of the documents to which a part applies.
    """
    rows = _keyed(docs)
    if model.count() > table_rows:
        return _score_sharded(rows, model, scratch, order, common)
    arrays = []
    for h in (0, 1):  # one after the other, so that the driver holds one half at a time
        arrays.append(docs.sparkSession.sparkContext.broadcast(Model.of(model.where(F.col("half") == h).toArrow(), order).levels))
        pa.default_memory_pool().release_unused()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [Model(x.value, order) for x in arrays]
        for batch in stream:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for half, at, own in _by_half(batch.column("text").to_pylist(), batch.column("half").to_numpy(), order):
                hi, lo, places, bounds = grams(own, order)
                np.add.at(n, at, np.diff(bounds))
                np.add.at(total, at, np.add.reduceat(-np.log(models[half].probabilities(hi, lo))[places], bounds[:-1]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in OWN), pa.array(n), pa.array(total)], names=[*OWN, "n", "total"])

    out = scratch.store(rows.mapInArrow(run, SCORES), "scores")
    for x in arrays:
        x.destroy()
    return out


def _most_frequent(counts: DataFrame, rows: int) -> DataFrame:
    """At most so many of the rows with the greatest ``c``: all from a count on, found by a histogram of some hundred steps."""
    step = F.floor(F.log2("c") * 8)
    at, have = None, 0
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        have += r["count"]
        if have > rows:
            break
        at = r["step"]
    return counts.where(step >= at) if at is not None else counts.where("false")


def _score_sharded(rows: DataFrame, model: DataFrame, scratch: Scratch, order: int, common: int) -> DataFrame:
    """The same by joins: the corpus' distinct n-grams with the table of each order, and with the weights of their contexts."""
    distinct = scratch.store(count_grams(rows, order), "corpus")
    joined = distinct
    for n in range(order, 0, -1):
        x, y = suffix(n)
        own = _as(model.where(F.col("n") == n), half="half", x="hi", y="lo", **{f"p{n}": "p"})
        before = _as(model.where(F.col("n") == n - 1), half="half", x="hi", y="lo", **{f"g{n}": "gamma"})
        joined = joined.withColumns({"x": x, "y": y}).join(own, ["half", "x", "y"], "left")
        x, y = context(*suffix(n))
        joined = joined.withColumns({"x": x, "y": y}).join(before, ["half", "x", "y"], "left").drop("x", "y")
    p: Column = F.lit(model.where("n = 0").first()["p"])
    for n in range(1, order + 1):
        p = F.coalesce(F.col(f"p{n}"), F.coalesce(F.col(f"g{n}"), F.lit(1.0)) * p)
    surprise = scratch.store(joined.select(*KEY, "c", F.when(p > 0, -F.log(p)).otherwise(math.inf).alias("s")), "surprise")  # Spark's log of 0 is null
    known = _most_frequent(surprise, common).toArrow()
    tables = []
    for half in (0, 1):
        part = known.filter(pa.array(known["half"].to_numpy() == half))
        names = names_of(part["hi"].to_numpy(), part["lo"].to_numpy())
        at = np.argsort(names)
        tables.append((names[at], part["s"].to_numpy()[at]))
    often = rows.sparkSession.sparkContext.broadcast(tables)
    names = [*OWN, "half", "n", "total", "hi", "lo", "c"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a document with what the common n-grams add up to, and a row for each of its other n-grams."""
        for batch in stream:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            dids, tks = batch.column("did").to_numpy(), batch.column("tk").to_numpy()
            for half, at, own in _by_half(batch.column("text").to_pylist(), batch.column("half").to_numpy(), order):
                hi, lo, places, bounds = grams(own, order)
                found, s = often.value[half]
                i, hit = _find(found, names_of(hi, lo))
                np.add.at(n, at, np.diff(bounds))
                if hit.any():
                    np.add.at(total, at, np.add.reduceat(np.where(hit, s[i], 0.0)[places], bounds[:-1]))
                miss = np.flatnonzero(~hit[places])
                pairs, c = np.unique(at[np.searchsorted(bounds, miss, "right") - 1] * len(hi) + places[miss], return_counts=True)
                row, gram = np.divmod(pairs, len(hi))
                if len(c):
                    yield others([dids[row], tks[row], np.full(len(c), half), hi[gram], lo[gram], c])
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in OWN), batch.column("half"), pa.array(n), pa.array(total), none, none, none], names=names)

    def others(rest: list[np.ndarray]) -> pa.RecordBatch:
        did, tk, half, hi, lo, c = (pa.array(x, pa.int64()) for x in rest)
        none = pa.nulls(len(did), pa.int64())
        return pa.RecordBatch.from_arrays([none, did, tk, pa.nulls(len(did), pa.string()), half, none, pa.nulls(len(did), pa.float64()), hi, lo, c], names=names)

    told = scratch.store(rows.mapInArrow(run, "doc_id long, did long, tk long, lang string, half long, n long, total double, hi long, lo long, c long"), "told")
    often.destroy()
    docs, rare = told.where("n is not null").select(*OWN, "n", "total"), told.where("n is null").select("did", "tk", *KEY, "c")
    more = rare.join(surprise.select(*KEY, "s"), KEY).groupBy("did", "tk").agg(F.sum(F.col("c") * F.col("s")).alias("rare"))
    # rows that are equal have been summed up together: each gets its part
    more = more.join(docs.groupBy("did", "tk").count(), ["did", "tk"]).select("did", "tk", (F.col("rare") / F.col("count")).alias("rare"))
    return scratch.store(docs.join(more, ["did", "tk"], "left").select(*OWN, "n", (F.col("total") + F.coalesce("rare", F.lit(0.0))).alias("total")), "scores")


def decide(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE, margin: float = MARGIN, prior: float = PRIOR, table_rows: int = TABLE_ROWS, common: int = COMMON) -> DataFrame:
    """doc_id, did, tk, lang, n_grams, perplexity, threshold, keep for each row of docs.

    Trusted documents are those with quality 1 and no other quality in ``labels`` (doc_id, quality; nulls there are ignored). A null or
    empty text is kept, without perplexity; so is everything where no document is trusted. Languages with too few trusted
    documents, null among them, share the threshold over all. Rows that repeat a doc_id are judged each by its text. Other
    columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "perplexity")
    named = labels.select(F.col("doc_id").cast("long").alias("did"), F.col("quality").cast("int").alias("quality")).where("did is not null and quality is not null")
    trusted = scratch.store(named.groupBy("did").agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = 1 and high = 1").select("did"), "trusted")
    vocabulary = characters(docs) + 2
    texts = _keyed(docs).where("text <> ''").select("did", "text", "half").join(small_side(trusted), "did")
    counts = scratch.store(count_grams(texts, order), "counts")
    halves = sorted(r["half"] for r in counts.select("half").distinct().collect())
    if not halves:
        nothing = [F.lit(None).cast("double").alias(c) for c in ("perplexity", "threshold")]
        return _keyed(docs).select("doc_id", "did", "tk", "lang", F.length("text").cast("long").alias("n_grams"), *nothing, F.lit(True).alias("keep"))
    model = train(counts, vocabulary, scratch, order)
    # trained on one half, used for the other; with trusted documents in one half only, its model serves both
    used = F.explode(F.array(*[F.lit(h).cast("long") for h in (0, 1)])) if len(halves) == 1 else (1 - F.col("half")).cast("long")
    model = model.withColumn("half", used)
    scores = score(docs, model, scratch, order, table_rows, common)
    mean = F.col("total") / F.col("n")
    known = scores.where("n > 1").join(trusted, "did").select(F.col("lang").alias("l"), mean.alias("mean"), "n")
    middle = known.groupBy("l").agg(F.percentile_approx("mean", 0.5, 10_000).alias("median"), F.count("*").alias("trusted")).where((F.col("trusted") >= ENOUGH) & F.col("l").isNotNull())
    middle = scratch.store(middle, "languages")
    overall = known.agg(F.percentile_approx("mean", 0.5, 10_000)).first()[0] or 0.0
    drawn = known.join(small_side(middle), "l", "left").withColumn("median", F.coalesce("median", F.lit(overall)))
    drawn = drawn.select("l", "median", ((F.col("mean") * F.col("n") + F.col("median") * prior) / (F.col("n") + prior)).alias("drawn"))
    high = F.percentile_approx("drawn", quantile, 10_000)
    per = drawn.groupBy("l", "median").agg(high.alias("q")).select("l", "median", (F.col("q") + margin * (F.col("q") - F.col("median"))).alias("bar"))
    bars = scratch.store(per.join(middle.select("l"), "l", "left_semi"), "bars")
    q = drawn.agg(high).first()[0]
    rest = (q if q is not None else math.inf) + margin * ((q - overall) if q is not None else 0.0)
    rows = scores.join(small_side(bars), F.col("lang") == F.col("l"), "left").withColumn("median", F.coalesce("median", F.lit(overall))).withColumn("bar", F.coalesce("bar", F.lit(rest)))
    pulled = (F.col("total") + F.col("median") * prior) / (F.col("n") + prior)
    empty = F.col("n") <= 1
    return rows.select("doc_id", "did", "tk", "lang", (F.col("n") - 1).alias("n_grams"), F.when(~empty, F.exp(pulled)).alias("perplexity"), F.exp("bar").alias("threshold"), (empty | (pulled <= F.col("bar"))).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that ``decide`` rejects."""
    spark = docs.sparkSession
    out = Scratch(spark, "rejected").store(decide(docs, labels).where("not keep").select(F.col("did").alias("_did"), F.col("tk").alias("_tk")).distinct(), "rejected")
    x, y = free(docs, "did", "tk")
    gone = out.select(F.col("_did").alias(x), F.col("_tk").alias(y))
    return docs.withColumns({x: did(), y: F.xxhash64("text")}).join(small_side(out, gone), [x, y], "left_anti").select(*docs.columns)
