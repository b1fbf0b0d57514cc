"""Toxicity of documents, judged on text restored from leetspeak, spacing and repetition.

Noisy channel: someone meant a plain text and wrote letters as signs, apart from each other, or several times. Where a text looks like
that, each observed character gets the letters that may have been meant, with the channel's cost, and Viterbi's algorithm takes the cheapest path
through that lattice, the cost of a path being the channel's and that of its letters under a model of characters. The model counts
n-grams of up to four characters over the words of all documents, in SLOTS counters that they are hashed to.

The restored text's words and their beginnings are hashed to SLOTS places too. The labelled training documents give each place a weight, the logarithm of
how much more often it stands in toxic ones; a document is judged by its heaviest words, with a logistic regression that is fitted on
weights to which the document itself hasn't contributed.

Counters are as many whatever the corpus, so the tables that go to the tasks have a fixed size; what they count is the whole corpus.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import SEGMENT, WORD_BASE, _power, mix
from .scratch import bounded_batches, free

SLOTS = 1 << 20
#: Letters that a sign may stand for.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou"}
#: Costs in nats: a sign for a letter; a sign as a break, at a word's edge and inside; a letter once more, of three and more, and of two; a separator between single letters left out.
AS_LETTER, EDGE, INSIDE, AGAIN, TWICE, JOINED = 2.0, 1.0, 4.0, 0.1, 5.0, 0.1
#: Characters of context, the weight of the next shorter context, and how many characters there might be.
CONTEXT, SHORTER, CHARACTERS = 3, 5.0, 1000
#: A longer doubtful passage is restored in pieces of so many characters, each going on where the last one ended.
PIECE = 2048
REMEMBERED = 200_000
#: Beginnings of words that are features, beside whole words, in characters.
PREFIXES = (4, 5, 6)
#: The weight of what is known of all words, in documents, and the share of toxic ones that counts as one document.
PRIOR, USUAL = 4.0, 0.1
#: Labelled rows the classifier is fitted on, about, at most.
SAMPLE = 200_000
#: A word of such a weight counts as a toxic one.
HEAVY = 2.5

INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
#: Signs that count before and behind a word; other signs do inside only.
BEFORE, BEHIND = "0123456789@$!|€£¡", "0123456789@$€"
#: What stands between single letters, and behind the last one.
SEPARATORS, STOPS = " .-_*", ".,;:!?"
_tables: dict[str, np.ndarray] = {}


def _is(name: str) -> np.ndarray:
    """By code point: letters, spaces (and what stands between texts), or the characters of a string."""
    if name not in _tables:
        if name in ("letter", "space"):
            test = str.isalpha if name == "letter" else lambda c: c.isspace() or c == BREAK
            _tables[name] = np.fromiter((test(chr(i)) for i in range(0x110000)), bool, 0x110000)
        else:
            _tables[name] = np.zeros(0x110000, bool)
            _tables[name][[ord(c) for c in name]] = True
    return _tables[name]


#: Between texts that are worked on together.
BREAK = "\0"


def plain(text: str) -> str:
    """Lower case, without invisible characters, compatible ones as the usual ones."""
    return INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower().replace(BREAK, " ")


def doubtful(points: np.ndarray) -> list[tuple[int, int, bool]]:
    """Passages that may not stand as they were meant: start, end, and whether they are single letters apart from each other.

    These are words with signs inside, right before or right behind their letters, or a letter three times in a row; at least three
    single letters or signs, two of them letters, one to three spaces apart; and words of single letters with other separators between them.
    """
    x = points
    letter, space, sign = _is("letter")[x], _is("space")[x], _is("".join(SIGNS))[x]
    starts, ends = (np.flatnonzero(np.diff((~space).view(np.int8), prepend=0, append=0) == k) for k in (1, -1))
    if not len(starts):
        return []
    hits = [2 + np.flatnonzero(letter[2:] & (x[2:] == x[1:-1]) & (x[1:-1] == x[:-2]))]
    first, behind = (np.flatnonzero(np.diff(sign.view(np.int8), prepend=0, append=0) == k) for k in (1, -1))
    wide = np.concatenate((letter, [False])), np.concatenate((space, [True]))
    before, after = wide[0][first - 1], wide[0][behind]  # -1 is the added one
    edge, end = wide[1][first - 1], wide[1][behind]
    hits.append(first[before & after | edge & after & _is(BEFORE)[x[behind - 1]] | before & end & _is(BEHIND)[x[first]]])
    between = _is(SEPARATORS[1:])[x]
    alone = letter | sign & ~between
    # three of them with a separator between each two: the word counts as such if nothing in it is another letter's neighbour
    dotted = np.flatnonzero(alone[:-4] & between[1:-3] & alone[2:-2] & between[3:-1] & alone[4:]) if len(x) > 4 else np.zeros(0, int)
    pairs = np.searchsorted(starts, 1 + np.flatnonzero(letter[1:] & letter[:-1]), "right") - 1
    hit, apart = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    hit[np.searchsorted(starts, np.concatenate(hits), "right") - 1] = True
    apart[np.searchsorted(starts, dotted, "right") - 1] = True
    apart[pairs] = False
    # tokens of one character, a stop behind it or not, in a row
    size = ends - starts
    single = alone[starts] & ((size == 1) | (size == 2) & _is(STOPS)[x[ends - 1]])
    gap = np.concatenate((starts[1:] - ends[:-1], [9]))
    near = (gap <= 3) & (x[np.minimum(ends, len(x) - 1)] == 32) & (np.concatenate((x[starts[1:] - 1], [0])) == 32)
    linked = single & near & np.concatenate((single[1:], [False]))
    first, last = (np.flatnonzero(np.diff(linked.view(np.int8), prepend=0, append=0) == k) for k in (1, -1))
    rows, taken = [], np.zeros(len(starts) + 1, np.int8)
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        if j - i >= 2 and letter[starts[i : j + 1]].sum() > 1:
            rows.append((int(starts[i]), int(ends[j]), True))
            taken[i : j + 1] = 1
    for i in np.flatnonzero((hit | apart) & (taken[:-1] == 0)).tolist():
        rows.append((int(starts[i]), int(ends[i]), bool(apart[i])))
    return sorted(rows)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def together(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of several texts in a row, a break behind each; the texts' numbers; where they start. A text beyond a SEGMENT comes in pieces, cut between words where it can be."""
    held, rows, size = [], [], 0

    def given():
        starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in held])[:-1]))
        return _points("\n".join([*held, ""])), np.array(rows), starts

    for row, text in enumerate(texts):
        at = 0
        while True:
            end = min(len(text), at + SEGMENT - 2)
            if end < len(text):
                back = next((i for i in range(end, max(at, end - 1000), -1) if not text[i].isalpha()), end)
                end = back
            part = text[at:end]
            if held and size + len(part) + 1 > SEGMENT:
                yield given()
                held, rows, size = [], [], 0
            held.append(part)
            rows.append(row)
            size += len(part) + 1
            at = end
            if at >= len(text):
                break
    if held:
        yield given()


# The model of characters


def _places(symbols: list[int]) -> list[int]:
    """As ``grams``, for those that end in the last symbol, the shortest first."""
    out, h = [], 0
    for k, c in enumerate(reversed(symbols), 1):
        h = ((h * 31 + c + k) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 29
        out.append(h & (SLOTS - 1))
    return out


def grams(points: np.ndarray) -> list[np.ndarray]:
    """Places of the n-grams of 1 to CONTEXT + 1 characters that end at each letter and each word's end; they don't reach beyond the word's start."""
    c = np.where(_is("letter")[points], points, 0).astype(np.uint64)
    c = np.concatenate((np.zeros(CONTEXT, np.uint64), c, np.zeros(1, np.uint64)))
    last, before = c[CONTEXT:], c[CONTEXT - 1 : -1]
    use = (last != 0) | (before != 0)
    symbols, edge = [last[use]], np.zeros(int(use.sum()), bool)
    for k in range(1, CONTEXT + 1):
        s = c[CONTEXT - k : len(c) - k][use]
        edge |= s == 0
        symbols.insert(0, np.where(edge, np.uint64(0), s))
    h, out = np.zeros(len(edge), np.uint64), []
    for k, s in enumerate(reversed(symbols), 1):
        h = (h * np.uint64(31) + s + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        out.append((h & np.uint64(SLOTS - 1)).astype(np.int64))
    return out


class Speller:
    """Restores texts under counts of n-grams."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.total = 0.0
        self.known: dict[str, float] = {}
        self.restored: dict[str, str] = {}

    def cost(self, context: str, c: str) -> float:
        """Nats of a character behind CONTEXT others; a space is a word's edge, and what stands before one is spaces."""
        key = context + c
        if key not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            symbols = [0 if x == " " else ord(x) for x in key]
            edge, p = self.counts[_places([0])[0]], 1 / CHARACTERS
            if not self.total:
                self.total = float(self.counts.sum()) / (CONTEXT + 1)
            wider = [self.total, *self.counts[_places(symbols[:-1])].tolist()]
            if context[-1] == " ":  # a word begins as often as one ends
                wider = [self.total] + [float(edge)] * CONTEXT
            for n, all_ in zip(self.counts[_places(symbols)].tolist(), wider, strict=True):
                p = min(1.0, (n + SHORTER * p) / (max(all_, n) + SHORTER))
            self.known[key] = -math.log(p)
        return self.known[key]

    def decode(self, lattice: list[list[tuple[str, float]]], start: str) -> tuple[str, str]:
        """The cheapest path: the characters it emits (none, one or a break each) and the context it ends in."""
        states: dict[str, tuple] = {start: (0.0, None)}
        for choices in lattice:
            after: dict[str, tuple] = {}
            for context, (cost, path) in states.items():
                for c, extra in choices:
                    if not c or c == context[-1] == " ":
                        new, to, way = cost + extra, context, path
                    else:
                        new, way = cost + extra + self.cost(context, c), (path, c)
                        to = " " * CONTEXT if c == " " else context[1:] + c
                    if to not in after or new < after[to][0]:
                        after[to] = (new, way)
            states = after
        _, context, path = min(((cost + (self.cost(context, " ") if context[-1] != " " else 0.0), context, path) for context, (cost, path) in states.items()), key=lambda x: x[0])
        out = []
        while path:
            path, c = path
            out.append(c)
        return "".join(reversed(out)), context

    def meant(self, seen: str, apart: bool) -> str:
        """A doubtful passage, restored."""
        if (done := self.restored.get(seen)) is not None:
            return done
        lattice, out, context = channel(seen, apart), [], " " * CONTEXT
        for i in range(0, len(lattice), PIECE):
            text, context = self.decode(lattice[i : i + PIECE], context)
            out.append(text)
        done = "".join(out)
        if len(seen) <= 64:
            if len(self.restored) > REMEMBERED:
                self.restored.clear()
            self.restored[seen] = done
        return done

    def restore(self, texts: list[str]) -> list[str]:
        """Texts as they are judged: plain, with their doubtful passages restored."""
        out, held, size = [], [], 0
        for text in [*map(plain, texts), None]:
            if held and (text is None or size + len(text) > SEGMENT):
                whole, at, parts = BREAK.join(held), 0, []
                for start, end, apart in doubtful(_points(whole)):
                    parts += [whole[at:start], " ", self.meant(whole[start:end], apart), " "]
                    at = end
                out += "".join([*parts, whole[at:]]).split(BREAK)
                held, size = [], 0
            if text is not None:
                held.append(text)
                size += len(text) + 1
        return out


def channel(seen: str, apart: bool) -> list[list[tuple[str, float]]]:
    """For each character seen, what may have been meant there, and the cost."""
    first = next((i for i, c in enumerate(seen) if c.isalpha()), 0)
    last = next((i for i in range(len(seen) - 1, -1, -1) if seen[i].isalpha()), len(seen))
    run, runs = 0, []
    for i, c in enumerate(seen):  # how often a character stands there in a row
        if not i or c != seen[i - 1]:
            run = 1
            while i + run < len(seen) and seen[i + run] == c and run < 3:
                run += 1
        runs.append(run)
    out = []
    for i, c in enumerate(seen):
        if c.isalpha():
            choices = [(c, 0.0)]
        elif apart and c in SEPARATORS:
            wide = c == " " and " " in (seen[i - 1 : i], seen[i + 1 : i + 2])
            choices = [(" ", 0.0), ("", INSIDE if wide else JOINED)]
        else:
            choices = [(" ", 0.0 if c not in SIGNS else EDGE if i < first or i > last else INSIDE)]
            choices += [(x, AS_LETTER) for x in SIGNS.get(c, "")]
        if i and c == seen[i - 1] and c != " ":
            choices.append(("", AGAIN if runs[i] > 2 else TWICE))
        out.append(choices)
    return out


def _counters(docs: DataFrame, counted: Callable[[list[str], pa.RecordBatch], Iterator[tuple[int, np.ndarray]]], kinds: int) -> np.ndarray:
    """Counters by kind and place: each task adds up its own and gives those it has met, at most kinds * SLOTS."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(kinds * SLOTS, np.int64)
        for batch in stream:
            for kind, places in counted(batch.column("text").to_pylist(), batch):
                own += np.bincount(places + kind * SLOTS, minlength=kinds * SLOTS) if len(places) > SLOTS // 8 else 0
                if len(places) <= SLOTS // 8:
                    np.add.at(own, places + kind * SLOTS, 1)
        met = np.flatnonzero(own)
        for i in range(0, len(met), 1 << 16):
            part = met[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(own[part])], names=["place", "n"])

    table = docs.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # at most kinds * SLOTS rows
    out = np.zeros(kinds * SLOTS, np.int64)
    out[table.column("place").to_numpy()] = table.column("n").to_numpy()
    return out.reshape(kinds, SLOTS)


def character_counts(docs: DataFrame) -> np.ndarray:
    """The model of characters, counted over the whole texts of all documents."""

    def counted(texts: list[str], batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for points, _, _ in together([plain(t) for t in texts]):
            yield 0, np.concatenate(grams(points))

    return _counters(docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), counted, 1)[0].astype(np.float32)


# Features and the classifier


def features(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its places: the whole word's and those of its beginnings (words, 1 + PREFIXES)."""
    inside = _is("letter")[points]
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power(WORD_BASE)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    out = np.empty((len(starts), 1 + len(PREFIXES)), np.int64)
    for j, most in enumerate((0, *PREFIXES)):
        length = np.minimum(ends - starts, most) if most else ends - starts
        h = (sums[starts + length] - sums[starts]) * down[starts]
        out[:, j] = mix(h ^ (length.astype(np.uint64) << np.uint64(48)) ^ np.uint64(most << 24)) & np.uint64(SLOTS - 1)
    return starts, out


def weights(toxic: np.ndarray, clean: np.ndarray, many_toxic: int, many_clean: int) -> np.ndarray:
    """By place: the logarithm of how much likelier a document that has it is toxic, drawn to none by PRIOR."""
    share = (many_toxic + USUAL) / (many_toxic + many_clean + 1)
    odds = (np.maximum(toxic, 0) + PRIOR * share) / (np.maximum(clean, 0) + PRIOR * (1 - share))
    return (np.log(odds) - math.log(share / (1 - share))).astype(np.float32)


def document_features(texts: list[str], table: np.ndarray) -> np.ndarray:
    """For each restored text: its heaviest word's weight, the number of heavy words and their weight (as logarithms), and the share of them."""
    best, heavy, total, words = (np.zeros(len(texts)) for _ in range(4))
    for points, rows, at in together(texts):
        starts, places = features(points)
        if not len(starts):
            continue
        weight = table[places].max(1)
        row = rows[np.searchsorted(at, starts, "right") - 1]
        np.maximum.at(best, row, weight)
        much = weight > HEAVY
        heavy += np.bincount(row[much], minlength=len(texts))
        total += np.bincount(row[much], weights=weight[much], minlength=len(texts))
        words += np.bincount(row, minlength=len(texts))
    return np.stack([best, np.log1p(heavy), np.log1p(total), heavy / np.maximum(words, 1)], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Coefficients, the constant last, by Newton's method; the constant isn't drawn to zero."""
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    share = (y.sum() + USUAL) / (len(y) + 1)
    b = np.zeros(x.shape[1])
    b[-1] = math.log(share / (1 - share))
    if len(set(y.tolist())) < 2:
        return b
    pull = np.full(len(b), ridge)
    pull[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * b)
        b += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return b


def held_out() -> Column:
    """Whether a document is none of those whose labels are learned from: crc32 of its doc_id as text is divisible by 5; false for null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id and toxic (0 or 1) of the rows that may be learned from, one a doc_id, toxic if any row says so: all, or about ``sample`` of them by a hash."""
    rows = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    many = rows.count()
    return rows if many <= sample else rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(many)) < sample)


class Model:
    """What scores documents: the counts of characters, the weights of places, the coefficients."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
        spark = docs.sparkSession
        bounded_batches(spark)
        context = spark.sparkContext
        self.speller = speller = context.broadcast(Speller(character_counts(docs)))
        known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(training(labels, sample)), "doc_id").select("text", "toxic")  # about ``sample`` rows

        def counted(texts: list[str], batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
            restore = speller.value.restore
            for text, toxic in zip(restore(texts), batch.column("toxic").to_pylist(), strict=True):
                yield 1 - toxic, np.unique(np.concatenate([np.zeros(0, np.int64), *(features(points)[1].ravel() for points, _, _ in together([text]))]))

        toxic, clean = _counters(known, counted, 2)
        many = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
        n1, n0 = many.get(1, 0), many.get(0, 0)
        # a document's own words don't count for it
        without = context.broadcast([weights(toxic, clean - 1, n1, n0), weights(toxic - 1, clean, n1, n0)])

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restore = speller.value.restore
            for batch in stream:
                texts, y = restore(batch.column("text").to_pylist()), batch.column("toxic").to_numpy()
                x = np.where(y[:, None] == 1, document_features(texts, without.value[1]), document_features(texts, without.value[0]))
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), pa.array(y, pa.int32())], names=["a", "b", "c", "d", "y"])

        table = known.mapInArrow(run, "a double, b double, c double, d double, y int").toArrow()  # about ``sample`` rows of five numbers
        self.coefficients = logistic(np.stack([table.column(c).to_numpy() for c in "abcd"], 1), table.column("y").to_numpy())
        self.weights = context.broadcast(weights(toxic, clean, n1, n0))

    def score(self, docs: DataFrame) -> DataFrame:
        """The columns of docs and ``score``, 0 to 1 (with underscores where taken); a null text is an empty one."""
        name, seen = free(docs, "score", "seen")
        speller, table, coefficients = self.speller, self.weights, self.coefficients

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restore = speller.value.restore
            for batch in stream:
                x = document_features(restore(batch.column(seen).to_pylist()), table.value)
                p = 1 / (1 + np.exp(-np.clip(x @ coefficients[:-1] + coefficients[-1], -30, 30)))
                kept = batch.drop_columns([seen])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(p)], names=[*kept.schema.names, name])

        form = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"
        return docs.withColumn(seen, F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, form)


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5) of every row of documents.

    Only ``text`` makes a score, and only labels of doc_ids whose crc32 as text isn't divisible by 5 are learned from; rows that repeat are scored alike. A null or empty
    text has no words and gets the score of that. A null doc_id has no labels and isn't held out. Without labels of both kinds every text gets one score,
    the share of toxic ones (0.1 where there are none at all). Other columns are ignored; no documents give no rows.
    """
    model = Model(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return model.score(rows).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
