"""Token ids of whole texts, with each distinct piece of text between blanks encoded once for some megabytes of text.

A tokenizer that composes characters, lower-cases, and breaks texts at white space and between a letter and a sign gives a text
the ids of its pieces in a row; a word and the ASCII signs behind it can be encoded apart, and words without combining marks with ASCII letters in lower case. Most pieces
of a corpus repeat: a look-up costs far less than an encoding. Whether a tokenizer is one of these is read from its file; any
other encodes each text whole.

A piece of lower-case Latin letters alone is as it is after composing, lower-casing and breaking. Its bytes go to the tokenizer's
merges directly, many pieces in one call, where the tokenizer's file says that bytes are what it merges and that words' last tokens are marked.
A worker keeps nothing of one call for the next: in an open vocabulary most pieces that a call lacks are new.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are encoded at once.
AT_ONCE = 4 << 20
#: Plain pieces that are encoded in one call.
TOGETHER = 1 << 13
SIGNS = ".,!&%$*#;:?"
#: Lower-case letters that no normaliser changes.
LETTERS = "a-zß-öø-ÿ"
#: Fixed values of the tokenizer file: its normalisers, and the pattern by which it breaks texts.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
MARK = "</w>"
BREAKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def by_pieces(parts: dict) -> bool:
    """Whether a tokenizer, given its file's JSON, breaks and lower-cases texts in the way described above."""
    found = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
    breaks = [x.get("pattern", {}).get("Regex") for x in (parts["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]]
    return found == NORMALISERS and breaks == [BREAKS]


def by_bytes(parts: dict) -> bool:
    """Whether a tokenizer, likewise, merges the bytes of each part of a broken text, marks the end of each, and has a token for every byte at either place."""
    model = parts["model"]
    *_, last = [{}, *(parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
    if last.get("type") != "ByteLevel" or last["add_prefix_space"] or last["use_regex"] or model["type"] != "BPE" or model["dropout"] or model["end_of_word_suffix"] != MARK or model["continuing_subword_prefix"]:
        return False
    return all(x in model["vocab"] and x + MARK in model["vocab"] for x in _names_of_bytes())


def _names_of_bytes() -> list[str]:
    """The character by which a byte-level tokenizer's file names each byte: itself where it's printable, else those from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        self.pieced = by_pieces(parts)
        self.plain = None
        if self.pieced and by_bytes(parts):
            self.plain = Tokenizer(self.tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            names = self.tokenizer.get_vocab()
            self.last = np.zeros(max(names.values()) + 1, bool)
            self.last[[i for x, i in names.items() if x.endswith(MARK)]] = True
            self.named = np.array([ord(x) for x in _names_of_bytes()], np.uint32)
            self.named[ord(" ")] = ord(" ")

    def _together(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain pieces, and how many each has."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")[0].as_buffer()
        text = self.named[np.frombuffer(joined, np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("the tokenizer doesn't mark the last token of each word")
        return ids, np.diff(ends, prepend=0)

    def _ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """flat, first and count: the ids of piece k are flat[first[k]:first[k] + count[k]]."""
        plain = np.zeros(len(pieces), bool)
        if self.plain:
            plain = pc.match_substring_regex(pieces, f"^[{LETTERS}]+$").to_numpy(zero_copy_only=False)
        some, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        out = [self._together(pieces.take(pa.array(some[i : i + TOGETHER]))) for i in range(0, len(some), TOGETHER)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces.take(pa.array(others)).to_pylist(), add_special_tokens=False)]
        out.append((np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))))
        first, count = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        counts = np.concatenate([c for _, c in out])
        where = np.concatenate((some, others))
        count[where], first[where] = counts, np.cumsum(counts) - counts
        return np.concatenate([x for x, _ in out]), first, count

    def _words(self, raw: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """flat, first and count, likewise, of distinct words, from those of their stems and of the signs behind these."""
        # words with combining marks keep their capitals: the tokenizer composes characters before it lower-cases them
        low = pc.if_else(pc.match_substring_regex(raw, r"\p{M}"), raw, pc.ascii_lower(raw))
        stem = pc.ascii_rtrim(low, SIGNS)
        special = pc.match_substring(raw, "<|")
        apart = pc.and_(pc.match_substring_regex(stem, f"[A-Z{LETTERS}]$"), pc.invert(special))
        # most words have no signs behind them
        signed = np.flatnonzero(pc.and_(apart, pc.greater(pc.binary_length(low), pc.binary_length(stem))).to_numpy(zero_copy_only=False))
        signs = pc.replace_substring_regex(low.take(pa.array(signed)), f"(?s)^.*[^{SIGNS}]", "")
        pieces = pa.concat_arrays([pc.if_else(apart, stem, pc.if_else(special, raw, low)), signs]).dictionary_encode()
        at = pieces.indices.to_numpy(zero_copy_only=False)
        flat, first, count = self._ids(pieces.dictionary)
        halves = np.full((len(raw), 2), len(count))  # one behind the last: no ids
        halves[:, 0], halves[signed, 1] = at[: len(raw)], at[len(raw) :]
        flat, ends = _gathered(flat, np.append(first, 0), np.append(count, 0), halves.ravel())
        ends = np.concatenate(([0], ends[1::2]))
        return flat, ends[:-1], np.diff(ends)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        ids, ends = _gathered(*self._words(words.dictionary), words.indices.to_numpy(zero_copy_only=False))
        ends = np.concatenate(([0], ends))
        return ids, ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each whole text, in order, as unsigned 32-bit integers."""
        if not self.pieced:
            for text in texts:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            return
        start = size = 0
        for i, text in enumerate(texts):
            if i > start and size + len(text) > AT_ONCE:
                yield from self._several(texts[start:i])
                start, size = i, 0
            size += len(text)
        yield from self._several(texts[start:])

    def _several(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(texts) == 1 and len(texts[0]) > AT_ONCE:
            yield np.concatenate([self._encode(pa.array([part], pa.string()))[0] for part in _parts(texts[0])])
        elif texts:
            ids, bounds = self._encode(pa.array(texts, pa.string()))
            for a, b in zip(bounds, bounds[1:], strict=False):
                yield ids[a:b]


def _gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the rows, one after the other, and where each row's end."""
    count = count[rows]
    ends = np.cumsum(count)
    at = np.repeat(first[rows] - ends + count, count)
    at += np.arange(len(at))
    return flat[at], ends


def _parts(text: str) -> list[str]:
    """A long text cut at blanks into parts of about AT_ONCE; a run without blanks stays whole."""
    out, at = [], 0
    while len(text) - at > AT_ONCE:
        end = max(text.rfind(" ", at, at + AT_ONCE), text.rfind("\n", at, at + AT_ONCE))
        if end < at:
            end = min((x for x in (text.find(" ", at), text.find("\n", at)) if x >= 0), default=-1)
        if end < 0:
            break
        out.append(text[at : end + 1])
        at = end + 1
    return [*out, text[at:]]


@cache
def encoder(path: str) -> PieceEncoder:
    """One a worker and tokenizer file."""
    return PieceEncoder(path)
