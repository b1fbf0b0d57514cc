"""Vectorised 64-bit hashes of words and of runs of consecutive words.

A run's hash is a polynomial in its words' hashes, taken from prefix sums modulo 2**64, so each run costs the same
whatever its length. Texts go in as UTF-8 bytes and words are runs of bytes other than ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SEGMENT = 1 << 20
WORD_BASE = 0x9E3779B97F4A7C15
RUN_BASE = 0xD1342543DE82EF95

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i up to SEGMENT."""
    if base not in _powers:
        steps = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(SEGMENT + 1, b, np.uint64)
            p[0] = 1
            steps.append(np.multiply.accumulate(p))
        _powers[base] = steps[0], steps[1]
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of one segment."""
    inside = ~_IS_SPACE[data]
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _power(WORD_BASE)
    if len(data) > SEGMENT:  # a single word longer than a segment
        total, n = np.uint64(0), 0
        for i in range(0, len(data), SEGMENT):
            part = data[i : i + SEGMENT]
            h = ((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)]).sum(dtype=np.uint64)
            total = mix(np.array([total + h], np.uint64))[0]
            n += len(part)
        return mix(np.array([total ^ np.uint64(n)], np.uint64)), starts[:1]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48))), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a text of any length, and the byte at which the word starts."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= SEGMENT:
        return _segment_words(raw)
    hashes, starts, at = [], [], 0
    while at < len(raw):
        end = min(at + SEGMENT, len(raw))
        if end < len(raw):
            space = np.flatnonzero(_IS_SPACE[raw[at:end]])
            if len(space):
                end = at + int(space[-1]) + 1
            else:  # one word fills the segment: go on to its end
                while end < len(raw) and not _IS_SPACE[raw[end]]:
                    far = np.flatnonzero(_IS_SPACE[raw[end : end + SEGMENT]])
                    end = end + int(far[0]) if len(far) else min(end + SEGMENT, len(raw))
        h, s = _segment_words(raw[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words: len(words) - n + 1 of them."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = _power(RUN_BASE)
    out = np.empty(len(words) - n + 1, np.uint64)
    step = SEGMENT - n
    for i in range(0, len(out), step):
        part = words[i : i + step + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        m = len(part) - n + 1
        out[i : i + m] = (sums[n:] - sums[:-n]) * down[:m]
    return mix(out)


def batches(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about a segment together; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) + 1 > SEGMENT:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts in a row, and the bounds of each text's words (len(texts) + 1 of them)."""
    hashes, starts = word_hashes(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.concatenate(([0], np.searchsorted(starts, ends)))
