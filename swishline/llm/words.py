"""Words and word windows of whole texts as 64-bit numbers, by numpy over Arrow buffers.

A word is a run of bytes other than space and \\x09 to \\x0D. Equal words get equal
numbers; different words get different ones but for the usual chance of 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240501)
_BYTES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_PLACES = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
CHUNK = 1 << 20


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, CHUNK)
_DOWN = _powers(_INVERSE, CHUNK)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x + np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each run of 64-bit values; runs begin at ``starts``, the first at 0.

    Values of 0 leave no trace. Works in chunks, so that memory stays bounded.
    """
    out = np.zeros(len(starts), np.uint64)
    for low in range(0, len(values), CHUNK):
        high = min(low + CHUNK, len(values))
        first = int(np.searchsorted(starts, low, "right")) - 1
        last = int(np.searchsorted(starts, high, "left"))
        own = np.maximum(starts[first:last], low) - low
        sums = np.add.reduceat(values[low:high] * _UP[: high - low], own)
        # relative to the run's own start, which may lie in an earlier chunk
        begun = starts[first:last]
        inside = begun >= low
        scale = _DOWN[np.where(inside, begun - low, 0)]
        if not inside[0]:
            scale[0] = np.uint64(pow(_BASE, low - int(begun[0]), 1 << 64))
        out[first:last] += sums * scale
    return mixed(out)


class Words:
    """The words of a run of documents: number, document and start of each."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, fold: bool):
        """``data``: the bytes of all documents; ``ends``: n + 1 offsets; ``fold``: A-Z as a-z."""
        inside = ~SPACE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        filled = ends[:-1][ends[:-1] < ends[1:]]
        begins[filled] = inside[filled]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        self.doc = np.searchsorted(ends, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=len(ends) - 1)
        self.ends = np.concatenate([[0], np.cumsum(self.counts)])  # offsets of words by document
        if len(self.starts):
            skip = self.starts[0]
            values = (_FOLDED if fold else _BYTES)[data[skip:]]
            values *= inside[skip:]
            self.hashes = run_hashes(values, self.starts - skip)
        else:
            self.hashes = np.empty(0, np.uint64)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows of ``width`` words in one document, and their first words."""
        count = len(self.hashes) - width + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = np.zeros(count, np.uint64)
        for k in range(width):
            total += self.hashes[k : k + count] * _PLACES[k]
        first = np.flatnonzero(self.doc[:count] == self.doc[width - 1 :])
        return mixed(total[first], width), first


def of_documents(numbers: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Numbers made different from document to document."""
    return mixed(numbers ^ mixed(doc.astype(np.uint64), 7))


def line_repeats(data: np.ndarray, ends: np.ndarray, words: Words) -> np.ndarray:
    """By document: lines (cut at \\n) that hold a word and equal an earlier line."""
    count = len(ends) - 1
    cuts = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate([ends[:-1], cuts[cuts < len(data)]]))
    starts = starts[starts < len(data)]
    if not len(starts):
        return np.zeros(count, np.int64)
    values = _BYTES[data]
    values[data == 10] = 0
    lines = run_hashes(values, starts)
    with_word = np.add.reduceat(words.inside.astype(np.int64), starts) > 0
    doc = np.searchsorted(ends, starts, "right") - 1
    lines, doc = lines[with_word], doc[with_word]
    order = np.argsort(of_documents(lines, doc), kind="stable")
    same = np.zeros(len(lines), bool)
    same[1:] = (lines[order][1:] == lines[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][same], minlength=count)


def window_repeats(words: Words, width: int) -> np.ndarray:
    """By document: words in windows of ``width`` that occur twice or more in it."""
    numbers, first = words.windows(width)
    own = of_documents(numbers, words.doc[first])
    order = np.argsort(own)
    equal = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(len(words.hashes), bool)
    for k in range(width):
        covered[first[twice] + k] = True
    return np.bincount(words.doc[covered], minlength=len(words.counts))


def per_document(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each document."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends[1:]] - total[ends[:-1]]
