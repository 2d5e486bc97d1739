"""Content-chosen suffixes of texts: the places that stand for all strings of a given length.

Of the ``gram``-byte strings within each ``span``-byte string, the one with the
least hash is its anchor, the leftmost at a tie. Equal strings choose equal anchors
at equal places, wherever they stand. A text's strings of ``span`` bytes fall into
runs with the same anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

SPAN, GRAM = 50, 18
#: Bytes of text at a time; a place within them and the high bits of a hash share a word.
PART = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1


class Runs(NamedTuple):
    """Runs of strings with the same anchor, in order of text and place."""

    text: np.ndarray  # number of the text in the list
    start: np.ndarray  # first byte of the first string
    count: np.ndarray  # strings in the run
    offset: np.ndarray  # from the first string's first byte to the anchor
    gram: np.ndarray  # hash of the anchor
    whole: np.ndarray  # hash of all bytes of the run, and of the offset


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        factors = np.full(n + 1, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    up, down = out
    return up, down


class Hashes:
    """Hashes of any part of some bytes, from sums of the bytes times powers of a base."""

    def __init__(self, data: np.ndarray):
        self._up, self._down = _powers(1 << max(20, len(data).bit_length()))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return (self._sums[end] - self._sums[start]) * self._down[: len(self._sums)][start]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _pieces(texts: list[bytes], span: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of ``(text, from, to)`` of about PART bytes; the pieces of a longer text overlap by two spans."""
    piece: list[tuple[int, int, int]] = []
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - 2 * span, 1), PART):
            end = min(len(text), at + PART + 2 * span)
            if end - at < span:
                continue
            if held + end - at > PART + 2 * span:
                yield piece
                piece, held = [], 0
            piece.append((i, at, end))
            held += end - at
    if piece:
        yield piece


def runs(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> Iterator[Runs]:
    """The runs of all texts. A run that the cut of a very long text divides comes in two parts."""
    width = span - gram + 1
    for piece in _pieces(texts, span):
        data = np.frombuffer(b"".join(texts[i][a:b] for i, a, b in piece), np.uint8)
        length = np.array([b - a for _, a, b in piece])
        first = np.cumsum(length) - length
        hashes = Hashes(data)
        grams = hashes.of(slice(0, len(data) - gram + 1), slice(gram, len(data) + 1))
        places = np.arange(len(grams), dtype=np.uint64)
        least = _least((mix(grams) & ~_PLACE) | places, width) & _PLACE
        # Strings that start in this piece: those of a further piece's overlap are left to it.
        n_own = np.array([min(PART, b - a - span + 1) if b < len(texts[i]) else b - a - span + 1 for i, a, b in piece])
        own = np.repeat(first, n_own) + np.arange(n_own.sum()) - np.repeat(np.cumsum(n_own) - n_own, n_own)
        chosen = least[own].astype(np.int64)
        part = np.repeat(np.arange(len(piece)), n_own)
        new = np.ones(len(chosen), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        count = np.diff(at, append=len(chosen))
        start, part, anchor = own[at], part[at], chosen[at]
        offset = anchor - start
        whole = mix(hashes.of(start, start + count + span - 1) + mix((offset * 65536 + count).astype(np.uint64)))
        text = np.array([i for i, _, _ in piece])[part]
        from_ = np.array([a for _, a, _ in piece])[part] - first[part]
        yield Runs(text, start + from_, count, offset, mix(grams[anchor]), whole)
