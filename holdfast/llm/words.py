"""Words of many texts at once: boundaries and 64-bit hashes as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.RandomState(20).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

BLANKS = b" \t\n\x0b\x0c\r"


def byte_table(lower: bool = False, punctuation: bool = True) -> np.ndarray:
    """What each byte of a word counts as; 0 separates words.

    Blanks separate; without ``punctuation`` all ASCII but letters and digits does.
    ``lower`` makes A-Z equal to a-z, and with them the letters of Latin-1 (É and é). Bytes of
    other characters stay.
    """
    table = np.arange(256, dtype=np.uint8)
    table[0] = 0xFF  # NUL is part of a word; UTF-8 has no such byte
    table[list(BLANKS)] = 0
    if not punctuation:
        for byte in range(128):
            if not chr(byte).isalnum():
                table[byte] = 0
    if lower:
        table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``codes[start:end]`` for each span, whatever its place."""
    n = len(codes)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


@dataclass
class Block:
    """Some consecutive texts. ``first[i]`` is where the words of text i begin."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def size(self) -> int:
        return len(self.bounds) - 1

    @property
    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(self.size), np.diff(self.first))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all runs of ``n`` words inside one text."""
        last = np.repeat(self.first[1:], np.diff(self.first)) - n
        at = np.flatnonzero(np.arange(len(self.hashes)) <= last)
        return at, span_hashes(self.hashes, at, at + n)


def _lower_latin1(data: np.ndarray, codes: np.ndarray) -> None:
    """In UTF-8 the letters À to Þ are C3 80 to C3 9E, their lower case lies 32 higher; 97 is ×."""
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = (data[second] <= 0x9E) & (data[second] != 0x97)
    codes[second[upper]] += 32


def _split(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Block:
    codes = table[data]
    if table[ord("A")] == ord("a"):
        _lower_latin1(data, codes)
    inside = codes != 0
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    full = bounds[:-1] < bounds[1:]
    before[bounds[:-1][full]] = False
    after[bounds[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = span_hashes(_CODES[codes], starts, ends)
    return Block(data, bounds, starts, ends, np.searchsorted(starts, bounds), hashes)


def blocks(
    texts: pa.Array, table: np.ndarray, max_bytes: int = 1 << 20
) -> Iterator[tuple[int, Block]]:
    """Consecutive texts in blocks of about ``max_bytes``; a longer text is a block alone.

    Yields the number of the first text with each block. ``texts`` has no NULL.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    _, offsets, values = texts.buffers()
    width = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, width, len(texts) + 1, texts.offset * width().itemsize)
    bounds = bounds.astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(bounds, bounds[row] + max_bytes, "right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        low, high = bounds[row], bounds[stop]
        yield row, _split(data[low:high], bounds[row : stop + 1] - low, table)
        row = stop
