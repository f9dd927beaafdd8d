"""Token counts by rank-synchronous merging of batched pre-tokens."""

from __future__ import annotations

import functools
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.vocabulary import BYTE_LEVEL, Vocabulary, byte_characters, read_file
from holdfast.shipping import ship_package

_NEVER = np.int64(1) << 40
_SHIFT = 20
#: Sequences of more symbols are merged alone, see ``BatchMerger.count_long``.
_LONG = 1024


class BatchMerger:
    """Counts the symbols that byte sequences end with, many sequences at a time."""

    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.ids
        self.of_byte = np.array([ids[c] for c in byte_characters()], np.int64)
        pairs = [(ids[a] << _SHIFT | ids[b], ids[a + b]) for a, b in vocabulary.merges]
        keys = np.array([k for k, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([m for _, m in pairs], np.int64)[order]

    def _lookup(self, symbols: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol the place and rank of its pair with the next of its sequence."""
        pairs = symbols << _SHIFT
        pairs[:-1] |= symbols[1:]
        place = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        found = (self.keys[place] == pairs) & ~last
        return place, np.where(found, self.ranks[place], _NEVER)

    def count_long(self, sequence: bytes) -> int:
        """As :meth:`count` for one long sequence, in time that grows with its length.

        A round again applies all occurrences of the lowest rank at once, but then looks only at
        the neighbours of what it has joined: places wait by rank, and a place whose pair has
        changed meanwhile is passed over.
        """
        symbols = self.of_byte[np.frombuffer(sequence, np.uint8)]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        last = np.zeros(n, bool)
        last[-1] = True
        place, rank = self._lookup(symbols, last)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < _NEVER]
            places = places[np.argsort(rank[places], kind="stable")]
            own, starts = np.unique(rank[places], return_index=True)
            for r, some in zip(own.tolist(), np.split(places, starts[1:])):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(some)

        wait(np.arange(n))
        left = n
        while ranks:
            lowest = heapq.heappop(ranks)
            chosen = np.unique(np.concatenate(waiting.pop(lowest)))
            chosen = chosen[rank[chosen] == lowest]
            if not len(chosen):
                continue
            # Of overlapping occurrences (aaa), every second one from the left.
            new_run = np.append(True, after[chosen[:-1]] != chosen[1:])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run_start) % 2 == 0]
            gone = after[chosen]
            beyond = after[gone]
            symbols[chosen] = self.merged[place[chosen]]
            after[chosen] = beyond
            inside = beyond < n
            before[beyond[inside]] = chosen[inside]
            rank[gone] = _NEVER
            left -= len(chosen)
            changed = np.unique(np.append(chosen, before[chosen]))
            changed = changed[changed >= 0]
            at_end = after[changed] >= n
            rank[changed[at_end]] = _NEVER
            changed = changed[~at_end]
            pairs = symbols[changed] << _SHIFT | symbols[after[changed]]
            found = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            place[changed] = found
            rank[changed] = np.where(self.keys[found] == pairs, self.ranks[found], _NEVER)
            wait(changed)
        return left

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols of each non-empty sequence after all merges.

        The sequences are one ragged array. Each round applies to every sequence all
        occurrences of its pair of lowest rank, and lets go of sequences without a pair. Long
        sequences, which take many rounds, are merged one by one.
        """
        lengths = np.array([len(s) for s in sequences], np.int64)
        long = lengths > _LONG
        if long.any():
            counts = np.zeros(len(sequences), np.int64)
            counts[~long] = self.count([s for s in sequences if len(s) <= _LONG])
            counts[long] = [self.count_long(s) for s in sequences if len(s) > _LONG]
            return counts
        lengths = np.array([len(s) for s in sequences], np.int64)
        counts = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        names = np.arange(len(sequences))
        while len(names):
            starts = np.cumsum(lengths) - lengths
            last = np.zeros(len(symbols), bool)
            last[starts + lengths - 1] = True
            place, rank = self._lookup(symbols, last)
            lowest = np.minimum.reduceat(rank, starts)
            owner = np.repeat(np.arange(len(names)), lengths)
            chosen = np.flatnonzero((rank == lowest[owner]) & (rank < _NEVER))
            # Of overlapping occurrences (aaa), every second one from the left.
            new_run = np.diff(chosen, prepend=-2) > 1
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run_start) % 2 == 0]
            symbols[chosen] = self.merged[place[chosen]]
            lengths -= np.bincount(owner[chosen], minlength=len(names))
            counts[names] = lengths
            going_on = lowest < _NEVER
            stays = going_on[owner]
            stays[chosen + 1] = False
            symbols, lengths, names = symbols[stays], lengths[going_on], names[going_on]
        return counts


class Counter:
    """Tokens of texts; the counts of up to ``remembered`` different pre-tokens are kept."""

    def __init__(self, content: bytes, remembered: int = 300_000, batch_bytes: int = 1 << 20):
        vocabulary = Vocabulary.parse(content)
        self.merger = BatchMerger(vocabulary)
        self.specials = vocabulary.special_pattern()
        self.pattern = regex.compile(BYTE_LEVEL)
        self.remembered, self.batch_bytes = remembered, batch_bytes
        self.known: dict[str, int] = {}

    def _learn(self, words: list[str]) -> None:
        batch, size = [], 0
        for i, word in enumerate(words):
            batch.append(word)
            size += len(word)
            if size >= self.batch_bytes or i == len(words) - 1:
                counts = self.merger.count([w.encode() for w in batch])
                self.known.update(zip(batch, counts.tolist()))
                batch, size = [], 0

    def _count_some(self, texts: list[str]) -> list[int]:
        split = [self.specials.split(text) for text in texts]
        cut = [[w for part in parts[::2] for w in self.pattern.findall(part)] for parts in split]
        if len(self.known) > self.remembered:
            self.known.clear()
        self._learn(list(set().union(*cut) - self.known.keys()))
        count = self.known.__getitem__
        return [sum(map(count, words)) + len(parts) // 2 for words, parts in zip(cut, split)]

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= self.batch_bytes:
                out += self._count_some(some)
                some, size = [], 0
        return out + self._count_some(some)


@functools.lru_cache(maxsize=4)
def _counter(content: bytes) -> Counter:
    return Counter(content)


def token_count(df: DataFrame, path: str, text_column: str = "text") -> Column:
    """Tokens of a text column of ``df`` under the byte-level tokenizer file at ``path``.

    Counts are those of the library with its defaults: special strings inside a text are one
    token each, nothing is added or cut. NULL and empty texts have 0 tokens. The time grows
    with the length of a text, also of one that is a single very long word. The file is read
    on the driver and sent to the workers; it has a fixed size of one or two MB. No shuffle.
    """
    ship_package(df.sparkSession)
    content = df.sparkSession.sparkContext.broadcast(read_file(path))

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        counter = _counter(content.value)
        # A few rows at a time, so that Python holds only those as objects.
        some = (texts.slice(i, 512).to_pylist() for i in range(0, len(texts), 512))
        return pa.array([n for rows in some for n in counter.count(rows)], pa.int64())

    return counted(F.coalesce(text_column, F.lit("")))
