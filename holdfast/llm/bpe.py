"""BPE encoding and decoding: a contiguous array of ranks per word."""

from __future__ import annotations

import functools
import heapq
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.vocabulary import SPACE, WORD_LEVEL, Vocabulary, byte_characters, read_file
from holdfast.shipping import ship_package

_NEVER = 1 << 40
#: Words of more symbols are merged with a heap: scans for the minimum would be quadratic.
LONG_WORD = 256


class WordBPE:
    """Encodes texts as ids and decodes ids; remembers up to ``remembered`` words."""

    def __init__(self, content: bytes, remembered: int = 300_000):
        vocabulary = Vocabulary.parse(content)
        ids = vocabulary.ids
        self.vocabulary, self.remembered = vocabulary, remembered
        self.symbols = byte_characters()
        self.merges = {
            (ids[a], ids[b]): (rank, ids[a + b])
            for rank, (a, b) in enumerate(vocabulary.merges)
        }
        self.strings = {i: s for s, i in {**ids, **vocabulary.specials}.items()}
        self.specials = vocabulary.special_pattern()
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.pattern = regex.compile(WORD_LEVEL)
        self.known: dict[str, bytes] = {}

    def _first_ids(self, word: str) -> list[int]:
        symbols = [self.symbols[b] for b in word.encode()]
        symbols[-1] += self.vocabulary.suffix
        return [self.vocabulary.ids[s] for s in symbols]

    def merge_short(self, ids: list[int]) -> list[int]:
        """Scan the adjacent ranks for the minimum, join there, refresh both neighbours."""
        merges, none = self.merges, (_NEVER, -1)
        ranks = [merges.get(pair, none)[0] for pair in zip(ids, ids[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == _NEVER:
                break
            i = ranks.index(lowest)
            ids[i] = merges[ids[i], ids[i + 1]][1]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = merges.get((ids[i], ids[i + 1]), none)[0]
            if i:
                ranks[i - 1] = merges.get((ids[i - 1], ids[i]), none)[0]
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same result from a heap of (rank, place) and links between the parts."""
        merges, n = self.merges, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [
            (merges[pair][0], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in merges
        ]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i] = merges[pair][1]
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    new = (ids[left], ids[right])
                    if new in merges:
                        heapq.heappush(heap, (merges[new][0], left, new))
        return [x for x, kept in zip(ids, alive) if kept]

    def _packed(self, word: str) -> bytes:
        ids = self._first_ids(word)
        merged = self.merge_short(ids) if len(ids) <= LONG_WORD else self.merge_long(ids)
        return np.array(merged, "<u4").tobytes()

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return self.pattern.findall(text.lower())
        # Lower case without regard to a word's end, as the vocabulary was made.
        text = self.spaces.sub(" ", unicodedata.normalize("NFC", text))
        return self.pattern.findall(text.replace("Σ", "σ").lower())

    def encode(self, text: str) -> bytes:
        """The ids of a text, each as four bytes, the lowest first."""
        known, out = self.known, []
        if len(known) > self.remembered:
            known.clear()
        for i, part in enumerate(self.specials.split(text)):
            if i % 2:
                out.append(np.array([self.vocabulary.specials[part]], "<u4").tobytes())
                continue
            words = self._words(part)
            for word in set(words).difference(known):
                known[word] = self._packed(word)
            out += map(known.__getitem__, words)
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The strings of the ids, joined by spaces, as a file without decoder means it."""
        ids = array("I", packed)
        return " ".join(map(self.strings.__getitem__, ids))


@functools.lru_cache(maxsize=4)
def _coder(content: bytes) -> WordBPE:
    return WordBPE(content)


def _sent(df: DataFrame, path: str):
    ship_package(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(read_file(path))


def _in_slices(texts: pa.Array, work, kind: pa.DataType, rows: int = 256) -> pa.Array:
    """``work`` on a few rows at a time, so that Python holds only those as objects."""
    parts = [
        pa.array([work(x) for x in texts.slice(i, rows).to_pylist()], kind)
        for i in range(0, len(texts), rows)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def encoded(df: DataFrame, path: str, text_column: str = "text") -> Column:
    """Ids of a text column as binary, four bytes an id, under the tokenizer file at ``path``.

    The same ids as the library's without added special tokens; special strings inside a text
    are one id each. NULL and empty texts give no id (empty binary). No shuffle.
    """
    content = _sent(df, path)

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        coder = _coder(content.value)
        return _in_slices(texts, lambda t: coder.encode(t or ""), pa.binary())

    return ids(F.col(text_column))


def decoded(df: DataFrame, path: str, ids_column: str = "ids") -> Column:
    """The text of ids as ``encoded`` packs them; special tokens are kept. NULL gives ''."""
    content = _sent(df, path)

    @F.arrow_udf("string")
    def text(packed: pa.Array) -> pa.Array:
        coder = _coder(content.value)
        return _in_slices(packed, lambda p: coder.decode(p or b""), pa.string())

    return text(F.col(ids_column))


def coded(df: DataFrame, path: str, text_column: str = "text") -> Column:
    """Both at once, as a struct of ``ids`` and of ``decoded``, the text that the ids give.
    One pass through one Python worker a task, where two columns would take two."""
    content = _sent(df, path)
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.string())])

    @F.arrow_udf("ids binary, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        coder = _coder(content.value)

        def work(text: str | None) -> dict:
            packed = coder.encode(text or "")
            return {"ids": packed, "decoded": coder.decode(packed)}

        return _in_slices(texts, work, kind)

    return both(F.col(text_column))


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")
