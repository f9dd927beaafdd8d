"""Benchmark decontamination: passages query a BM25 index of test items.

Every item is looked for in passages whose length follows from its own, so whether a document
holds it depends neither on other items nor on how items are dealt to indexes.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.llm.rows import whole_row
from holdfast.shipping import ship_package
from holdfast.workspace import materialize

_TABLE = words.byte_table(lower=True, punctuation=False)
LEAKS = (
    "array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double>>"
)


@dataclass(frozen=True)
class LeakSpec:
    """``threshold``: share of an item's own BM25 score that a passage must reach.
    ``overlap``: share of the three-word runs of the question, and of the answer, that the
    passage must hold. ``answer_share``: the last part of an item's words is its answer, if
    no question mark tells where the answer begins. ``passage_words``: passages are twice as
    long and one begins every so many words; for a longer item it is doubled until the item
    fits. ``shard_bytes``: largest part of the items' text that is searched in one pass over the
    documents. ``cells``: bounds of passages and blocks of items that are held at once.
    """

    threshold: float = 0.5
    overlap: float = 0.5
    answer_share: float = 0.25
    passage_words: int = 64
    k1: float = 1.2
    b: float = 0.75
    block_items: int = 2
    shard_bytes: int = 16 << 20
    cells: int = 1 << 21


def passage_words(n_words: int, spec: LeakSpec) -> int:
    """How many words lie between the passages that an item of ``n_words`` is looked for in."""
    step = spec.passage_words
    while step < n_words:
        step *= 2
    return step


@dataclass
class Runs:
    """The different runs of ``width`` words of a part of a text."""

    width: int
    hashes: np.ndarray

    @classmethod
    def of(cls, part: np.ndarray, width: int | None = None) -> Runs:
        """Runs of three words, or single words where there are fewer."""
        width = width or (3 if len(part) >= 3 else 1)
        at = np.arange(max(len(part) - width + 1, 0))
        return cls(width, np.unique(words.span_hashes(part, at, at + width)))

    def share_in(self, passage: np.ndarray) -> float:
        """Share of these runs that the passage holds; 1 for an empty part."""
        if not len(self.hashes):
            return 1.0
        return float(np.isin(self.hashes, Runs.of(passage, self.width).hashes).mean())


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Different keys of a sorted array, and the values beside each."""
    different, starts = np.unique(keys, return_index=True)
    return different.tolist(), np.split(values, starts[1:]) if len(keys) else []


class Index:
    """Items of one passage length: postings by term with impacts as shares of the item's own
    score, and their maxima over blocks of items. An impact sum of 1 means that all terms of
    the item occur."""

    def __init__(
        self,
        items: list[tuple[int, str]],
        df: dict[int, int],
        n: int,
        mean: float,
        spec: LeakSpec,
        step: int,
    ):
        self.spec, self.ids, self.step = spec, [i for i, _ in items], step
        texts = pa.array([t for _, t in items], pa.string())
        term, item, impact = [], [], []
        self.parts: list[tuple[Runs, Runs]] = []
        for row, block in words.blocks(texts, _TABLE):
            for i in range(block.size):
                h = block.hashes[block.first[i] : block.first[i + 1]]
                cut = self._answer_at(items[row + i][1], block, i)
                self.parts.append((Runs.of(h[:cut]), Runs.of(h[cut:])))
                t, tf = np.unique(h, return_counts=True)
                held = np.array([df[x] for x in t.tolist()])
                idf = np.log(1 + (n - held + 0.5) / (held + 0.5))
                norm = spec.k1 * (1 - spec.b + spec.b * len(h) / max(mean, 1e-9))
                own = idf * tf * (spec.k1 + 1) / (tf + norm)
                term.append(t)
                item.append(np.full(len(t), row + i))
                impact.append(own / own.sum() if len(t) else own)
        empty = np.zeros(0)
        term = np.concatenate([empty.astype(np.uint64), *term])
        item = np.concatenate([empty.astype(np.int64), *item])
        impact = np.concatenate([empty, *impact])
        order = np.lexsort((item, term))
        self.terms, starts = np.unique(term[order], return_index=True)
        self.item, self.impact = item[order], impact[order]
        self.bounds = np.append(starts, len(order))
        self._block_maxima()

    def _answer_at(self, text: str, block: words.Block, i: int) -> int:
        """How many words the question has: those up to the last question mark, if words
        follow, else all but the last ``answer_share``."""
        first, n = block.first[i], block.first[i + 1] - block.first[i]
        mark = block.bounds[i] + len(text[: text.rfind("?") + 1].encode())
        asked = int(np.searchsorted(block.starts, mark) - first)
        return asked if 0 < asked < n else math.ceil(n * (1 - self.spec.answer_share))

    def _block_maxima(self) -> None:
        size = max(self.spec.block_items, -(-len(self.ids) // 1024))
        self.block_size, self.n_blocks = size, -(-len(self.ids) // size)
        of_term = np.repeat(np.arange(len(self.terms)), np.diff(self.bounds))
        key = of_term * max(self.n_blocks, 1) + self.item // size
        keys, starts = np.unique(key, return_index=True)
        maxima = np.maximum.reduceat(self.impact, starts) if len(keys) else np.zeros(0)
        # An entry is a term in a block.
        self.entries, self.entry_bounds = keys, np.append(starts, len(self.item))
        terms_of = keys // max(self.n_blocks, 1)
        self.block_bounds = np.searchsorted(terms_of, np.arange(len(self.terms) + 1))
        self.block_of, self.block_max = keys % max(self.n_blocks, 1), maxima
        self.block_list, self.max_list = self.block_of.tolist(), maxima.tolist()
        # Terms in most blocks cost more than they tell: their sum bounds them for all passages.
        wide = np.diff(self.block_bounds) > self.n_blocks / 4
        self.wide = wide
        item_rest = np.bincount(self.item[wide[of_term]], self.impact[wide[of_term]], len(self.ids))
        padded = np.zeros(self.n_blocks * size)
        padded[: len(item_rest)] = item_rest
        self.rest = padded.reshape(self.n_blocks, size).max(1) if self.n_blocks else padded

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the term for each word, -1 for a word that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[place] == hashes, place, -1)

    def promising(
        self, cell: np.ndarray, term: np.ndarray, n_cells: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Cells and blocks: where a cell, with the cell after it, can reach the threshold.

        ``cell`` and ``term`` are different pairs, in order. The sum of block maxima bounds the
        score of every item of the block, so what is left out cannot reach the threshold. Bounds
        are made for some cells at a time, however long the text.
        """
        some = max(1, self.spec.cells // max(self.n_blocks, 1))
        found = []
        for first in range(0, n_cells, some):
            low, high = np.searchsorted(cell, [first, first + some + 1])
            here, own = self._bounded(cell[low:high] - first, term[low:high], some + 1)
            begins = here < min(some, n_cells - first)
            found.append((here[begins] + first, own[begins]))
        cells, blocks = zip(*found)
        return np.concatenate(cells), np.concatenate(blocks)

    def _bounded(
        self, cell: np.ndarray, term: np.ndarray, n_cells: int
    ) -> tuple[np.ndarray, np.ndarray]:
        narrow = ~self.wide[term]
        cell, term = cell[narrow], term[narrow]
        lengths = np.diff(self.block_bounds)[term]
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) + np.repeat(self.block_bounds[term] - first, lengths)
        key = np.repeat(cell, lengths) * self.n_blocks + self.block_of[place]
        bound = np.bincount(key, self.block_max[place], n_cells * self.n_blocks)
        bound = bound.reshape(n_cells, self.n_blocks).astype(float)
        bound[:-1] += bound[1:].copy()
        bound += self.rest
        return np.nonzero(bound >= self.spec.threshold - 1e-9)

    def _postings(self, terms: np.ndarray, blocks: np.ndarray) -> list[list]:
        """Per term a cursor, its items and impacts in ``blocks``, their maximum, and the
        maximum of each block; terms without any are left out."""
        out = []
        low = np.searchsorted(self.entries, terms * self.n_blocks + blocks[:1])
        high = np.searchsorted(self.entries, terms * self.n_blocks + blocks[-1:] + 1)
        wanted = set(blocks.tolist())
        for a, z in zip(low.tolist(), high.tolist()):
            hits = [e for e in range(a, z) if self.block_list[e] in wanted]
            if hits:
                maxima = {self.block_list[e]: self.max_list[e] for e in hits}
                items = [x for e in hits for x in self.items_of(e)]
                impacts = [x for e in hits for x in self.impacts_of(e)]
                out.append([0, items, impacts, max(maxima.values()), maxima])
        return out

    def items_of(self, entry: int) -> list[int]:
        return self.item[self.entry_bounds[entry] : self.entry_bounds[entry + 1]].tolist()

    def impacts_of(self, entry: int) -> list[float]:
        return self.impact[self.entry_bounds[entry] : self.entry_bounds[entry + 1]].tolist()

    def search(self, terms: np.ndarray, blocks: np.ndarray | None = None) -> list[tuple[int, float]]:
        """All items (of ``blocks``, in order) whose score reaches the threshold, by block-max
        WAND.

        Cursors stand in the postings of the terms, ordered by item. The pivot is the first
        item that the maxima of the lists before it allow; if the maxima of its block do not,
        the cursors jump to the next block.
        """
        goal, size = self.spec.threshold - 1e-9, self.block_size
        if blocks is None:
            blocks = np.arange(self.n_blocks)
        lists = self._postings(terms, blocks)
        found = []
        while True:
            lists = [x for x in lists if x[0] < len(x[1])]
            lists.sort(key=lambda x: x[1][x[0]])
            total, pivot = 0.0, None
            for x in lists:
                total += x[3]
                if total >= goal:
                    pivot = x[1][x[0]]
                    break
            if pivot is None:
                return found
            block = pivot // size
            before = [x for x in lists if x[1][x[0]] <= pivot]
            if sum(x[4].get(block, 0.0) for x in before) >= goal:
                target = pivot + 1
                if before[0][1][before[0][0]] == pivot:
                    score = sum(x[2][x[0]] for x in before)
                    if score >= goal:
                        found.append((pivot, score))
                else:
                    target = pivot
            else:
                later = [x[1][x[0]] for x in lists if x[1][x[0]] > pivot]
                target = min([(block + 1) * size, *later])
            for x in before:
                while x[0] < len(x[1]) and x[1][x[0]] < target:
                    x[0] += 1

    def leaks(self, block: words.Block) -> list[list[dict]]:
        """Per text the verified items, each with its best passage."""
        step = self.step
        best: list[dict[int, dict]] = [{} for _ in range(block.size)]
        if not len(block.hashes) or not len(self.terms):
            return [[] for _ in best]
        # Cells of ``step`` words; a passage is a cell and the next of the same text. A text
        # ends with an empty cell, so that no passage reaches into another text.
        n_cells = -(-np.diff(block.first) // step) + 1
        first_cell = np.cumsum(n_cells) - n_cells
        owner = block.owner
        cell = first_cell[owner] + (np.arange(len(owner)) - block.first[owner]) // step
        term = self.lookup(block.hashes)
        seen = np.unique(cell[term >= 0] * len(self.terms) + term[term >= 0])
        cell, term = seen // len(self.terms), seen % len(self.terms)
        cells, blocks = self.promising(cell, term, int(n_cells.sum()))
        for c, own in zip(*_grouped(cells, blocks)):
            text = int(np.searchsorted(first_cell, c, "right")) - 1
            low = block.first[text] + (c - first_cell[text]) * step
            passage = block.hashes[low : min(low + 2 * step, block.first[text + 1])]
            near, far = np.searchsorted(cell, [c, c + 2])
            for item, score in self.search(np.unique(term[near:far]), own):
                question, answer = (part.share_in(passage) for part in self.parts[item])
                leak = (min(question, answer), score)
                old = best[text].get(item)
                if leak[0] >= self.spec.overlap and (old is None or leak > old["rank"]):
                    best[text][item] = {
                        "item_id": self.ids[item],
                        "score": score,
                        "question_overlap": question,
                        "answer_overlap": answer,
                        "rank": leak,
                    }
        return [[found[i] for i in sorted(found)] for found in best]


def _item_terms(batches):
    """The different terms of each item, and its number of words."""
    for batch in batches:
        for _, block in words.blocks(batch.column("body"), _TABLE):
            seen = [
                np.unique(block.hashes[a:z]) for a, z in zip(block.first[:-1], block.first[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.diff(block.first)),
                    pa.array([s.view(np.int64) for s in seen], pa.list_(pa.int64())),
                ],
                names=["n_words", "terms"],
            )


def _indexes(
    rows: list[tuple[int, str]], df: dict[int, int], n: int, mean: float, spec: LeakSpec
) -> list[Index]:
    """An index for each length of passages that the items need."""
    sizes = [
        size
        for _, block in words.blocks(pa.array([t for _, t in rows], pa.string()), _TABLE)
        for size in np.diff(block.first).tolist()
    ]
    steps = [passage_words(size, spec) for size in sizes]
    return [
        Index([row for row, own in zip(rows, steps) if own == step], df, n, mean, spec, step)
        for step in sorted(set(steps))
    ]


def build(benchmark: DataFrame, spec: LeakSpec | None = None) -> list[Broadcast]:
    """Indexes of the items (item_id, text), in parts of at most ``shard_bytes`` of text or one
    item; statistics of terms are those of all items. Items with NULL id or without words are
    left out; of rows with the same id and text one is used. Each part is a pass over the
    documents."""
    spec = spec or LeakSpec()
    spark = benchmark.sparkSession
    ship_package(spark)
    items = benchmark.selectExpr("bigint(item_id) item_id", "coalesce(text, '') body")
    items = materialize(items.where("item_id IS NOT NULL").distinct(), "items")
    terms = items.select("body").mapInArrow(_item_terms, "n_words bigint, terms array<bigint>")
    terms = terms.where("n_words > 0")
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.avg("n_words").alias("mean")).first()
    df = terms.select(F.explode("terms").alias("term")).groupBy("term").count()
    text_bytes = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    fits = text_bytes <= spec.shard_bytes
    shards = 1 if fits else math.ceil(2 * text_bytes / spec.shard_bytes)
    out = []
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "body"), F.lit(shards)) == shard)
        own = part.select("body").mapInArrow(_item_terms, "n_words bigint, terms array<bigint>")
        used = own.select(F.explode("terms").alias("term")).distinct()
        counts = df.join(used, "term", "left_semi") if shards > 1 else df
        known = {r["term"] % (1 << 64): r["count"] for r in counts.collect()}
        rows = sorted((r.item_id, r.body) for r in part.collect())
        indexes = _indexes(rows, known, size.n, size.mean or 0.0, spec)
        out.append(spark.sparkContext.broadcast(indexes))
    return out


def _all_leaks(block: words.Block, indexes: list[Index]) -> list[list[dict]]:
    """Per text the leaks of all indexes, by item."""
    of_index = [index.leaks(block) for index in indexes]
    return [
        sorted((x for found in of_index for x in found[i]), key=lambda x: x["item_id"])
        for i in range(block.size)
    ]


def leaks(df: DataFrame, index: Broadcast, text_column: str = "text") -> Column:
    """The verified leaks of each text as an array of structs; none for NULL or empty texts.

    Every passage of the whole text queries the index; all items above the threshold are
    retrieved; those stay of which the passage holds enough of question and answer. An item is
    reported once a text, with its best passage. No shuffle. A long text is searched some
    passages at a time; a task holds its words' hashes.
    """
    ship_package(df.sparkSession)

    @F.arrow_udf(LEAKS)
    def found(texts: pa.Array) -> pa.Array:
        rows = [x for _, b in words.blocks(texts, _TABLE) for x in _all_leaks(b, index.value)]
        kind = pa.struct(
            [("item_id", pa.int64())]
            + [(n, pa.float64()) for n in ("score", "question_overlap", "answer_overlap")]
        )
        return pa.array(rows, pa.list_(kind))

    return found(F.coalesce(text_column, F.lit("")))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    spec: LeakSpec | None = None,
) -> DataFrame:
    """One row per input row and leaked item: id, item_id, score, question_overlap,
    answer_overlap. Repeated rows are reported again; a NULL id is reported as NULL."""
    body = docs.select(F.col(id_column), F.col(text_column).alias("body"))
    parts = [
        body.select(id_column, F.explode(leaks(body, index, "body")).alias("leak"))
        for index in build(benchmark, spec)
    ]
    return functools.reduce(DataFrame.unionAll, parts).select(id_column, "leak.*")


def drop_leaking(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", spec: LeakSpec | None = None
) -> DataFrame:
    """``docs`` without the rows that hold a leak; columns may have any name."""
    indexes = build(benchmark, spec)
    for i, index in enumerate(indexes):
        rows = docs.select(
            whole_row(docs), leaks(docs, index, text_column).alias("found")
        )
        docs = rows.where(F.size("found") == 0).select("row.*")
        if i + 1 < len(indexes):
            docs = materialize(docs, "clean")
    return docs
