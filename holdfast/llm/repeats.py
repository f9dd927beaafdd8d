"""Repeated passages: suffix trees of words, partitioned by prefixes of variable length.

A suffix is told by its anchor, the smallest-hashed run of ``ANCHOR`` words among its first
``window`` words, and by the anchor's place in them; suffixes that agree in their first
``window`` words agree in both. The anchor is the prefix that partitions: suffixes whose anchor
occurs once in the corpus are leaves of the root and are left out before any is sent. Suffixes
that share an anchor lie side by side in their text, so one row holds the words of all of them.

The rows of a prefix meet in one task, which grows their tree from the top: the suffixes of a
node are ordered by their next word, nodes split where words differ, and leaves are dropped.
Nodes that are left at a depth of ``window`` words have two or more suffixes: each is a repeat.
Trees end there, as what a deeper node covers is covered by the following suffixes as well.

A prefix with more than ``bound`` rows grows to the whole ``window`` words. Its groups are
single nodes at that depth, for which no words are held: they are counted by hash.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.shipping import ship_package
from holdfast.workspace import materialize

ANCHOR = 8
#: So many rows of one prefix may meet in a task, and so many may come from one batch.
BOUND, CROWD = 4096, 16
#: Rows of words that are handed on at once.
_SLICE = 1 << 13
_TABLE = words.byte_table()
_KEY = ["id0", "a", "b"]
#: Bits of a position in a block; the rest orders runs of words by hash.
_PLACE = np.uint64(30)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def suffixes(block: words.Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the suffixes that reach full depth, where the last words of the prefix of
    each begin, and the hashes of the runs of ``ANCHOR`` words at all places."""
    n = len(block.hashes)
    runs = np.zeros(n, np.uint64)
    at, hashes = block.windows(min(ANCHOR, window))
    runs[at] = hashes
    last = np.repeat(block.first[1:], np.diff(block.first)) - window
    starts = np.flatnonzero(np.arange(n) <= last)
    if not len(starts):
        return starts, starts, runs
    order = (runs >> _PLACE << _PLACE) | np.arange(n, dtype=np.uint64)
    lowest = _smallest(order, window - min(ANCHOR, window) + 1)[starts]
    place = lowest & np.uint64((1 << int(_PLACE)) - 1)
    return starts, place.astype(np.int64), runs


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _local_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each key occurs among ``keys``, and whether it is the first of its kind."""
    _, first, inverse, counts = np.unique(
        keys, return_index=True, return_inverse=True, return_counts=True
    )
    leads = np.zeros(len(keys), bool)
    leads[first] = True
    return counts[inverse], leads


def _merged(
    parts: list[dict[str, np.ndarray]], names: list[str], most: int, weight: int
) -> dict[str, pa.Array]:
    """Columns of one batch with ``weight`` and ``salt``.

    Of a key that occurs more than ``most`` times in the batch, one row goes on under the common
    key with ``weight``, the others under a key of their own batch. So however often a
    passage occurs, a batch adds few rows to its group. Input comes sorted, so that a task that
    runs again makes the same batches and the same rows.
    """
    whole = {n: np.concatenate([p[n] for p in parts]) for n in [*names, "id0", "version", "place"]}
    keys = whole[names[0]] if len(names) == 1 else words.mix(whole[names[0]]) ^ whole[names[1]]
    counts, leads = _local_counts(keys)
    own = int(whole["id0"][0]) | 1 if len(keys) else 1
    columns = {n: _signed(whole[n]) for n in names}
    columns |= {n: pa.array(whole[n]) for n in ("id0", "version", "place")}
    columns["weight"] = pa.array(np.where(counts > most, weight, 1))
    columns["salt"] = pa.array(np.where((counts > most) & ~leads, own, 0))
    return columns


_ANCHORS = "prefix bigint, id0 bigint, version bigint, place bigint, weight bigint, salt bigint"


def _anchor_rows(window: int, bound: int):
    def run(batches):
        for batch in batches:
            id0, version = np.asarray(batch.column("id0")), np.asarray(batch.column("version"))
            parts = []
            for row, block in words.blocks(batch.column("body"), _TABLE):
                _, place, runs = suffixes(block, window)
                place = np.unique(place)
                owner = block.owner[place]
                parts.append(
                    {
                        "prefix": runs[place],
                        "id0": id0[row + owner],
                        "version": version[row + owner],
                        "place": place - block.first[owner],
                    }
                )
            if parts:
                columns = _merged(parts, ["prefix"], min(CROWD, bound), bound + 1)
                yield pa.RecordBatch.from_pydict(columns)

    return run


_SUFFIXES = (
    "prefix bigint, path bigint, salt bigint, id0 bigint, version bigint, place bigint, "
    "weight bigint, suffixes bigint, anchor bigint, words array<bigint>"
)


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin at ``first``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(first - before, lengths)


def _bundles(block, starts, place, runs, id0, version, window: int):
    """Rows of side-by-side suffixes that share an anchor, with the words of all of them."""
    lead = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else place
    counts = np.diff(np.append(lead, len(place)))
    for low in range(0, len(lead), _SLICE):
        first, n = starts[lead[low : low + _SLICE]], counts[low : low + _SLICE]
        at, owner = place[lead[low : low + _SLICE]], block.owner[first]
        held = _ranges(first, n + window - 1)
        bounds = np.append(0, np.cumsum(n + window - 1)).astype(np.int32)
        nothing = pa.array(np.zeros(len(first), np.int64))
        yield pa.RecordBatch.from_pydict(
            {
                "prefix": _signed(runs[at]),
                "path": nothing,
                "salt": nothing,
                "id0": pa.array(id0[owner]),
                "version": pa.array(version[owner]),
                "place": pa.array(first - block.first[owner]),
                "weight": pa.array(np.ones(len(first), np.int64)),
                "suffixes": pa.array(n),
                "anchor": pa.array(at - first),
                "words": pa.ListArray.from_arrays(pa.array(bounds), _signed(block.hashes[held])),
            }
        )


def _suffix_rows(window: int):
    def run(batches):
        for batch in batches:
            id0, version = np.asarray(batch.column("id0")), np.asarray(batch.column("version"))
            marks = batch.column("marks")
            bounds, flat = np.asarray(marks.offsets), np.asarray(marks.values)
            parts = []
            for row, block in words.blocks(batch.column("body"), _TABLE):
                starts, place, runs = suffixes(block, window)
                shared = np.zeros(len(block.hashes), np.int8)
                own = np.diff(bounds[row : row + block.size + 1])
                mark = flat[bounds[row] : bounds[row + block.size]]
                shared[(mark >> 1) + np.repeat(block.first[:-1], own)] = 1 + (mark & 1)
                few, many = shared[place] == 1, shared[place] == 2
                texts = (id0[row : row + block.size], version[row : row + block.size])
                yield from _bundles(block, starts[few], place[few], runs, *texts, window)
                starts, place = starts[many], place[many]
                owner = block.owner[starts]
                parts.append(
                    {
                        "prefix": runs[place],
                        "path": words.span_hashes(block.hashes, starts, starts + window),
                        "id0": texts[0][owner],
                        "version": texts[1][owner],
                        "place": starts - block.first[owner],
                    }
                )
            if parts:
                columns = _merged(parts, ["prefix", "path"], 1, 2)
                n = len(columns["prefix"])
                columns["suffixes"] = pa.array(np.ones(n, np.int64))
                columns["anchor"] = pa.array(np.zeros(n, np.int64))
                columns["words"] = pa.nulls(n, pa.list_(pa.int64()))
                order = [c.split()[0] for c in _SUFFIXES.split(", ")]
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in order})

    return run


def deep_suffixes(
    codes: np.ndarray, at: np.ndarray, node: np.ndarray, depth: int
) -> np.ndarray:
    """Those of the suffixes of ``codes`` at ``at`` that lie below a node of depth ``depth``.

    The tree of the suffixes of each ``node`` is grown word by word. Only members of nodes that
    branch are sorted, and suffixes that are alone in their node are dropped.
    """
    leaf = np.argsort(node, kind="stable")
    opens = np.append(True, np.diff(node[leaf]) != 0)[: len(leaf)]
    for level in range(depth + 1):
        alone = opens & np.append(opens[1:], True)[: len(opens)]
        leaf, opens = leaf[~alone], opens[~alone]
        if level == depth or not len(leaf):
            break
        word = codes[at[leaf] + level]
        turns = np.append(False, word[1:] != word[:-1]) & ~opens
        if not turns.any():
            continue
        number = np.cumsum(opens) - 1
        branching = np.zeros(number[-1] + 1, bool)
        branching[number[turns]] = True
        members = np.flatnonzero(branching[number])
        order = members[np.lexsort((word[members], number[members]))]
        leaf[members], word[members] = leaf[order], word[order]
        opens |= np.append(True, word[1:] != word[:-1])
    return leaf


def _packed(place: np.ndarray, length: np.ndarray, window: int) -> np.ndarray:
    """Side-by-side suffixes as one number; there are at most ``window`` of them."""
    return place * window + length - 1


def _repeats(rows: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """Runs of repeated suffixes among ``rows``, which hold whole groups."""
    group = np.cumsum(_new_keys(rows))
    known = rows.column("words").is_valid().to_numpy(zero_copy_only=False)
    again = (np.bincount(group)[group] > 1) | (np.asarray(rows.column("weight")) > 1)
    counted = np.flatnonzero(again & ~known)
    place = np.asarray(rows.column("place"))
    found = [(counted, _packed(place[counted], np.ones(len(counted), np.int64), window))]
    trees = np.flatnonzero(known)
    if len(trees):
        n = np.asarray(rows.column("suffixes"))[trees]
        codes = np.asarray(rows.column("words").filter(pa.array(known)).flatten())
        first = np.cumsum(n + window - 1) - (n + window - 1)
        row = np.repeat(np.arange(len(trees)), n)
        step = _ranges(np.zeros(len(n), np.int64), n)
        anchor = np.asarray(rows.column("anchor"))[trees][row] - step
        node = group[trees][row] * window + anchor
        leaf = np.sort(deep_suffixes(codes, first[row] + step, node, window))
        if len(leaf):
            begins = np.append(True, (np.diff(leaf) > 1) | (np.diff(row[leaf]) > 0))
            begins = np.flatnonzero(begins)
            length = np.diff(np.append(begins, len(leaf)))
            lead = leaf[begins]
            own = trees[row[lead]]
            found.append((own, _packed(place[own] + step[lead], length, window)))
    own, run = (np.concatenate(x) for x in zip(*found))
    columns = {c: pa.array(np.asarray(rows.column(c))[own]) for c in ("id0", "version")}
    return pa.RecordBatch.from_pydict(columns | {"run": pa.array(run)})


def _new_keys(rows: pa.RecordBatch) -> np.ndarray:
    """Where a group begins in sorted rows."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("prefix", "path", "salt"):
        new[1:] |= np.diff(np.asarray(rows.column(name))) != 0
    return new


def _tree_rows(window: int):
    """Groups are whole before they are looked at; at most one group waits for its end."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            last = int(np.flatnonzero(_new_keys(rows))[-1])
            if last:
                yield _repeats(rows.slice(0, last), window)
            held = rows.slice(last)
            if held.num_rows > 1 and not held.column("words")[0].is_valid:
                # Two are enough to know that a counted node repeats; one stands for them.
                yield _repeats(held, window)
                held = held.slice(held.num_rows - 1)
        if held is not None:
            yield _repeats(held, window)

    return run


def _spans(runs: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal stretches of words that the suffixes of ``runs`` (sorted) cover."""
    if not len(runs):
        return []
    first = runs // window
    reach = np.maximum.accumulate(first + runs % window) + window
    gap = np.flatnonzero(first[1:] > reach[:-1])
    starts, ends = first[np.append(0, gap + 1)], reach[np.append(gap, len(runs) - 1)]
    return list(zip(starts.tolist(), ends.tolist()))


_RESULT = (
    "n_words bigint, n_removed bigint, kept string, spans array<struct<start:bigint,end:bigint>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(text: str, runs: list[int] | None, copies: int, window: int):
    found = text.encode().split()
    n = len(found)
    if copies > 1:
        spans = [(0, n)] if n >= window else []
    else:
        spans = _spans(np.unique(np.array(runs or [], np.int64)), window)
    keep = np.ones(n, bool)
    for start, end in spans:
        keep[start:end] = False
    kept = b" ".join(compress(found, keep.tolist())).decode()
    return n, int(n - keep.sum()), kept, [{"start": s, "end": e} for s, e in spans]


def _cut_rows(window: int):
    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("body", "runs", "copies"))
            n, removed, kept, spans = zip(
                *(_cut(text, runs, copies, window) for text, runs, copies in zip(*columns))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, _SPAN),
                ],
                names=["id", "n_words", "n_removed", "kept", "spans"],
            )

    return run


def _shared_places(anchors: DataFrame, bound: int) -> DataFrame:
    """Places per text of the anchors that occur twice or more; odd marks have too many."""
    same = Window.partitionBy("prefix", "salt")
    mark = F.col("place") * 2 + (F.col("total") > bound).cast("bigint")
    return (
        anchors.withColumn("total", F.sum("weight").over(same))
        .where("total > 1")
        .groupBy("id0", "version")
        .agg(F.collect_list(mark).alias("marks"))
    )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = 35,
    bound: int = BOUND,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept, spans.

    Removes each word covered by a run of ``window`` words that also begins anywhere else, the
    same text included; all runs are judged on the input. ``kept`` joins the other words by one
    space; ``spans`` are the maximal removed stretches as word numbers, the end exclusive.

    Copies of a text weigh one text and repeat each other wholly. A NULL text counts as empty.
    Repeated rows count as copies, and rows of one id with different texts as different
    documents. Texts shorter than ``window`` words lose nothing. Extra columns are not read.
    ``bound`` sets how many rows a tree may have and changes no result. A text of any length is
    split into words by one task, in about 40 bytes a word; its suffixes are sent on in slices.
    """
    ship_package(docs.sparkSession)
    body = F.coalesce(text_column, F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(id_column).cast("bigint"), F.xxhash64(body)).alias("id0"),
        F.xxhash64(body).alias("a"),
        F.xxhash64(F.lit(1), body).alias("b"),
        body.alias("body"),
    )
    texts = rows.groupBy("a", "b").agg(
        F.min("id0").alias("lead"), F.count(F.lit(1)).alias("copies")
    )
    # Stored, so that the join with its copies can split those of a very frequent text.
    texts = materialize(texts, "texts")
    # Texts of one id are told apart by number, which compresses better than a hash.
    number = F.row_number().over(Window.partitionBy("id0").orderBy("a", "b"))
    known = rows.select(*_KEY).distinct().withColumn("version", number.cast("bigint"))
    known = known.join(texts, ["a", "b"])

    def with_text(info: DataFrame, how: str = "inner") -> DataFrame:
        # One exchange of the texts serves all three passes; merging leaves them in order.
        return rows.join(info.hint("merge"), _KEY, how)

    leads = known.where("id0 = lead").select(*_KEY, "version")
    anchors = (
        with_text(leads)
        .select("id", *_KEY, "version", "body")
        .mapInArrow(_anchor_rows(window, bound), _ANCHORS)
    )
    places = _shared_places(anchors, bound).join(leads, ["id0", "version"])
    group = ["prefix", "path", "salt"]
    runs = (
        with_text(places)
        .select("id", *_KEY, "version", "body", "marks")
        .mapInArrow(_suffix_rows(window), _SUFFIXES)
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(_tree_rows(window), "id0 bigint, version bigint, run bigint")
        .groupBy("id0", "version")
        .agg(F.collect_list("run").alias("runs"))
    )
    info = known.join(runs, ["id0", "version"], "left").select(*_KEY, "copies", "runs")
    return (
        with_text(info)
        .select("id", *_KEY, "body", "copies", "runs")
        .mapInArrow(_cut_rows(window), f"id {rows.schema['id'].dataType.simpleString()}, {_RESULT}")
        .withColumnRenamed("id", id_column)
    )
