"""Near duplicates: consistent weighted samples of TF-IDF shingles, banded and verified."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.llm.components import components
from holdfast.llm.rows import whole_row
from holdfast.shipping import ship_package
from holdfast.workspace import materialize

_TABLE = words.byte_table(lower=True)
_VARIATES = 1 << 16
#: Bytes of text in a part of a band, and columns of shingles that are compared at a time.
_PART_BYTES = 8 << 20
_COLUMNS = 4096


@dataclass(frozen=True)
class NearSpec:
    """``shingle`` words make a shingle; texts of ``similarity`` or more are linked.

    ``samples`` consistent samples a text are combined to ``bands`` bands of ``rows`` each,
    a sample in several bands. ``buckets``: document frequencies are counted by hash in so many
    buckets. ``idf_weight``: how much heavier than the most frequent a shingle of frequency
    zero is. Pairs whose samples agree in less than ``agreement`` are not compared in full: a
    linked pair falls below with a chance of about 2 in 10,000. Members of a band meet in groups
    of about ``group``; each goes on with its ``partners`` closest at most, and with those that
    hold the group together.
    """

    shingle: int = 5
    similarity: float = 0.8
    samples: int = 48
    rows: int = 5
    bands: int = 27
    buckets: int = 1 << 16
    idf_weight: float = 0.25
    group: int = 400
    partners: int = 3
    agreement: float = 0.6
    seed: int = 11


@functools.lru_cache(maxsize=2)
def _variates(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of 1/r, beta and ln c - r (1 - beta), with r and c gamma (2, 1), beta uniform."""
    rng = np.random.RandomState(seed)
    r, c = rng.gamma(2, 1, _VARIATES), rng.gamma(2, 1, _VARIATES)
    beta = rng.uniform(0, 1, _VARIATES)
    return tuple(x.astype(np.float32) for x in (r, beta, np.log(c) - r * (1 - beta)))


@functools.lru_cache(maxsize=2)
def _sample_keys(spec: NearSpec) -> np.ndarray:
    rng = np.random.RandomState(spec.seed + 1)
    return rng.randint(1, 2**62, spec.samples).astype(np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=2)
def _band_rows(spec: NearSpec) -> np.ndarray:
    """Which samples make each band: shuffled rounds, so that all are used about as often."""
    rng = np.random.RandomState(spec.seed + 2)
    per_round = spec.samples // spec.rows
    rounds = -(-spec.bands // per_round)
    shuffled = [rng.permutation(spec.samples)[: per_round * spec.rows] for _ in range(rounds)]
    return np.concatenate(shuffled).reshape(-1, spec.rows)[: spec.bands]


def shingles(block: words.Block, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different shingles of each text, ordered by text: owner, hash, frequency.

    A text of fewer words than a shingle has one shingle of all its words.
    """
    count = np.diff(block.first)
    at, hashes = block.windows(n)
    owner = block.owner[at]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = words.span_hashes(block.hashes, block.first[short], block.first[short + 1])
        owner, hashes = np.append(owner, short), np.append(hashes, whole)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return owner[first], hashes[first], np.diff(first, append=len(owner))


def _bucket(hashes: np.ndarray, spec: NearSpec) -> np.ndarray:
    return (hashes % np.uint64(spec.buckets)).astype(np.int64)


def _frequencies(spec: NearSpec):
    """Documents with a shingle of each bucket, summed over a task; bucket -1: documents."""

    def run(batches):
        sums = np.zeros(spec.buckets, np.int64)
        documents = 0
        for batch in batches:
            documents += batch.num_rows
            for _, block in words.blocks(batch.column("body"), _TABLE):
                owner, hashes, _ = shingles(block, spec.shingle)
                seen = np.unique(owner * spec.buckets + _bucket(hashes, spec))
                sums += np.bincount(seen % spec.buckets, minlength=spec.buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(sums[at], documents))],
            names=["bucket", "n"],
        )

    return run


def idf_weights(texts: DataFrame, spec: NearSpec) -> np.ndarray:
    """Weight of each bucket of shingles: 1 for one in every document, up to 1 + idf_weight.

    Shingles that are rarer than what falls into their bucket by chance weigh alike. Counted over all rows of ``texts`` (body). The result has ``buckets`` entries whatever the
    number of documents, which is the bound of what is collected and broadcast. The scale is
    relative to the number of buckets, so it does not drift as the corpus grows.
    """
    counted = texts.mapInArrow(_frequencies(spec), "bucket bigint, n bigint")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    n = {r.bucket: r.n for r in rows}
    frequency = np.zeros(spec.buckets)
    for bucket, k in n.items():
        if bucket >= 0:
            frequency[bucket] = k
    idf = np.log((n.get(-1, 0) + 1) / (frequency + 1)) / np.log(spec.buckets)
    return (1 + spec.idf_weight * np.clip(idf, 0, 1)).astype(np.float32)


def signatures(block: words.Block, weights: np.ndarray, spec: NearSpec) -> np.ndarray:
    """Improved consistent weighted samples, one row of ``samples`` shingle hashes per text.

    For a shingle of weight w: t = floor(ln w / r + beta), ln a = ln c - r (t - beta + 1), and
    the smallest a is the sample. Two texts agree in a sample with the probability of their
    weighted Jaccard similarity. r, beta and c come from tables, indexed by the shingle.
    """
    owner, hashes, tf = shingles(block, spec.shingle)
    out = np.zeros((block.size, spec.samples), np.uint32)
    if not len(owner):
        return out
    r_of, beta_of, base_of = _variates(spec.seed)
    log_w = np.log(tf * weights[_bucket(hashes, spec)]).astype(np.float32)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    texts = owner[starts]
    low = hashes & np.uint64(0xFFFFFFFF)
    for j, key in enumerate(_sample_keys(spec)):
        at = ((hashes * key) >> np.uint64(48)).astype(np.int64)
        r = r_of[at]
        t = np.floor(log_w / r + beta_of[at])
        log_a = base_of[at] - r * t
        # Order-preserving bits of the number above, the shingle below: one minimum gives both.
        bits = log_a.view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000))
        packed = (bits.astype(np.uint64) << np.uint64(32)) | low
        out[texts, j] = np.minimum.reduceat(packed, starts).astype(np.uint32)
    return out


def _band_hashes(signature: np.ndarray, spec: NearSpec) -> np.ndarray:
    bands = np.zeros((len(signature), spec.bands), np.uint64)
    for i, rows in enumerate(_band_rows(spec)):
        h = np.full(len(signature), i + 1, np.uint64)
        for row in rows:
            h = words.mix(h ^ signature[:, row].astype(np.uint64))
        bands[:, i] = h
    return bands


def _signature_rows(weights: Broadcast, spec: NearSpec):
    def run(batches):
        for batch in batches:
            body = batch.column("body")
            parts = [signatures(b, weights.value, spec) for _, b in words.blocks(body, _TABLE)]
            if not parts:
                continue
            signature = np.concatenate(parts)
            bands = _band_hashes(signature, spec).view(np.int64)
            offsets = pa.array(np.arange(len(bands) + 1, dtype=np.int32) * spec.bands)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id0", "a", "b")),
                    pa.array([s.tobytes() for s in signature], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())),
                ],
                names=["id0", "a", "b", "signature", "bands"],
            )

    return run


def _spanning_pairs(agreement: np.ndarray, spec: NearSpec) -> set[tuple[int, int]]:
    """Pairs of a group: a spanning forest of greatest agreement, so that nothing that hangs
    together by ``spec.agreement`` falls apart, and the closest few partners of each member."""
    size = len(agreement)
    np.fill_diagonal(agreement, -1.0)
    pairs = set()
    best, toward = np.full(size, -1.0), np.zeros(size, np.int64)
    outside = np.ones(size, bool)
    for _ in range(size):
        new = int(np.where(outside, best, -2.0).argmax())
        if best[new] >= spec.agreement:
            pairs.add((new, int(toward[new])))
        outside[new] = False
        closer = agreement[new] > best
        best[closer], toward[closer] = agreement[new][closer], new
    k = min(spec.partners, size - 1)
    closest = np.argpartition(agreement, -k, axis=1)[:, -k:]
    for i, j in zip(np.repeat(np.arange(size), k).tolist(), closest.ravel().tolist()):
        if agreement[i, j] >= spec.agreement:
            pairs.add((i, j))
    return pairs


def _pairs_of_groups(ids: np.ndarray, signed: np.ndarray, starts: np.ndarray, spec: NearSpec):
    """Candidate pairs of ids within consecutive groups that begin at ``starts``."""
    sizes = np.diff(starts, append=len(ids))
    first = starts[sizes == 2]
    near = (signed[first] == signed[first + 1]).mean(1) >= spec.agreement
    left, right = [ids[first[near]]], [ids[first[near] + 1]]
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = signed[start : start + size]
        agreement = np.stack([(own == row).mean(1) for row in own])
        pairs = np.array(list(_spanning_pairs(agreement, spec)), np.int64).reshape(-1, 2) + start
        left.append(ids[pairs[:, 0]])
        right.append(ids[pairs[:, 1]])
    u, v = np.concatenate(left), np.concatenate(right)
    return np.minimum(u, v), np.maximum(u, v)


def _group_pairs(spec: NearSpec):
    """The task side of the search: rows come ordered by group; the last group of a batch waits
    for the next batch. Groups have a bounded size, see ``candidate_pairs``."""

    def pairs(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        signed = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32)
        ids = rows.column("id").to_numpy()
        u, v = _pairs_of_groups(ids, signed.reshape(len(ids), -1), starts, spec)
        different = u != v
        both = np.unique(np.column_stack([u[different], v[different]]), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"]
        )

    def run(batches):
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            if not rows.num_rows:
                continue
            keys = np.column_stack([rows.column(c).to_numpy() for c in ("band", "part")])
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(1)
            starts = np.flatnonzero(new)
            waiting = rows.slice(starts[-1])
            if len(starts) > 1:
                yield pairs(rows.slice(0, starts[-1]), starts[:-1])
        if waiting is not None:
            yield pairs(waiting, np.zeros(1, np.int64))

    return run


def _profile(text: str, weights: np.ndarray, spec: NearSpec):
    block = next(words.blocks(pa.array([text], pa.string()), _TABLE))[1]
    _, hashes, tf = shingles(block, spec.shingle)
    return hashes, tf, weights[_bucket(hashes, spec)].astype(float)


def similarity(left, right) -> float:
    """Weighted (TF-IDF) Jaccard similarity of two profiles; what the samples estimate."""
    common, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    shared = np.minimum(left[1][i], right[1][j]) * left[2][i]
    total = (left[1] * left[2]).sum() + (right[1] * right[2]).sum() - shared.sum()
    return float(shared.sum() / total)


def _verified(weights: Broadcast, spec: NearSpec):
    """Similarity of each pair of texts; pairs come sorted by the first text."""

    def run(batches):
        last, profile = None, None
        for batch in batches:
            out = []
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            for x, y in zip(left, right):
                if x != last:
                    last, profile = x, _profile(x, weights.value, spec)
                out.append(similarity(profile, _profile(y, weights.value, spec)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(out, pa.float64())],
                names=["u", "v", "similarity"],
            )

    return run


def candidate_pairs(held: DataFrame, signed: DataFrame, spec: NearSpec) -> DataFrame:
    """Pairs (u, v) that share a band and agree in enough samples.

    ``held`` has (band, n, id) with the number of members of the band, ``signed`` (id,
    signature). Within a band all members meet by
    their signatures, in memory, and pass on only pairs that hold them together and their
    closest partners: as many pairs as members, not as pairs of members. A band with more than
    ``group`` members is dealt out to parts of about that size by hash, differently in every
    band, so that no task gets more than others; members of different parts that no link joins
    meet in ``open_links``.
    """
    part = F.pmod(F.xxhash64("band", "id"), F.ceil(F.col("n") / spec.group)).alias("part")
    dealt = held.select("band", "id", part)
    return (
        dealt.join(signed, "id")
        .select("band", "part", "id", "signature")
        .repartition("band", "part")
        .sortWithinPartitions("band", "part", "id")
        .mapInArrow(_group_pairs(spec), "u bigint, v bigint")
        .distinct()
    )


def verified_links(
    pairs: DataFrame, texts: DataFrame, weights: Broadcast, spec: NearSpec
) -> DataFrame:
    """The pairs whose texts (id, body) are similar enough, with their similarity."""
    left = texts.select(F.col("id").alias("u"), F.col("body").alias("left"))
    right = texts.select(F.col("id").alias("v"), F.col("body").alias("right"))
    compared = (
        pairs.join(right, "v")
        .join(left, "u")
        .select("u", "v", "left", "right")
        .mapInArrow(_verified(weights, spec), "u bigint, v bigint, similarity double")
    )
    return compared.where(F.col("similarity") >= spec.similarity)


def _elements(profile) -> tuple[np.ndarray, np.ndarray]:
    """A profile as a set: a shingle of frequency n is n elements. Hash and weight."""
    hashes, tf, weight = profile
    at = np.repeat(np.arange(len(hashes)), tf)
    level = np.arange(len(at)) - np.repeat(np.cumsum(tf) - tf, tf)
    keys = np.where(level == 0, hashes[at], words.mix(hashes[at] ^ words.mix(level.astype(np.uint64))))
    return keys, weight[at]


def _close(profiles: list, left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which texts of ``left`` and ``right`` may be as similar as ``least``: products of matrices
    over shingles, a few columns at a time, in single precision."""
    parts = [_elements(p) for p in profiles]
    owner = np.repeat(np.arange(len(parts)), [len(k) for k, _ in parts])
    keys, weight = (np.concatenate(x) for x in zip(*parts))
    sums = np.array([w.sum() for _, w in parts])
    unique, column, held = np.unique(keys, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(held > 1)
    number = np.full(len(unique), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0) :]
    owner, column, weight = (x[order] for x in (owner, column, weight))
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(shared), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        m = np.zeros((len(parts), min(_COLUMNS, len(shared) - low)), np.float32)
        m[owner[a:b], column[a:b] - low] = np.sqrt(weight[a:b])
        common += m[left] @ m[right].T
    total = sums[left][:, None] + sums[right][None, :] - common
    # The margin is far above the rounding of the sums; the exact comparison follows.
    return common >= (least - 1e-3) * total


def _links_of_block(rows: dict, weights: np.ndarray, spec: NearSpec) -> list[tuple[int, int]]:
    """Links that join classes: all pairs of the two sides in different classes are compared on
    their texts, save those that links found before already join."""
    side = np.array(rows["side"])
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    group = np.array(rows["class"])
    if not len(left) or not len(right):
        return []
    profiles = [_profile(t, weights, spec) for t in rows["body"]]
    close = _close(profiles, left, right, spec.similarity)
    close &= group[left][:, None] != group[right][None, :]
    found, parent = [], {}

    def root(x):
        while x in parent:
            x = parent[x]
        return x

    for i, j in zip(*(at.tolist() for at in np.nonzero(close))):
        i, j = int(left[i]), int(right[j])
        x, y = root(int(group[i])), root(int(group[j]))
        if x != y and similarity(profiles[i], profiles[j]) >= spec.similarity:
            parent[x] = y
            found.append((rows["id"][i], rows["id"][j]))
    return found


def _block_links(weights: Broadcast, spec: NearSpec):
    """The task side of ``open_links``: rows come ordered by block; the last block of a batch
    waits for the next batch."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        found = _links_of_block(rows.to_pydict(), weights.value, spec)
        u, v = (pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_arrays([u, v], names=["u", "v"])

    def run(batches):
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            if not rows.num_rows:
                continue
            keys = np.column_stack([rows.column(c).to_numpy() for c in ("band", "x", "y")])
            starts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            starts = [0, *starts.tolist()]
            for start, end in zip(starts, starts[1:]):
                yield links(rows.slice(start, end - start))
            waiting = rows.slice(starts[-1])
        if waiting is not None:
            yield links(waiting)

    return run


def open_links(
    held: DataFrame,
    texts: DataFrame,
    classes: DataFrame,
    weights: Broadcast,
    spec: NearSpec,
) -> DataFrame:
    """Links (u, v) between texts that share a band and that ``classes`` (node, component) does
    not join yet.

    ``held`` is as in ``candidate_pairs``, ``texts`` (id, body). In bands of up to ``partners`` + 1
    all pairs were candidates. Every two members of a larger one meet here on their texts,
    unless they are in one class, so only what is connected already goes uncompared. The
    members outside a band's largest class meet each other and that class: both are dealt to
    parts of bounded number and bytes, and each two parts are a block of their own, so that no
    task holds more than two parts. Bands with the same members are one.
    """
    classes = classes.select(F.col("node").alias("id"), "component")
    labelled = held.where(F.col("n") > spec.partners + 1).select("band", "id").distinct()
    labelled = labelled.join(classes, "id", "left")
    labelled = labelled.select("band", "id", F.coalesce("component", "id").alias("class"))
    lengths = texts.groupBy("id").agg(F.sum(F.octet_length("body")).alias("bytes"))
    labelled = labelled.join(lengths, "id")
    code = F.xxhash64("id").cast("decimal(20,0)")
    counted = labelled.groupBy("band", "class").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("bytes"),
        F.sum(code).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("xor"),
    )
    top = F.max(F.struct("n", "class", "bytes")).alias("top")
    bands = counted.groupBy("band").agg(
        top,
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.sum("sum").alias("sum"),
        F.bit_xor("xor").alias("xor"),
    )
    bands = bands.where("n > top.n").groupBy("n", "sum", "xor").agg(
        F.min_by(F.struct("top", "bytes"), "band").alias("of"), F.min("band").alias("band")
    )

    def parts(n, size):
        return F.ceil(F.greatest(n / spec.group, size / F.lit(_PART_BYTES)))

    bands = bands.select(
        "band",
        F.col("of.top.class").alias("largest"),
        parts(F.col("n") - F.col("of.top.n"), F.col("of.bytes") - F.col("of.top.bytes")).alias("r"),
        parts(F.col("of.top.n"), F.col("of.top.bytes")).alias("s"),
    )
    rest = F.col("class") != F.col("largest")
    hashed = F.xxhash64("band", "id")
    own = F.when(rest, F.pmod(hashed, F.col("r"))).otherwise(F.col("r") + F.pmod(hashed, F.col("s")))
    others = F.sequence(F.lit(0).cast("bigint"), F.when(rest, F.col("r") + F.col("s")).otherwise(F.col("r")) - 1)
    blocks = (
        labelled.join(materialize(bands, "open"), "band")
        .select("band", "id", "class", own.alias("own"), F.explode(others).alias("other"))
        .select(
            "band",
            F.least("own", "other").alias("x"),
            F.greatest("own", "other").alias("y"),
            F.expr("CASE WHEN own < other THEN 0 WHEN own > other THEN 1 ELSE 2 END").alias("side"),
            "id",
            "class",
        )
    )
    return (
        blocks.join(texts.select("id", "body"), "id")
        .select("band", "x", "y", "side", "id", "class", "body")
        .repartition("band", "x", "y")
        .sortWithinPartitions("band", "x", "y")
        .mapInArrow(_block_links(weights, spec), "u bigint, v bigint")
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    spec: NearSpec | None = None,
) -> DataFrame:
    """One row per input row: id, a, b, class_id, class_size, n_texts, kept.

    class_id is the smallest id among the texts that links connect; class_size counts rows and
    n_texts different texts of the class. kept marks the row that stays, that with class_id.
    id, a and b identify a row, see ``keyed``.

    Texts are compared as words in lower case (ASCII and Latin-1) without regard to blanks. Copies of a text are one
    text before anything else happens. NULL counts as empty; empty texts form one class of
    their own; texts without five words are one shingle. Rows with the same id count as one
    document and share a class; a NULL id gets a stand-in from its text, which is negative. A
    long text is one block of a task, which holds its shingles' hashes.

    Two texts are linked if their weighted similarity reaches ``similarity``; a passage that one
    of them repeats counts as often as it stands there. Samples and bands find the candidates, so
    a link is missed with a small chance (about 1 in 1,000 at 0.8, less above). Of a group that hangs together by many links, enough are
    verified to hold it together; a pair is skipped only when it is connected already.
    """
    spec = spec or NearSpec()
    spark = docs.sparkSession
    ship_package(spark)
    rows = keyed(docs, id_column, text_column)
    weights = spark.sparkContext.broadcast(idf_weights(rows.select("body"), spec))
    members = rows.select("id0", "a", "b")
    texts = members.groupBy("a", "b").agg(F.min("id0").alias("lead"))
    texts = materialize(texts, "texts")

    with_words = F.length(F.btrim(F.col("body"), F.lit(words.BLANKS.decode()))) > 0
    signed = rows.where(with_words).select("id0", "a", "b", "body")
    signed = signed.mapInArrow(
        _signature_rows(weights, spec),
        "id0 bigint, a bigint, b bigint, signature binary, bands array<bigint>",
    )
    leads = texts.withColumnRenamed("lead", "id0")
    signed = materialize(signed.join(leads, ["a", "b", "id0"], "left_semi"), "signed")
    held = signed.select(F.col("id0").alias("id"), F.explode("bands").alias("band"))
    sizes = held.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = materialize(held.join(materialize(sizes, "sizes"), "band"), "held")
    candidates = held.select(F.col("id").alias("id0")).distinct()
    signed = signed.join(candidates, "id0", "left_semi")
    signed = materialize(signed.select(F.col("id0").alias("id"), "a", "b", "signature"), "signed")
    bodies = rows.select(F.col("id0").alias("id"), "a", "b", "body")
    bodies = bodies.join(signed.select("id", "a", "b"), ["id", "a", "b"], "left_semi")
    bodies = materialize(bodies.dropDuplicates(["id", "a", "b"]), "bodies")

    pairs = materialize(candidate_pairs(held, signed.select("id", "signature"), spec), "pairs")
    links = materialize(verified_links(pairs, bodies, weights, spec).select("u", "v"), "links")
    more = open_links(held, bodies, components(links), weights, spec)
    classes = components(links.union(more))

    placed = members.join(texts, ["a", "b"]).join(
        classes.select(F.col("node").alias("lead"), "component"), "lead", "left"
    )
    # Texts of one id belong together even where no link joins them.
    by_text = placed.select("id0", "a", "b", F.coalesce("component", "lead").alias("class"))
    split = by_text.groupBy("id0").agg(F.min("class").alias("class_id"))
    # Stored, as the sizes are, so that the join can split the rows of a very large class.
    result = materialize(by_text.drop("class").join(split, "id0"), "result")
    size = result.groupBy("class_id").agg(
        F.count(F.lit(1)).alias("class_size"),
        F.count_distinct("a", "b").alias("n_texts"),
    )
    return result.join(materialize(size, "size"), "class_id").select(
        F.col("id0").alias("id"),
        "a",
        "b",
        "class_id",
        "class_size",
        "n_texts",
        (F.col("id0") == F.col("class_id")).alias("kept"),
    )


def keyed(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """id0 (the id, or a stand-in for NULL), a and b (128 bits of the text), body, ``more``."""
    body = F.coalesce(text_column, F.lit(""))
    stand_in = F.xxhash64(body).bitwiseOR(F.lit(-(1 << 63)))
    return docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), stand_in).alias("id0"),
        F.xxhash64(body).alias("a"),
        F.xxhash64(F.lit(1), body).alias("b"),
        body.alias("body"),
        *more,
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    spec: NearSpec | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class; columns may have any name."""
    found = near_duplicates(docs, id_column, text_column, spec)
    stays = found.where("kept").select(F.col("id").alias("id0"), "a", "b").distinct()
    rows = keyed(docs, id_column, text_column, whole_row(docs))
    return rows.join(stays, ["id0", "a", "b"], "left_semi").select("row.*")
