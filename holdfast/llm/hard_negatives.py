"""Hard negatives by exact scores from tables of subset sums (the method of Four Russians)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm import vectors
from holdfast.shipping import ship_package
from holdfast.workspace import materialize

_ROWS = 1024  # candidates whose scores are held at once
_MASKS = (np.arange(256)[None, :] >> np.arange(8)[:, None]) & 1


@dataclass(frozen=True)
class MiningSpec:
    """``positives``: first rows of an anchor's label. ``negatives``: first rows of other labels
    per positive, of scores from ``low`` to ``high`` percent of the positive's score.
    ``scale``: components are multiplied by it and floored. ``group``: candidates that a task
    holds at once; ``anchors``: anchors that are scored at once."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    group: int = 4096
    anchors: int = 64


def bit_planes(matrix: np.ndarray, planes: int) -> np.ndarray:
    """Bytes (row, plane, group of eight dimensions): bit j of a byte is a bit of dimension j of
    its group, in two's complement."""
    bits = (matrix[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Per group of eight dimensions and byte, the sum of each anchor's components whose bits
    are set: (group, 256, anchor)."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((len(anchors), groups * 8), np.int64)
    padded[:, : anchors.shape[1]] = anchors
    return np.einsum("agj,jm->gma", padded.reshape(len(anchors), groups, 8), _MASKS)


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products (candidate, anchor): per plane, from the highest, the sums so far are
    doubled and the groups' entries added; the highest plane, the sign, counts negative.

    64 bits suffice unless the product itself needs more; then its low 64 bits are meant.
    """
    out = np.zeros((len(planes), tables.shape[2]), tables.dtype)
    for plane in range(planes.shape[1] - 1, -1, -1):
        out <<= 1
        for group, table in enumerate(tables):
            out += table.take(planes[:, plane, group], axis=0)
        if plane == planes.shape[1] - 1:
            np.negative(out, out=out)
    return out


def _narrow(tables: np.ndarray, planes: int) -> np.ndarray:
    """The tables in 32 bits, where no sum can exceed them."""
    most = np.abs(tables).max(1).sum(0).max(initial=0)
    return tables.astype(np.int32) if planes < 32 and int(most) << planes < 1 << 31 else tables


class Candidates:
    """The candidates of one group, ordered by label."""

    def __init__(self, rows: pa.Table, planes: int, width: int):
        label, name = (rows.column(c).to_numpy() for c in ("label", "vec_id"))
        order = np.lexsort((name, label))
        packed = np.frombuffer(b"".join(rows.column("planes").to_pylist()), np.uint8)
        packed = packed.reshape(len(label), planes, -(-width // 8))
        self.name, self.label, self.packed = name[order], label[order], packed[order]

    def scored(self, anchors: np.ndarray, label: int, same: bool):
        """Names and scores (candidate, anchor) of the candidates of a label, or of all others,
        some candidates at a time."""
        tables = _narrow(subset_sums(anchors), self.packed.shape[1])
        low, high = np.searchsorted(self.label, [label, label + 1]).tolist()
        for start, end in [(low, high)] if same else [(0, low), (high, len(self.name))]:
            for a in range(start, end, _ROWS):
                z = min(a + _ROWS, end)
                yield self.name[a:z], scores(tables, self.packed[a:z]).astype(np.int64)


class Best:
    """The first ``k`` candidates so far of each of ``n`` columns of scores."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.column, self.score, self.name = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)

    def add(self, names: np.ndarray, score: np.ndarray, allowed: np.ndarray) -> None:
        """Scores (candidate, column); of equal scores smaller names come first."""
        allowed = allowed & (score >= self.least)
        if len(names) > self.k and np.count_nonzero(allowed) > 4 * self.k * score.shape[1]:
            known = np.where(allowed, score, np.iinfo(np.int64).min)
            kth = len(names) - self.k
            allowed &= score >= np.partition(known, kth, axis=0)[kth]
        at, column = np.nonzero(allowed)
        self.column = np.append(self.column, column)
        self.score = np.append(self.score, score[at, column])
        self.name = np.append(self.name, names[at])
        stay = vectors.best(self.column, self.score, self.name, self.k)
        self.column, self.score, self.name = self.column[stay], self.score[stay], self.name[stay]
        full = np.flatnonzero(np.bincount(self.column, minlength=len(self.least)) == self.k)
        self.least[full] = self.score[np.searchsorted(self.column, full, "right") - 1]


def _positives(held: Candidates, rows: pa.Table, matrix: np.ndarray, label: int, spec: MiningSpec):
    """The first rows of the anchors' label; their slot is 0."""
    own = rows.column("vec_id").to_numpy()
    found = Best(len(own), spec.positives)
    for name, score in held.scored(matrix, label, True):
        found.add(name, score, name[:, None] != own)
    return found.column, np.zeros(len(found.column), np.int64), found.name, found.score


def _negatives(held: Candidates, rows: pa.Table, matrix: np.ndarray, label: int, spec: MiningSpec):
    """For each anchor and positive (slot) the first rows of other labels within the bounds."""
    own = rows.column("vec_id").to_numpy()
    goals = rows.column("goals").combine_chunks()
    anchor = np.repeat(np.arange(len(own)), np.diff(goals.offsets.to_numpy()))
    slot = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
    goal = goals.flatten().to_numpy()
    # low * goal <= 100 * score <= high * goal, as bounds of the score.
    low, high = -((-spec.low * goal) // 100), (spec.high * goal) // 100
    found = Best(len(goal), spec.negatives)
    for name, score in held.scored(matrix, label, False):
        score = score[:, anchor]
        other = (name[:, None] != own)[:, anchor]
        found.add(name, score, other & (score >= low) & (score <= high))
    return anchor[found.column], slot[found.column], found.name, found.score


def _pack(width: int, planes: int):
    def run(batches):
        for batch in batches:
            packed = bit_planes(vectors.matrix(batch.column("v"), width), planes)
            names = ["vec_id", "label", "part"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array([row.tobytes() for row in packed], pa.binary()),
                ],
                names=[*names, "planes"],
            )

    return run


def _search(find, width: int, planes: int, spec: MiningSpec):
    """Rows come ordered by part: first its candidates, which are held, then the anchors, which
    pass by some at a time."""

    def answers(held: Candidates, rows: pa.Table):
        labels = rows.column("label").to_numpy()
        for label in np.unique(labels).tolist():
            of_label = rows.filter(pa.array(labels == label))
            for at in range(0, of_label.num_rows, spec.anchors):
                some = of_label.slice(at, spec.anchors)
                matrix = vectors.matrix(some.column("v").combine_chunks(), width)
                column, slot, name, score = find(held, some, matrix, label, spec)
                anchor = some.column("anchor").to_numpy()[column]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor, slot, name, score)],
                    names=["anchor", "slot", "name", "score"],
                )

    def run(batches):
        part, waiting, held = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for own, is_anchor, rows in vectors.stretches(table, "part", "asks"):
                if own != part:
                    part, waiting, held = own, [], None
                if not is_anchor:
                    waiting.append(rows)
                    continue
                if waiting:
                    held, waiting = Candidates(pa.concat_tables(waiting), planes, width), []
                if held is not None:
                    yield from answers(held, rows)

    return run


def _asked(
    candidates: DataFrame,
    anchors: DataFrame,
    find,
    parts: int,
    width: int,
    planes: int,
    spec: MiningSpec,
) -> DataFrame:
    """Every anchor against every part of the candidates: (anchor, slot, name, score), the first
    of each part."""
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    rows = candidates.withColumn("asks", F.lit(False)).unionByName(
        anchors.withColumn("part", F.explode(numbers)).withColumn("asks", F.lit(True)),
        allowMissingColumns=True,
    )
    dealt = rows.repartitionById(parts, F.col("part").cast("int"))
    return dealt.sortWithinPartitions("part", "asks").mapInArrow(
        _search(find, width, planes, spec),
        "anchor bigint, slot bigint, name bigint, score bigint"
    )


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot over all parts, with their rank."""
    own = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "name")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    spec: MiningSpec | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of the floored vectors, exact up to 64 bits; missing
    components of a shorter vector count as 0. Anchors are the rows where ``is_anchor``. All
    rows are candidates, in parts of about ``group`` rows; each anchor goes to each part, and
    the first of each part meet in a window per anchor. Nothing goes through the driver.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part.
    Each row stands for itself: copies are candidates of their own, and a repeated anchor has
    its results again. Rows with an anchor's own id are never its positives or negatives. An
    anchor without positives, or a positive without negatives, has no rows.
    """
    spec = spec or MiningSpec()
    ship_package(rows.sparkSession)
    vector = F.col(f"`{vector_column}`")
    named = rows.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"),
        label.cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        vector.alias("raw"),
    )
    used = named.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.usable(F.col("raw"))
    )
    used = used.select(
        "vec_id",
        "label",
        "asks",
        vectors.floored(F.col("raw"), spec.scale).alias("v"),
        F.monotonically_increasing_id().alias("anchor"),
    )
    used = materialize(used, "vectors")
    n, width, most = vectors.extent(used)
    planes, parts = most.bit_length() + 1, max(1, -(-n // spec.group))
    part = F.pmod(F.xxhash64("anchor"), F.lit(parts).cast("bigint")).alias("part")
    candidates = used.select("vec_id", "label", part, "v").mapInArrow(
        _pack(width, planes), "vec_id bigint, label bigint, part bigint, planes binary"
    )
    candidates = materialize(candidates, "candidates")
    anchors = used.where("asks").select("anchor", "vec_id", "label", "v")

    sizes = {"parts": parts, "width": width, "planes": planes, "spec": spec}
    found = _asked(candidates, anchors, _positives, **sizes)
    goals = _first(found, spec.positives).groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "name", "score"))).alias("goal")
    )
    anchors = anchors.join(goals, "anchor").select(
        "*", F.col("goal.name").alias("positives"), F.col("goal.score").alias("goals")
    )
    anchors = materialize(anchors.drop("goal"), "anchors")
    asking = anchors.drop("positives")
    found = _asked(candidates, asking, _negatives, **sizes)
    at = (F.col("slot") + 1).cast("int")
    return (
        _first(found, spec.negatives)
        .join(anchors.select("anchor", "vec_id", "positives", "goals"), "anchor")
        .select(
            F.col("vec_id").alias("anchor_id"),
            F.element_at("positives", at).alias("positive_id"),
            F.col("rank").cast("int").alias("rank"),
            F.col("name").alias("negative_id"),
            F.element_at("goals", at).alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
