"""Exact search for the highest inner products by two cover trees that are walked together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm import vectors
from holdfast.shipping import ship_package
from holdfast.workspace import materialize

_NONE = -int(np.iinfo(np.int64).max)  # has a negative, unlike the least integer
_LAST = int(np.iinfo(np.int64).max)


@dataclass(frozen=True)
class SearchSpec:
    """``k`` results a query, over components that are multiplied by ``scale`` and floored.
    ``cells``: points that a net over ``sample`` rows chooses; they are the highest level of
    both trees. The rows of a cell make trees of about ``group`` rows, ``queries`` queries at a
    time make one. A node of ``leaf`` points is not split; others have ``children`` children, or
    as many as cover the points within the node's radius divided by ``base``."""

    k: int = 10
    scale: int = 1024
    cells: int = 64
    sample: int = 4096
    group: int = 8192
    queries: int = 256
    leaf: int = 48
    children: int = 32
    base: float = 2.0


def _distance(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    apart = points - center
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def net(points: np.ndarray, start: int, radius: float, most: int):
    """Points chosen farthest first, from ``start`` on, until all are within ``radius`` of one
    or ``most`` are chosen. So the chosen stand at least as far apart as any point stands from
    the nearest of them. Returns the chosen, and each point's nearest and distance from it."""
    chosen = [start]
    far = _distance(points, points[start])
    nearest = np.zeros(len(points), np.int64)
    while len(chosen) < most:
        new = int(far.argmax())
        if far[new] <= radius:
            break
        distance = _distance(points, points[new])
        closer = distance < far
        far[closer], nearest[closer] = distance[closer], len(chosen)
        chosen.append(new)
    return chosen, nearest, far


class CoverTree:
    """Nodes with a center among their points and the radius that covers all points below.

    The children of a node are a net of its points, the first of them at the node's own center.
    Points are ordered (``order``) so that those of a node lie together.
    """

    def __init__(self, points: np.ndarray, spec: SearchSpec):
        places = points.astype(float)
        self.order = np.arange(len(points))
        nodes = [(0, float(_distance(places, places[0]).max()), 0, len(points))]
        below = []
        while len(below) < len(nodes):
            children = self._split(places, *nodes[len(below)], spec)
            below.append((len(nodes), len(nodes) + len(children)))
            nodes += children
        center, radius, low, high = zip(*nodes)
        self.points = points[self.order]
        self.center, self.radius = places[list(center)], np.array(radius)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.center, self.center))
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.last = np.array(below).T
        self.is_leaf = self.first == self.last

    def _split(self, places, center: int, radius: float, low: int, high: int, spec) -> list:
        if high - low <= spec.leaf or radius == 0:
            return []
        own = self.order[low:high].copy()
        start = int(np.flatnonzero(own == center)[0])
        chosen, nearest, far = net(places[own], start, radius / spec.base, spec.children)
        by = np.argsort(nearest, kind="stable")
        self.order[low:high] = own[by]
        bounds = np.searchsorted(nearest[by], np.arange(len(chosen) + 1))
        widest = np.maximum.reduceat(far[by], bounds[:-1])
        return [
            (int(own[c]), float(r), low + int(a), low + int(z))
            for c, r, a, z in zip(chosen, widest, bounds, bounds[1:])
        ]

    @property
    def longest(self) -> float:
        return float((self.norm + self.radius).max())


def bound(inner, norm_a, radius_a, norm_b, radius_b):
    """No two points within the radii of two centers have a greater inner product than this. The
    margin is far above the rounding of the sums."""
    most = inner + norm_a * radius_b + norm_b * radius_a + radius_a * radius_b
    return most + 1e-9 * (norm_a + radius_a) * (norm_b + radius_b) + 1e-6


class Found:
    """The first ``k`` rows so far of each query, and the least score that still counts."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        self.score = np.full((len(least), k), _NONE)
        self.name = np.full((len(least), k), _LAST)

    def add(self, query: slice, score: np.ndarray, names: np.ndarray, own: np.ndarray) -> None:
        """Scores (query, row); ``own`` marks rows that do not count."""
        wanted = (score >= self.least[query, None]) & ~own
        rows, columns = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
        if not len(rows):
            return
        at, wanted = rows + query.start, wanted[np.ix_(rows, columns)]
        score = np.where(wanted, score[np.ix_(rows, columns)], _NONE)
        score = np.concatenate([self.score[at], score], axis=1)
        name = np.concatenate([self.name[at], np.where(wanted, names[columns], _LAST)], axis=1)
        order = np.lexsort((name, -score), axis=1)[:, : self.k]
        self.score[at] = np.take_along_axis(score, order, 1)
        self.name[at] = np.take_along_axis(name, order, 1)
        self.least[at] = np.maximum(self.least[at], self.score[at, -1])


def walk(queries: CoverTree, rows: CoverTree, query_ids, row_ids, found: Found) -> int:
    """Walks both trees, level by level. A pair of nodes is left out if its bound is below the
    worst score that the queries of its node still need; pairs of leaves are scored, the most
    promising first. Returns the number of scores.

    ids and ``found`` are in the order of the trees.
    """
    left, right, scored = queries.points, rows.points, 0
    if queries.longest * rows.longest < 2**53:  # sums of doubles are exact
        left, right = left.astype(float), right.astype(float)
    q, r = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(q):
        inner = np.einsum("ij,ij->i", queries.center[q], rows.center[r])
        top = bound(inner, queries.norm[q], queries.radius[q], rows.norm[r], rows.radius[r])
        nodes, of = np.unique(q, return_inverse=True)
        worst = np.array([found.least[queries.low[x] : queries.high[x]].min() for x in nodes])
        stays = top >= worst[of]
        q, r, top = q[stays], r[stays], top[stays]
        ends = np.flatnonzero(queries.is_leaf[q] & rows.is_leaf[r])
        for i in ends[np.argsort(-top[ends], kind="stable")].tolist():
            some = slice(int(queries.low[q[i]]), int(queries.high[q[i]]))
            own = slice(int(rows.low[r[i]]), int(rows.high[r[i]]))
            if top[i] >= found.least[some].min():
                score = (left[some] @ right[own].T).astype(np.int64)
                found.add(some, score, row_ids[own], query_ids[some, None] == row_ids[own])
                scored += score.size
        inside = ~(queries.is_leaf[q] & rows.is_leaf[r])
        q, r = _below(queries, rows, q[inside], r[inside])
    return scored


def _below(queries: CoverTree, rows: CoverTree, q: np.ndarray, r: np.ndarray):
    """Both nodes of each pair give way to their children; a leaf stays."""

    def parts(tree, nodes):
        leaf = tree.is_leaf[nodes]
        return np.where(leaf, nodes, tree.first[nodes]), np.where(
            leaf, 1, tree.last[nodes] - tree.first[nodes]
        )

    (q, n_q), (r, n_r) = parts(queries, q), parts(rows, r)
    n = n_q * n_r
    pair = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
    return q[pair] + at // n_r[pair], r[pair] + at % n_r[pair]


def _cells(pivots: Broadcast, width: int):
    """The nearest pivot of each row, and how far it is."""

    def run(batches):
        centers = pivots.value
        half = np.einsum("ij,ij->i", centers, centers) / 2
        for batch in batches:
            points = vectors.matrix(batch.column("v"), width).astype(float)
            cell = (points @ centers.T - half).argmax(1)
            far = _distance(points, centers[cell])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(far)],
                names=[*batch.schema.names, "cell", "far"],
            )

    return run


def _walks(width: int, spec: SearchSpec):
    """Rows come ordered by group: first its rows, which make a tree, then the queries, some of
    which make a tree at a time."""

    def answers(tree: CoverTree, names: np.ndarray, rows: pa.Table):
        for at in range(0, rows.num_rows, spec.queries):
            some = rows.slice(at, spec.queries)
            asked = CoverTree(_points(some, width), spec)
            some = some.take(pa.array(asked.order))
            found = Found(some.column("least").to_numpy(), spec.k)
            ids = some.column("vec_id").to_numpy()
            walk(asked, tree, ids, names, found)
            query, place = np.nonzero(found.score > _NONE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some.column("row").to_numpy()[query]),
                    pa.array(ids[query]),
                    pa.array(found.name[query, place]),
                    pa.array(found.score[query, place]),
                ],
                names=["row", "query_id", "vec_id", "score"],
            )

    def run(batches):
        group, waiting, tree, names = None, [], None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for own, asks, rows in vectors.stretches(table, "group", "asks"):
                if own != group:
                    group, waiting, tree = own, [], None
                if not asks:
                    waiting.append(rows)
                    continue
                if waiting:
                    held, waiting = pa.concat_tables(waiting), []
                    tree = CoverTree(_points(held, width), spec)
                    names = held.column("vec_id").to_numpy()[tree.order]
                if tree is not None:
                    yield from answers(tree, names, rows)

    return run


def _points(rows: pa.Table, width: int) -> np.ndarray:
    return vectors.matrix(rows.column("v").combine_chunks(), width)


def _asked(rows: DataFrame, queries: DataFrame, groups: int, width: int, spec: SearchSpec):
    """(row, query_id, vec_id, score): the first rows of each group for each query sent there."""
    both = rows.select("group", F.lit(False).alias("asks"), "cell", "row", "vec_id", "v")
    both = both.withColumn("least", F.lit(_NONE)).unionByName(
        queries.select("group", F.lit(True).alias("asks"), "cell", "row", "vec_id", "v", "least")
    )
    dealt = both.repartitionById(groups, F.col("group").cast("int"))
    return dealt.sortWithinPartitions("group", "asks", "cell").mapInArrow(
        _walks(width, spec), "row bigint, query_id bigint, vec_id bigint, score bigint"
    )


def _first(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def _promising(pivots: Broadcast, cells: dict[int, tuple[float, float]]):
    """For each group of rows the cells of queries that it may have results for. ``cells`` has
    the radius of each cell's queries and the worst score that they need."""

    def run(batches):
        centers = pivots.value
        norm = np.sqrt(np.einsum("ij,ij->i", centers, centers))
        asking = np.array(sorted(cells), np.int64)
        radius, worst = np.array([cells[c] for c in sorted(cells)]).reshape(-1, 2).T
        for batch in batches:
            cell, far = (batch.column(c).to_numpy() for c in ("cell", "far"))
            inner = centers[cell] @ centers[asking].T
            top = bound(inner, norm[cell][:, None], far[:, None], norm[asking], radius)
            group, query = np.nonzero(top >= worst)
            yield pa.RecordBatch.from_arrays(
                [batch.column("group").take(pa.array(group)), pa.array(asking[query])],
                names=["group", "cell"],
            )

    return run


def top_k(
    rows: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    spec: SearchSpec | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of the highest inner products per query.

    Queries (``is_query``) and rows are indexed together: a net over a sample gives at most
    ``cells`` points, every row and query belongs to the nearest, and the groups of a cell's
    rows make cover trees. A query first walks one tree of its own cell; the scores it finds
    there bound what it needs. Then it goes to every other group that its cell's worst score
    does not exclude, where trees of queries and rows are walked together. The sample decides
    how much is pruned, never what is found. What the driver sees is the sample and one row per
    cell.

    Scores are exact up to 64 bits; missing components of a shorter vector count as 0. Rows with
    a NULL id or vector, or a NULL or non-finite component, take no part. Each row stands for
    itself: copies are found each, a repeated query has its results again, and rows with the
    query's own id are never among them. Ties go to the smaller id.
    """
    spec = spec or SearchSpec()
    spark = rows.sparkSession
    ship_package(spark)
    named = rows.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(f"`{vector_column}`").alias("raw"),
    )
    used = named.where(F.col("vec_id").isNotNull() & vectors.usable(F.col("raw"))).select(
        "vec_id",
        "asks",
        vectors.floored(F.col("raw"), spec.scale).alias("v"),
        F.monotonically_increasing_id().alias("row"),
    )
    used = materialize(used, "vectors")
    _, width, _ = vectors.extent(used)
    sample = used.orderBy(F.xxhash64("row"), "row").limit(spec.sample).select("v").toArrow()
    points = vectors.matrix(sample.column("v").combine_chunks(), width).astype(float)
    chosen = net(points, 0, 0.0, spec.cells)[0] if len(points) else []
    pivots = spark.sparkContext.broadcast(points[chosen])
    placed = used.mapInArrow(
        _cells(pivots, width),
        "vec_id bigint, asks boolean, v array<bigint>, row bigint, cell bigint, far double",
    )
    placed = materialize(placed, "placed")

    sizes = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}
    parts = [-(-sizes.get(c, 0) // spec.group) or 1 for c in range(max(len(chosen), 1))]
    before = np.cumsum([0, *parts]).tolist()
    cell = (F.col("cell") + 1).cast("int")
    of_cell = lambda numbers: F.element_at(F.array(*map(F.lit, numbers)), cell).cast("bigint")
    part = F.pmod(F.xxhash64("row"), of_cell(parts))
    grouped = placed.withColumn("group", of_cell(before[:-1]) + part)
    own = placed.where("asks").withColumn("group", of_cell(before[:-1]))

    first_groups = grouped.where(F.col("group") == of_cell(before[:-1]))
    seeds = _asked(first_groups, own.withColumn("least", F.lit(_NONE)), before[-1], width, spec)
    seeds = materialize(seeds, "seeds")
    least = F.when(F.count(F.lit(1)) >= spec.k, F.min("score")).otherwise(F.lit(_NONE))
    known = seeds.groupBy("row").agg(least.alias("least"))
    asking = own.drop("group").join(known, "row", "left")
    asking = materialize(asking.fillna({"least": _NONE}), "asking")

    per_cell = asking.groupBy("cell").agg(F.max("far"), F.min("least")).collect()
    cells = {r[0]: (r[1], float(r[2])) for r in per_cell}
    groups = grouped.groupBy("group", "cell").agg(F.max("far").alias("far"))
    wanted = groups.mapInArrow(_promising(pivots, cells), "group bigint, cell bigint")
    seen = F.col("group") == of_cell(before[:-1])
    sent = asking.join(materialize(wanted.where(~seen), "wanted"), "cell")
    more = _asked(grouped, sent, before[-1], width, spec)
    return _first(seeds.unionAll(more), spec.k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
