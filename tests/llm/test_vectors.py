"""Searches over vectors against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import hard_negatives, queries, topk, vectors
from holdfast.llm.hard_negatives import MiningSpec
from holdfast.llm.topk import SearchSpec

SCHEMA = "vec_id bigint, label int, embedding array<double>"
NAN, INF = math.nan, math.inf


def usable(row, scale):
    vec_id, label, v = row
    if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return vec_id, label, [math.floor(scale * x) for x in v]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_negatives(rows, spec, every=4):
    used = [u for r in rows if r[1] is not None and (u := usable(r, spec.scale))]
    out = []
    for a in (r for r in used if r[0] % every == 0):
        others = [(-inner(a[2], b[2]), b[0], b[1]) for b in used if b[0] != a[0]]
        others.sort()
        for goal, positive, _ in [x for x in others if x[2] == a[1]][: spec.positives]:
            within = [
                x for x in others
                if x[2] != a[1] and spec.low * -goal <= 100 * -x[0] <= spec.high * -goal
            ]
            for rank, (score, name, _) in enumerate(within[: spec.negatives], 1):
                out.append((a[0], positive, rank, name, -goal, -score))
    return sorted(out)


def brute_top(rows, spec, every=4):
    used = [u for r in rows if (u := usable(r, spec.scale))]
    out = []
    for a in (r for r in used if r[0] % every == 0):
        others = sorted((-inner(a[2], b[2]), b[0]) for b in used if b[0] != a[0])
        out += [(a[0], i, name, -s) for i, (s, name) in enumerate(others[: spec.k], 1)]
    return sorted(out)


def negatives(spark, rows, spec, every=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, F.col("label"), spec=spec)
    return sorted(tuple(r) for r in found.collect())


def top(spark, rows, spec, every=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = topk.top_k(df, F.col("vec_id") % every == 0, spec=spec)
    return sorted(tuple(r) for r in found.collect())


def clustered(n, width, seed=0, labels=4, spread=0.4):
    rng = np.random.RandomState(seed)
    centers = rng.normal(size=(labels, width))
    label = rng.randint(labels, size=n)
    points = centers[label] + spread * rng.normal(size=(n, width))
    return [(i, int(c), p.tolist()) for i, (c, p) in enumerate(zip(label, points))]


ODD = [
    (0, 1, [0.5, -0.25, 1.0]), (4, 1, []), (8, 2, [2.0]), (12, 1, [0.5, -0.25, 1.0]),
    (1, 1, [0.5, -0.25, 1.0]), (2, 1, [0.5, -0.25, 1.0]), (3, 2, [0.25, 0.0, 0.5, 9.0]),
    (5, None, [1.0, 1.0, 1.0]), (6, 2, None), (7, 2, [NAN, 1.0, 1.0]), (9, 2, [INF, 1.0, 1.0]),
    (10, 2, [None, 1.0, 1.0]), (None, 2, [1.0, 1.0, 1.0]), (16, 3, [-1.0, -1.0, -1.0]),
    (11, 2, [0.3, 0.0, 0.3]), (13, 2, [0.3, 0.0, 0.3]), (0, 1, [0.5, -0.25, 1.0]),
    (0, 2, [0.25, 0.25, 0.25]), (20, 2, [0.0, 0.0, 0.0]), (-4, 1, [1e-9, 0.5, 0.25]),
    (14, 1, [3.0e7, -2.0e7, 1.0]), (24, 3, [-3.0e7, 1.0, 2.0]),
]


@pytest.mark.parametrize("scale", [1, 256])
def test_bit_planes_and_subset_sums_give_exact_scores(scale):
    rng = np.random.RandomState(3)
    left = rng.randint(-5 * scale, 5 * scale + 1, (30, 21))
    right = rng.randint(-5 * scale, 5 * scale + 1, (50, 21))
    planes = int(max(right.max(), ~right.min())).bit_length() + 1
    packed = hard_negatives.bit_planes(right, planes)
    assert packed.shape == (50, planes, 3)
    tables = hard_negatives.subset_sums(left)
    assert (hard_negatives.scores(tables, packed) == right @ left.T).all()
    narrow = hard_negatives._narrow(tables, planes)
    assert narrow.dtype == np.int32
    assert (hard_negatives.scores(narrow, packed) == right @ left.T).all()


@pytest.mark.parametrize("spec", [MiningSpec(group=50, anchors=7), MiningSpec(negatives=3, positives=2)])
def test_negatives_equal_plain_loops(spark, spec):
    rows = clustered(400, 11)
    got = negatives(spark, rows, spec)
    assert got == brute_negatives(rows, spec) and got


def test_negatives_of_odd_rows(spark):
    spec = MiningSpec(group=5)
    assert negatives(spark, ODD, spec) == brute_negatives(ODD, spec)


def test_negatives_with_one_hot_label_and_many_copies(spark):
    rows = [(i, int(i % 3 == 0), [1.0, 0.5] if i % 2 else [0.5, 0.4]) for i in range(600)]
    spec = MiningSpec(group=64)
    assert negatives(spark, rows, spec, 50) == brute_negatives(rows, spec, 50)


def test_empty_tables(spark):
    for rows in ([], [(1, 1, None)], [(4, 1, [])]):
        assert negatives(spark, rows, MiningSpec()) == []
        assert top(spark, rows, SearchSpec()) == []


SPECS = [
    SearchSpec(k=10),
    SearchSpec(k=3, cells=5, group=40, leaf=8, queries=16, children=4),
    SearchSpec(k=7, cells=1, sample=1, group=1000, leaf=2, base=1.2),
]


@pytest.mark.parametrize("spec", SPECS)
def test_top_k_equals_plain_loops(spark, spec):
    rows = clustered(500, 6)
    assert top(spark, rows, spec) == brute_top(rows, spec)


@pytest.mark.parametrize("spec", SPECS)
def test_top_k_of_odd_rows(spark, spec):
    assert top(spark, ODD, spec) == brute_top(ODD, spec)


def test_top_k_of_copies_and_few_rows(spark):
    rows = [(i, 0, [1.0, 0.5, 0.25]) for i in range(300)] + [(1000, 0, [2.0, 0.0, 0.0])]
    spec = SearchSpec(group=32, cells=4)
    assert top(spark, rows, spec, 50) == brute_top(rows, spec, 50)
    assert top(spark, rows[:3], spec, 2) == brute_top(rows[:3], spec, 2)


def test_cover_tree_covers_and_prunes():
    rows = clustered(3000, 8, labels=12, spread=0.05)
    points = np.array([np.floor(1024 * np.array(v)) for *_, v in rows]).astype(np.int64)
    spec = SearchSpec(leaf=16)
    tree = topk.CoverTree(points, spec)
    assert sorted(tree.order) == list(range(3000)) and (tree.points == points[tree.order]).all()
    for center, radius, low, high, first, last in zip(
        tree.center, tree.radius, tree.low, tree.high, tree.first, tree.last
    ):
        far = np.sqrt(((tree.points[low:high] - center) ** 2).sum(1))
        assert far.max() <= radius + 1e-6
        children = tree.center[first:last]
        if len(children):
            assert (children == center).all(1).any()
            assert tree.low[first] == low and tree.high[last - 1] == high
            apart = np.sqrt(((children[:, None] - children[None]) ** 2).sum(2))
            np.fill_diagonal(apart, np.inf)
            assert apart.min() >= tree.radius[first:last].max() - 1e-6
    asked = topk.CoverTree(points[:64], spec)
    found = topk.Found(np.full(64, topk._NONE), 10)
    ids = np.arange(3000)
    scored = topk.walk(asked, tree, ids[:64][asked.order], ids[tree.order], found)
    assert scored < 64 * 3000 / 2
    for query, score in zip(asked.order, found.score):
        inner_ = np.delete(points @ points[query], query)
        assert score.tolist() == sorted(inner_.tolist(), reverse=True)[:10]


def test_floored_takes_floats_as_doubles(spark):
    df = spark.createDataFrame([([0.1, -0.1, -0.0, 1.0, -1e300],)], "v array<float>")
    got = df.select(vectors.floored(F.col("v"), 1024)).first()[0]
    assert got[:4] == [102, -103, 0, 1024]


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_exact_topk"])
def test_queries_have_rows(spark, sf_check, name):
    assert queries.QUERIES[name](spark, sf_check).count() > 0
