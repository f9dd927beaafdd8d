import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from holdfast.config import KMeansSpec, LogRegSpec, MLPSpec
from holdfast.operators import evaluate, kmeans, logreg, mlp, vectors
from holdfast.plans import report

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def blobs(spark):
    """Two clouds, apart along ``a``; label is the cloud."""
    rng = np.random.default_rng(3)
    rows = [
        (str(i), int(i % 2), float(rng.normal(6 * (i % 2), 1)), float(rng.normal(0, 5)))
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "event_user_id string, dropout int, a double, b double")


def scored_frame(spark, pairs):
    return spark.createDataFrame(pairs, "dropout int, score double")


def auc_of(spark, pairs, **kw):
    counts = evaluate.score_counts(scored_frame(spark, pairs))
    return evaluate.auc_roc(counts, **kw).first()[0]


def pairwise(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    won = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return won / (len(pos) * len(neg)) if pos and neg else math.nan


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 1), st.integers(0, 12).map(lambda i: i / 12)),
        min_size=1,
        max_size=60,
    )
)
def test_auc_equals_all_pairs(spark, pairs):
    got, want = auc_of(spark, pairs), pairwise(pairs)
    assert math.isnan(got) if math.isnan(want) else got == pytest.approx(want, abs=1e-12)


def test_auc_in_slices_is_the_same(spark):
    rng = random.Random(5)
    # Nearly all scores crowd in a small range, one of them holds a third of the rows.
    pairs = [(rng.randint(0, 1), 0.5 + rng.randint(0, 150) / 1e6) for _ in range(400)]
    pairs += [(i % 3 == 0, 0.50007) for i in range(200)]
    pairs = [(int(y), s) for y, s in pairs + [(0, 0.0), (1, 1.0)]]
    want = pairwise(pairs)
    for slices in (1, 2, 7, 64, 500):
        assert auc_of(spark, pairs, slices=slices) == pytest.approx(want, abs=1e-12)
    builtin = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="dropout", numBins=0
    ).evaluate(scored_frame(spark, pairs))
    assert builtin == pytest.approx(want, abs=1e-9)


def test_auc_corner_cases(spark):
    assert auc_of(spark, [(0, 0.3), (1, 0.3), (0, 0.3)]) == 0.5
    assert math.isnan(auc_of(spark, [(1, 0.3), (1, 0.4)]))


def test_missing_scores_are_the_lowest_and_all_cells_add_up(spark):
    pairs = [(1, None), (0, float("nan")), (1, 0.9), (0, 0.2), (1, 0.1), (0, 0.7)]
    row = evaluate.evaluate_binary(scored_frame(spark, pairs)).first()
    assert (row.tp, row.fp, row.tn, row.fn) == (1, 1, 2, 2)
    known = [(y, -1.0 if s is None or s != s else s) for y, s in pairs]
    assert row.auc_roc == pytest.approx(pairwise(known))
    assert auc_of(spark, pairs, slices=5) == pytest.approx(pairwise(known))


def test_threshold_is_inclusive_and_empty_denominators_give_zero(spark):
    row = evaluate.evaluate_binary(scored_frame(spark, [(1, 0.5), (0, 0.49)])).first()
    assert (row.tp, row.fp, row.tn, row.fn) == (1, 0, 1, 0)
    row = evaluate.evaluate_binary(scored_frame(spark, [(1, 0.1), (0, 0.2)])).first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_constant_feature_has_deviation_one(spark):
    rows = [(str(i), 0.1, float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    scaler = vectors.fit_scaler(df, FEATURES)
    assert scaler.stds[0] == 1.0
    scaled = vectors.scaled_features(df, scaler, [])
    row = scaled.agg(
        F.avg("a"), F.avg("b"), F.stddev_pop("b"), F.max(F.abs("a"))
    ).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[3] == pytest.approx(0, abs=1e-12)
    assert row[1] == pytest.approx(0, abs=1e-12) and row[2] == pytest.approx(1)


@pytest.mark.parametrize("value", [1.0, 0.1])
def test_constant_feature_in_any_partitioning(spark, value):
    for n in (3, 49, 197):
        df = spark.range(n).select(F.lit(value).alias("a"))
        for parts in (1, 5, 31):
            scaler = vectors.fit_scaler(df.repartition(parts), ["a"])
            assert (scaler.means, scaler.stds) == ([value], [1.0])


def test_split_and_sample_depend_on_the_key_alone(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("event_user_id"))
    sizes = []
    for n in (1, 7):
        train, test = vectors.train_test_split(df.repartition(n))
        assert train.count() + test.count() == 5000
        sizes.append(sorted(r[0] for r in test.collect()))
    assert sizes[0] == sizes[1]
    assert 900 < len(sizes[0]) < 1100
    assert vectors.sample_rows(df, 1.0, 1) is df


def test_split_by_share_and_seed(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("event_user_id"))
    picked = {
        (share, seed): {r[0] for r in vectors.train_test_split(df, share=share, seed=seed)[0].collect()}
        for share, seed in ((0.8, 0), (0.8, 1), (0.25, 0), (0.0, 0), (1.0, 0))
    }
    assert picked[0.25, 0] < picked[0.8, 0] != picked[0.8, 1]
    assert 1100 < len(picked[0.25, 0]) < 1400
    assert (len(picked[0.0, 0]), len(picked[1.0, 0])) == (0, 5000)


def test_samples_take_turns(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("event_user_id"))
    turns = [
        {r[0] for r in vectors.sample_rows(df, 0.25, seed=1, turn=t).collect()} for t in range(5)
    ]
    assert all(1100 < len(t) < 1400 for t in turns)
    assert len(set.union(*turns[:4])) == 5000 and turns[4] == turns[0]
    other = {r[0] for r in vectors.sample_rows(df, 0.25, seed=2).collect()}
    assert 200 < len(other & turns[0]) < 420
    # A stretch that runs over the end of the order goes on at its start.
    third = {r[0] for r in vectors.sample_rows(df, 0.4, seed=1, turn=2).collect()}
    assert 1800 < len(third) < 2200


def test_logreg_matches_plain_gradient_descent(blobs):
    spec = LogRegSpec(epochs=4)
    model = logreg.fit(blobs, spec, FEATURES)
    data = np.array([(r.a, r.b, r.dropout) for r in blobs.collect()])
    x = (data[:, :2] - data[:, :2].mean(0)) / data[:, :2].std(0)
    w, b = np.array(logreg.initial_weights(2, spec)), 0.0
    for _ in range(spec.epochs):
        err = 1 / (1 + np.exp(-(x @ w + b))) - data[:, 2]
        w, b = w - 0.1 * (x.T @ err) / len(x), b - 0.1 * err.mean()
    assert model.weights == pytest.approx(list(w)) and model.intercept == pytest.approx(b)
    losses = [h["log_loss"] for h in model.history]
    assert losses == sorted(losses, reverse=True)


def test_logreg_separates_and_agrees_with_the_library(blobs):
    model = logreg.fit(blobs, LogRegSpec(epochs=60, lr=1.0), FEATURES)
    auc = evaluate.evaluate_binary(model.score(blobs)).first().auc_roc
    assert auc > 0.99
    table = blobs.select(array_to_vector(F.array("a", "b")).alias("x"), "dropout")
    library = LogisticRegression(featuresCol="x", labelCol="dropout").fit(table)
    assert np.sign(library.coefficients[0]) == np.sign(model.weights[0])


def test_logreg_samples_large_tables(blobs):
    model = logreg.fit(blobs, LogRegSpec(epochs=2, batch=1), FEATURES)
    rows = [h["rows"] for h in model.history]
    assert all(50 < n < 160 for n in rows) and rows[0] != rows[1]


def test_logreg_caches_only_rows_that_an_epoch_takes(blobs, monkeypatch):
    """The result is that of taking turns through the whole table."""
    spec = LogRegSpec(epochs=3, batch=1, batches=60)
    few = logreg.fit(blobs, spec, FEATURES)
    monkeypatch.setattr(logreg, "in_turn", lambda s, f, t: vectors.in_turn(s, f if f < 0.2 else 1.0, t))
    assert logreg.fit(blobs, spec, FEATURES).weights == pytest.approx(few.weights, abs=1e-12)


def test_logreg_saved_form(blobs):
    model = logreg.fit(blobs, LogRegSpec(epochs=2), FEATURES)
    again = logreg.LogRegModel.from_dict(model.to_dict(), FEATURES)
    assert (again.weights, again.intercept) == (model.weights, model.intercept)
    assert again.scaler.means == model.scaler.means


def test_missing_feature_counts_as_zero(spark, blobs):
    model = logreg.fit(blobs, LogRegSpec(epochs=2), FEATURES)
    rows = spark.createDataFrame([(None, 1.0), (0.0, 1.0)], "a double, b double")
    a, b = [r.score for r in model.score(rows).collect()]
    assert a == b


def test_extreme_scores_do_not_overflow(spark, blobs):
    model = logreg.fit(blobs, LogRegSpec(epochs=2, lr=100.0), FEATURES)
    rows = spark.createDataFrame([(1e9, 0.0), (-1e9, 0.0)], "a double, b double")
    assert [r.score for r in model.score(rows).collect()] == [1.0, 0.0]


def test_kmeans_finds_the_clouds(blobs):
    model = kmeans.fit(blobs.select("event_user_id", "a"), KMeansSpec(k=2), ["a"])
    (low, high) = sorted(model.centers)
    s = model.scaler
    assert low[0] * s.stds[0] + s.means[0] == pytest.approx(0, abs=0.5)
    assert high[0] * s.stds[0] + s.means[0] == pytest.approx(6, abs=0.5)


def test_kmeans_cost_never_grows(blobs):
    costs = []
    for iters in range(1, 6):
        spec = KMeansSpec(iters=iters, shift_tol=0.0, cost_tol=0.0)
        model = kmeans.fit(blobs, spec, FEATURES)
        costs.append(kmeans.wcss(model.assign(blobs)).first().wcss)
        assert model.iterations == iters
    assert costs == sorted(costs, reverse=True)
    # The lagged cost was measured with the centers of one iteration before.
    assert model.lagged_cost == pytest.approx(costs[-2])


def points(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "a double")


def test_ties_go_to_the_lowest_center(spark):
    near = kmeans.with_nearest(points(spark, [1.0]), {"a": "a"}, [[0.0], [2.0], [5.0]])
    assert (near.first().cluster, near.first().nearest, near.first().second) == (0, 1.0, 1.0)


def test_center_without_points_stays(spark):
    table = kmeans.as_points(points(spark, [0.0, 1.0]), ["a"])
    moved, cost = kmeans.step(table, [[0.5], [99.0]])
    assert moved == [[0.5], [99.0]] and cost == 0.5


def test_silhouette_of_one_cluster_is_zero(blobs):
    model = kmeans.fit(blobs, KMeansSpec(k=1), FEATURES)
    assert kmeans.evaluate(model.assign(blobs)).first().silhouette == 0.0


def test_silhouette_uses_squared_center_distances(spark):
    near = kmeans.with_nearest(points(spark, [1.0, 3.0]), {"a": "a"}, [[0.0], [4.0]])
    # Both points are at squared distances 1 and 9.
    assert kmeans.simplified_silhouette(near).first()[0] == pytest.approx(8 / 9)


def test_kmeans_saved_form(blobs):
    model = kmeans.fit(blobs, KMeansSpec(iters=2), FEATURES)
    again = kmeans.KMeansModel.from_dict(model.to_dict())
    assert again.centers == model.centers and again.scaler.stds == model.scaler.stds


def test_network_gradient_against_differences():
    spec = MLPSpec(hidden=(5, 4), dropout=0.0)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(9, 3)), rng.integers(0, 2, 9).astype(float)
    flat = mlp.initial_weights(3, spec) + rng.normal(0, 0.1, len(mlp.initial_weights(3, spec)))

    def loss(w):
        return mlp._log_loss(mlp.forward(w, x, spec.hidden), y) / len(y)

    got = mlp._gradient(flat, x, y, spec, rng)
    for i in range(0, len(flat), 7):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-6)


def test_network_learns_and_repeats(blobs):
    spec = MLPSpec(epochs=6, batch=16, workers=2)
    model = mlp.fit(blobs, spec, FEATURES)
    assert evaluate.evaluate_binary(model.score(blobs)).first().auc_roc > 0.99
    assert model.history[-1]["val_log_loss"] < model.history[0]["val_log_loss"]
    again = mlp.fit(blobs.repartition(5), spec, FEATURES)
    assert np.array_equal(model.weights, again.weights) or np.allclose(
        model.weights, again.weights, atol=1e-9
    )


def plain_network(rows, spec):
    """The fit as loops over numpy arrays: rows are (key, x, y), scaled. Returns the weights and
    the losses of each epoch."""

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)

    held = [r for r in rows if number(r[0] + ":held out") / 2**32 < spec.validation_split]
    held_keys = {r[0] for r in held}
    copies = [[] for _ in range(spec.workers)]
    for r in sorted(rows, key=lambda r: (number(r[0] + ":order"), r[0])):
        if r[0] not in held_keys:
            copies[number(r[0] + ":worker") % spec.workers].append(r)
    sizes = [len(rows[0][1]), *spec.hidden, 1]
    rng = np.random.default_rng(spec.seed)
    state = []
    for n_in, n_out in zip(sizes, sizes[1:]):
        limit = math.sqrt(6 / (n_in + n_out))
        state += [rng.uniform(-limit, limit, (n_in, n_out)), np.zeros(n_out)]
    state += [np.zeros_like(w) for w in state * 2]
    steps, history = 0.0, []

    def outputs(w, x, mask=1.0):
        one = np.maximum(x @ w[0] + w[1], 0) * mask
        two = np.maximum(one @ w[2] + w[3], 0)
        return one, two, (two @ w[4] + w[5])[:, 0]

    def loss(z, y):
        return np.logaddexp(0, z) - z * y

    for epoch in range(spec.epochs):
        ends, seen, lost = [], [], 0.0
        for worker, own in enumerate(copies):
            rng = np.random.default_rng([spec.seed, epoch, worker])
            w, m, v, t = state[:6], state[6:12], state[12:], steps
            for at in range(0, len(own), spec.batch):
                some = own[at : at + spec.batch]
                x, y = np.array([r[1] for r in some]), np.array([r[2] for r in some])
                lost += loss(outputs(w, x)[2], y).sum()
                keep = rng.random((len(x), spec.hidden[0])) >= spec.dropout
                mask = keep / (1 - spec.dropout)
                one, two, z = outputs(w, x, mask)
                up = (1 / (1 + np.exp(-z)) - y)[:, None] / len(y)
                mid = up @ w[4].T * (two > 0)
                low = mid @ w[2].T * mask * (x @ w[0] + w[1] > 0)
                g = [x.T @ low, low.sum(0), one.T @ mid, mid.sum(0), two.T @ up, up.sum(0)]
                t += 1
                m = [0.9 * a + 0.1 * b for a, b in zip(m, g)]
                v = [0.999 * a + 0.001 * b * b for a, b in zip(v, g)]
                w = [
                    p - spec.learning_rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-7)
                    for p, a, b in zip(w, m, v)
                ]
            ends.append([*w, *m, *v, t])
            seen.append(len(own))
        *state, steps = (
            sum(n * end[i] for n, end in zip(seen, ends)) / sum(seen) for i in range(19)
        )
        after = outputs(state[:6], np.array([r[1] for r in held]))[2]
        history.append((lost / sum(seen), loss(after, np.array([r[2] for r in held])).mean()))
    return np.concatenate([w.ravel() for w in state[:6]]), history


@pytest.mark.parametrize(
    "spec",
    [
        MLPSpec(hidden=(5, 4), dropout=0.0, batch=32, epochs=3, workers=1),
        MLPSpec(hidden=(5, 4), dropout=0.5, batch=50, epochs=3, workers=3, validation_split=0.3),
        MLPSpec(),
    ],
)
def test_network_equals_plain_loops(blobs, spec):
    """Several steps an epoch, dropout, a held-out share, and the state of the optimiser."""
    model = mlp.fit(blobs, spec, FEATURES)
    scaled = [
        (r.event_user_id, [(r[f] - m) / s for f, m, s in zip(FEATURES, model.scaler.means, model.scaler.stds)], r.dropout)
        for r in blobs.collect()
    ]
    weights, history = plain_network(scaled, spec)
    assert model.weights == pytest.approx(weights, abs=1e-9)
    for got, (train, held_out) in zip(model.history, history, strict=True):
        assert got["log_loss"] == pytest.approx(train, abs=1e-9)
        assert got["val_log_loss"] == pytest.approx(held_out, abs=1e-9)


def test_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(int(c), *map(float, rng.normal(3 * c, 1, 2))) for c in [0] * 20 + [1] * 15 + [2]]
    table = spark.createDataFrame(rows, "cluster int, a double, b double")
    scaler = vectors.Scaler(["a", "b"], [0.5, -1.0], [2.0, 3.0], 0)
    points_ = [(c, (a - 0.5) / 2, (b + 1) / 3) for c, a, b in rows]
    total = 0.0
    for i, (c, *x) in enumerate(points_):
        means = {}
        for other in {0, 1, 2}:
            far = [math.dist(x, y) ** 2 for j, (d, *y) in enumerate(points_) if d == other and j != i]
            means[other] = sum(far) / len(far) if far else None
        inside, outside = means.pop(c), min(means.values())
        total += 0.0 if inside is None else (outside - inside) / max(inside, outside)
    got = kmeans.silhouette(table, scaler).first()[0]
    assert got == pytest.approx(total / len(points_))
    assert kmeans.silhouette(table.filter("cluster = 0"), scaler).first()[0] == 0.0
    assert kmeans.silhouette(table.limit(0), scaler).first()[0] is None


def test_risk_lists_are_limited_before_the_shuffle(spark):
    rows = [(f"e{i:03}", i % 50 and 0, i / 200 if i % 9 else None) for i in range(200)]
    table = spark.createDataFrame(rows, "event_user_id string, cluster int, score double")
    found = report.top_risk_by_archetype(table.repartition(4), 3)
    got = [(r.cluster, r.place, r.event_user_id) for r in found.orderBy("cluster", "place").collect()]
    assert got[:3] == [(0, 1, "e199"), (0, 2, "e197"), (0, 3, "e196")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert final < plan.index("Exchange hash") < partial


@pytest.mark.parametrize("workers", [1, 3])
def test_network_does_not_depend_on_batches_or_partitions(spark, blobs, workers):
    spec = MLPSpec(epochs=2, batch=7, workers=workers)
    want = mlp.fit(blobs, spec, FEATURES)
    try:
        for records in (1, 13, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            got = mlp.fit(blobs.repartition(9), spec, FEATURES)
            assert got.weights == pytest.approx(want.weights, abs=1e-12)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # More rows train more steps of as many copies, not more copies.
    shares = blobs.groupBy(mlp.worker_of(F.col("event_user_id"), workers)).count()
    assert shares.count() == workers


def test_a_partition_may_hold_several_copies(spark, blobs):
    """Whatever the range partitioner does with few keys."""
    spec = MLPSpec(epochs=1, batch=16, workers=4, validation_split=0.0)
    rows = np.array([(r.a, r.b, r.dropout) for r in blobs.collect()])
    flat = mlp.initial_weights(2, spec)

    def batch(worker, part):
        return pa.RecordBatch.from_pydict(
            {
                "_worker": [worker] * len(part),
                "x": part[:, :2].tolist(),
                "_y": part[:, 2].tolist(),
                "_held_out": [False] * len(part),
            }
        )

    run = mlp._local_epoch(mlp._State.start(flat), spec, 0)
    alone = [list(run([batch(w, rows[w * 100 : w * 100 + 100])])) for w in (0, 1)]
    joined = list(run([batch(0, rows[:60]), batch(0, rows[60:100]), batch(1, rows[100:200])]))
    assert [b.to_pydict() for b in joined] == [b.to_pydict() for parts in alone for b in parts]


def largest_method(df):
    session = df.sparkSession
    text = session._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)), default=0)


def test_plans_do_not_grow_with_the_number_of_centers(blobs):
    sizes, texts = [], []
    for k in (4, 64):
        centers = [[i / k, -i / k] for i in range(k)]
        near = kmeans.with_nearest(blobs, {"a": "a", "b": "b"}, centers)
        sizes.append(largest_method(near.groupBy("cluster").count()))
        texts.append(len(near._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[0] == sizes[1] < 8000
    assert abs(texts[0] - texts[1]) < 10
