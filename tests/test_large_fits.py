"""Queries that fit on more rows than an epoch once saw (409,600)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import queries
from holdfast import schema
from holdfast.config import KMeansSpec
from holdfast.operators import logreg, vectors

EDITORS = 530_000


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A feature table; what drops out depends on some of the features."""
    path = str(tmp_path_factory.mktemp("large") / "features")
    draws = [(F.pmod(F.xxhash64("id", F.lit(f)), F.lit(1000)) / 100).alias(f) for f in schema.FEATURE_COLS]
    rows = spark.range(EDITORS).select(F.col("id").cast("string").alias(queries.USER), *draws)
    risk = F.expr("velocity + revert_rate - 2 * weekend_ratio + 0.5 * session_count")
    rows.withColumn("dropout", (risk > 1.5).cast("int")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(autouse=True)
def stored(table, monkeypatch):
    monkeypatch.setattr(queries, "stored_features", lambda spark, sf_dir: table)


@pytest.fixture(scope="module")
def parts(table):
    """Standardised features and labels of the training and of the test rows."""
    rows = table.withColumn("picked", vectors.in_train()).toArrow()
    picked, y = rows["picked"].to_numpy(), rows["dropout"].to_numpy().astype(float)
    x = np.stack([rows[f].to_numpy() for f in schema.FEATURE_COLS], axis=1)
    x = (x - x[picked].mean(0)) / x[picked].std(0)
    assert picked.sum() > 409_600
    return (x[picked], y[picked]), (x[~picked], y[~picked])


def descent(x, y, spec):
    """Losses before each step over all rows, and what the steps end with."""
    w, b, losses = np.array(logreg.initial_weights(x.shape[1], spec)), 0.0, []
    for _ in range(spec.epochs):
        z = x @ w + b
        losses.append(np.mean(np.logaddexp(0, z) - z * y))
        err = 1 / (1 + np.exp(-z)) - y
        w, b = w - spec.lr * (x.T @ err) / len(x), b - spec.lr * err.mean()
    return losses, w, b


@pytest.mark.parametrize(
    "name, spec", [("logreg_loss", queries.LOGREG), ("logreg_loss_3ep", queries.THREE_EPOCHS)]
)
def test_every_epoch_sees_all_rows(spark, parts, name, spec):
    rows = queries.QUERIES[name](spark, "").orderBy("epoch").collect()
    (x, y), _ = parts
    assert [r.n for r in rows] == [len(x)] * spec.epochs
    assert [r.log_loss for r in rows] == pytest.approx(descent(x, y, spec)[0], abs=1e-6)


def test_summary_is_that_of_a_fit_on_all_rows(spark, parts, monkeypatch):
    models, fit = [], logreg.fit

    def kept(*args):
        models.append(fit(*args))
        return models[-1]

    monkeypatch.setattr(logreg, "fit", kept)
    monkeypatch.setattr(queries, "KMEANS", KMeansSpec(iters=1))  # clusters are not the point
    row = queries.QUERIES["summary"](spark, "").first()
    (x, y), (test_x, test_y) = parts
    _, w, b = descent(x, y, queries.LOGREG)
    assert [[h["rows"] for h in m.history] for m in models] == [[len(x)] * queries.LOGREG.epochs]
    assert models[0].weights == pytest.approx(list(w), abs=1e-9)
    z = test_x @ w + b
    hit, gone = z >= 0, test_y == 1
    below = np.searchsorted(np.sort(z[~gone]), z[gone])
    assert (row.n_editors, row.n_train) == (EDITORS, len(x))
    assert row.tp == pytest.approx((hit & gone).sum(), abs=1)  # a score may round to 0.5
    assert row.auc_roc == pytest.approx(below.sum() / (gone.sum() * (~gone).sum()), abs=1e-6)
