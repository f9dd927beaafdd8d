"""A small neural network trained data-parallel.

Every epoch ``workers`` copies of the network train, each over its own share of the rows, and
Spark averages the copies weighted by row count. Shares and the order of rows in them follow
from hashes of the keys, and mini-batches are cut from that order, so that neither the number
of rows nor the partitioning of the input nor the size of Arrow batches changes the result.
The weights leave the tasks as one row per parameter and are summed by the shuffle, so the
driver sees one set of weights however many copies there are. The state of the optimiser (two
moments a parameter, and the number of steps) is averaged in the same way and goes on in the
next epoch.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schema
from holdfast.config import MLPSpec
from holdfast.functions.scalars import hash32, hash_unit
from holdfast.operators.vectors import KEY, Scaler, fit_scaler
from holdfast.shipping import ship_package

_TRAIN_LOSS, _VAL_LOSS = -1, -2


def _shapes(n_inputs: int, hidden: tuple[int, ...]) -> list[tuple[int, ...]]:
    sizes = [n_inputs, *hidden, 1]
    return [s for a, b in zip(sizes, sizes[1:]) for s in ((a, b), (b,))]


def initial_weights(n_inputs: int, spec: MLPSpec) -> np.ndarray:
    """Uniform within sqrt(6 / (inputs + outputs)) per layer, biases 0."""
    rng = np.random.default_rng(spec.seed)
    parts = []
    for shape in _shapes(n_inputs, spec.hidden):
        if len(shape) == 2:
            limit = np.sqrt(6.0 / sum(shape))
            parts.append(rng.uniform(-limit, limit, shape).ravel())
        else:
            parts.append(np.zeros(shape))
    return np.concatenate(parts)


def _layers(flat: np.ndarray, n_inputs: int, hidden: tuple[int, ...]) -> list[np.ndarray]:
    out, at = [], 0
    for shape in _shapes(n_inputs, hidden):
        size = int(np.prod(shape))
        out.append(flat[at : at + size].reshape(shape))
        at += size
    return out


def _logistic(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1.0 / (1.0 + e), e / (1.0 + e))


def forward(flat: np.ndarray, x: np.ndarray, hidden: tuple[int, ...]) -> np.ndarray:
    """Output before the logistic function."""
    w1, b1, w2, b2, w3, b3 = _layers(flat, x.shape[1], hidden)
    h1 = np.maximum(x @ w1 + b1, 0.0)
    h2 = np.maximum(h1 @ w2 + b2, 0.0)
    return (h2 @ w3 + b3).ravel()


def _log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.sum(np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))))


def _gradient(flat, x, y, spec: MLPSpec, rng) -> np.ndarray:
    """Mean gradient of the log loss over one batch, with dropout after the first layer."""
    w1, b1, w2, b2, w3, b3 = _layers(flat, x.shape[1], spec.hidden)
    a1 = x @ w1 + b1
    mask = (rng.random(a1.shape) >= spec.dropout) / (1.0 - spec.dropout)
    h1 = np.maximum(a1, 0.0) * mask
    a2 = h1 @ w2 + b2
    h2 = np.maximum(a2, 0.0)
    z = (h2 @ w3 + b3).ravel()
    dz = ((_logistic(z) - y) / len(y))[:, None]
    d2 = (dz @ w3.T) * (a2 > 0)
    d1 = (d2 @ w2.T) * mask * (a1 > 0)
    grads = (x.T @ d1, d1.sum(0), h1.T @ d2, d2.sum(0), h2.T @ dz, dz.sum(0))
    return np.concatenate([g.ravel() for g in grads])


@dataclass
class _State:
    """Weights, and the state of Adam: both moments and the (averaged) number of steps."""

    w: np.ndarray
    m: np.ndarray
    v: np.ndarray
    t: float = 0.0

    @classmethod
    def start(cls, w: np.ndarray):
        return cls(w, np.zeros(len(w)), np.zeros(len(w)))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w, self.m, self.v, [self.t]])

    @classmethod
    def of(cls, flat: np.ndarray):
        w, m, v = flat[:-1].reshape(3, -1)
        return cls(w, m, v, float(flat[-1]))

    def after(self, g: np.ndarray, rate: float):
        t = self.t + 1
        m, v = 0.9 * self.m + 0.1 * g, 0.999 * self.v + 0.001 * g * g
        scaled = (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
        return _State(self.w - rate * scaled, m, v, t)


class _Copy:
    """One copy in training: takes rows in order, steps whenever a mini-batch is full."""

    def __init__(self, start: _State, spec: MLPSpec, epoch: int, worker: int):
        self.start, self.state, self.spec = start.w, start, spec
        self.rng = np.random.default_rng([spec.seed, epoch, worker])
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = self.seen = self.held_out = 0
        self.train_loss = self.val_loss = 0.0

    def take(self, x: np.ndarray, y: np.ndarray, held_out: np.ndarray, train: bool) -> None:
        if held_out.any():
            z = forward(self.start, x[held_out], self.spec.hidden)
            self.val_loss += _log_loss(z, y[held_out])
            self.held_out += int(held_out.sum())
        x, y = x[~held_out], y[~held_out]
        while train and len(y):
            room = self.spec.batch - self.n_waiting
            self.waiting.append((x[:room], y[:room]))
            self.n_waiting += len(y[:room])
            x, y = x[room:], y[room:]
            if self.n_waiting == self.spec.batch:
                self._step()

    def _step(self) -> None:
        x, y = (np.concatenate(part) for part in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        self.train_loss += _log_loss(forward(self.state.w, x, self.spec.hidden), y)
        g = _gradient(self.state.w, x, y, self.spec, self.rng)
        self.state = self.state.after(g, self.spec.learning_rate)
        self.seen += len(y)

    def rows(self) -> pa.RecordBatch:
        """Each number of the state times the rows seen, and the losses before each step."""
        if self.n_waiting:
            self._step()
        flat = self.state.flat()
        ids = np.concatenate([np.arange(len(flat)), [_TRAIN_LOSS, _VAL_LOSS]])
        sums = np.concatenate([flat * self.seen, [self.train_loss, self.val_loss]])
        counts = np.concatenate([np.full(len(flat), self.seen), [self.seen, self.held_out]])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(sums), pa.array(counts, pa.int64())],
            names=["id", "total", "n"],
        )


def _local_epoch(start: _State, spec: MLPSpec, epoch: int, train: bool = True):
    """The task side of one epoch: ordered rows in, weighted parameters out. A partition may
    hold the shares of several copies, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy, current = None, None
        for batch in batches:
            workers = np.asarray(batch.column("_worker"))
            x = np.asarray(batch.column("x").flatten(), float).reshape(len(workers), -1)
            y = np.asarray(batch.column("_y"), float)
            held_out = batch.column("_held_out").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(workers)) + 1), len(workers)]
            for low, high in zip(cuts, cuts[1:]):
                if high > low and workers[low] != current:
                    if copy is not None:
                        yield copy.rows()
                    current = int(workers[low])
                    copy = _Copy(start, spec, epoch, current)
                if high > low:
                    copy.take(x[low:high], y[low:high], held_out[low:high], train)
        if copy is not None:
            yield copy.rows()

    return run


@dataclass(frozen=True)
class MLPModel:
    scaler: Scaler
    weights: np.ndarray
    hidden: tuple[int, int]
    train_seconds: float = 0.0
    history: list[dict] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Add the predicted probability, one Arrow batch at a time."""
        ship_package(df.sparkSession)
        flat, hidden, s = self.weights, self.hidden, self.scaler

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy() for c in columns])
            return pd.Series(_logistic(forward(flat, x, hidden)))

        return df.withColumn(out, predict(*s.columns()))

    def to_dict(self) -> dict:
        return {
            "hidden": list(self.hidden),
            "weights": [float(w) for w in self.weights],
            "feature_order": self.scaler.features,
            "scaler": {"means": self.scaler.means, "stds": self.scaler.stds},
        }

    @classmethod
    def from_dict(cls, saved: dict):
        s = saved["scaler"]
        scaler = Scaler(list(saved["feature_order"]), s["means"], s["stds"], 0)
        return cls(scaler, np.array(saved["weights"]), tuple(saved["hidden"]))


def fit(
    train: DataFrame,
    spec: MLPSpec = MLPSpec(),
    features: list[str] = schema.FEATURE_COLS,
    label: str = "dropout",
    key: str = KEY,
) -> MLPModel:
    """Fit on ``train``, which should be a stored table.

    A rerun of a lost task sees the same rows in the same order and returns the same result.
    ``val_log_loss`` of an epoch is the loss of its averaged weights on the held-out rows.
    """
    ship_package(train.sparkSession)
    scaler = fit_scaler(train, features)
    k = F.col(key)
    rows = (
        train.select(
            k.alias("_key"),
            worker_of(k, spec.workers).alias("_worker"),
            hash32(k, ":order").alias("_order"),
            (hash_unit(k, ":held out") < spec.validation_split).alias("_held_out"),
            F.col(label).cast("double").alias("_y"),
            F.array(*scaler.columns()).alias("x"),
        )
        .repartitionByRange(spec.workers, "_worker")
        .sortWithinPartitions("_worker", "_order", "_key")
        .drop("_order", "_key")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )

    def epoch_means(epoch: int, training: bool = True) -> dict[int, float]:
        parts = rows.mapInArrow(
            _local_epoch(state, spec, epoch, training), "id int, total double, n bigint"
        )
        mean = F.try_divide(F.sum("total"), F.sum("n")).alias("mean")
        return {r["id"]: r["mean"] for r in parts.groupBy("id").agg(mean).collect()}

    state = _State.start(initial_weights(len(features), spec))
    history: list[dict] = []
    started = time.monotonic()
    try:
        for epoch in range(spec.epochs):
            means = epoch_means(epoch)
            if history:
                history[-1]["val_log_loss"] = means.get(_VAL_LOSS)
            trained = [means.get(i) for i in range(len(state.flat()))]
            if trained[0] is not None:
                state = _State.of(np.array(trained))
            history.append({"epoch": epoch, "log_loss": means.get(_TRAIN_LOSS)})
        if history:
            history[-1]["val_log_loss"] = epoch_means(spec.epochs, False).get(_VAL_LOSS)
    finally:
        rows.unpersist()
    return MLPModel(scaler, state.w, spec.hidden, time.monotonic() - started, history)


def worker_of(key: Column, workers: int) -> Column:
    """The copy that a row trains."""
    return hash32(key, ":worker") % workers
