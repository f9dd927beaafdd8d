"""K-Means by Lloyd's iterations, one grouped aggregate per iteration.

Points travel as one array each; distances to all centers are a loop over the centers in
numpy, so plans and generated code are the same for any number of centers. Every task sums its
rows per cluster before the shuffle, so a cluster that holds most rows costs no more than
others.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schema
from holdfast.config import KMeansSpec
from holdfast.functions.scalars import sql_double
from holdfast.operators.vectors import KEY, Scaler, fit_scaler, pick_rows
from holdfast.shipping import ship_package

_COUNT, _COST = -2, -1


def _points(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest center (the lowest on ties), squared distances to the two nearest."""
    distances = np.empty((len(x), len(centers)))
    for i, center in enumerate(centers):
        distances[:, i] = ((x - center) ** 2).sum(1)
    cluster = distances.argmin(1)
    if len(centers) == 1:
        return cluster, distances[:, 0], distances[:, 0]
    two = np.partition(distances, 1, axis=1)
    return cluster, two[:, 0], two[:, 1]


def with_nearest(
    df: DataFrame, features: dict[str, str], centers: list[list[float]]
) -> DataFrame:
    """Add ``cluster`` (the lowest index on ties) and squared distances to the two nearest.

    ``features`` gives the SQL text of each scaled feature. ``second`` equals ``nearest``
    when there is only one center.
    """
    ship_package(df.sparkSession)
    at = np.array(centers, float)

    @F.arrow_udf("cluster int, nearest double, second double")
    def near(x: pa.Array) -> pa.Array:
        cluster, nearest, second = _nearest(_points(x), at)
        return pa.StructArray.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(nearest), pa.array(second)],
            names=["cluster", "nearest", "second"],
        )

    x = F.array(*[F.expr(text) for text in features.values()])
    found = df.withColumn("_near", near(x))
    return found.select(*df.columns, "_near.cluster", "_near.nearest", "_near.second")


def _partial_sums(centers: list[list[float]]):
    """The task side of a step: count, cost and sums of each cluster over all its batches."""
    at = np.array(centers, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = at.shape
        sums = np.zeros((k, d + 2))
        for batch in batches:
            x = _points(batch.column("x"))
            cluster, nearest, _ = _nearest(x, at)
            sums[:, 0] += np.bincount(cluster, minlength=k)
            sums[:, 1] += np.bincount(cluster, nearest, k)
            for i in range(d):
                sums[:, 2 + i] += np.bincount(cluster, x[:, i], k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k), d + 2), pa.int32()),
                pa.array(np.tile(np.arange(_COUNT, d), k), pa.int32()),
                pa.array(sums.ravel()),
            ],
            names=["cluster", "i", "value"],
        )

    return run


@dataclass(frozen=True)
class KMeansModel:
    scaler: Scaler
    centers: list[list[float]]
    lagged_cost: float = float("inf")
    train_seconds: float = 0.0
    iterations: int = 0

    def assign(self, df: DataFrame) -> DataFrame:
        """Nearest center per row, from the unscaled feature columns."""
        return with_nearest(df, self.scaler.sql(), self.centers)

    def to_dict(self) -> dict:
        return {
            "centers_standardized": self.centers,
            "feature_order": self.scaler.features,
            "scaler": {"means": self.scaler.means, "stds": self.scaler.stds},
        }

    @classmethod
    def from_dict(cls, saved: dict):
        s = saved["scaler"]
        scaler = Scaler(list(saved["feature_order"]), s["means"], s["stds"], 0)
        return cls(scaler, saved["centers_standardized"])


def as_points(scaled: DataFrame, features: list[str]) -> DataFrame:
    return scaled.select(F.array(*features).alias("x"))


def step(
    points: DataFrame, centers: list[list[float]]
) -> tuple[list[list[float]], float]:
    """New centers, and the cost of the old ones. A center without rows stays."""
    ship_package(points.sparkSession)
    parts = points.mapInArrow(_partial_sums(centers), "cluster int, i int, value double")
    sums = np.zeros((len(centers), len(centers[0]) + 2))
    # One row per center and coordinate, whatever the number of points.
    for row in parts.groupBy("cluster", "i").agg(F.sum("value").alias("value")).collect():
        sums[row["cluster"], row["i"] - _COUNT] = row["value"]
    moved = [
        (own[2:] / own[0]).tolist() if own[0] else list(old) for own, old in zip(sums, centers)
    ]
    return moved, float(sums[:, 1].sum())


def fit(
    df: DataFrame,
    spec: KMeansSpec = KMeansSpec(),
    features: list[str] = schema.FEATURE_COLS,
    key: str = KEY,
) -> KMeansModel:
    """Fit on all rows of ``df``, which should be a stored table."""
    scaler = fit_scaler(df, features)
    start = df.transform(pick_rows, spec.k, spec.seed, key).select(*scaler.columns())
    centers = [list(row) for row in start.collect()]
    points = as_points(df.select(*scaler.columns()), features)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    last_cost, done = float("inf"), 0
    started = time.monotonic()
    try:
        for _ in range(spec.iters):
            moved, cost = step(points, centers)
            shift = sum(math.dist(a, b) for a, b in zip(centers, moved))
            centers, done = moved, done + 1
            settled = abs(last_cost - cost) < spec.cost_tol * max(1.0, last_cost)
            if shift < spec.shift_tol or settled:
                break
            last_cost = cost
    finally:
        points.unpersist()
    return KMeansModel(scaler, centers, last_cost, time.monotonic() - started, done)


def centers_frame(spark, model: KMeansModel) -> DataFrame:
    """One row per center and feature: ``cluster, feature, value`` (standardised)."""
    return spark.createDataFrame(
        [
            (i, f, float(v))
            for i, center in enumerate(model.centers)
            for f, v in zip(model.scaler.features, center)
        ],
        "cluster int, feature string, value double",
    )


def wcss(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("nearest").alias("wcss"))


def silhouette_of_point() -> Column:
    """Contrast of the two nearest centers, by squared distance."""
    larger = F.greatest("nearest", "second")
    return F.when(larger == 0, 0.0).otherwise((F.col("second") - F.col("nearest")) / larger)


def simplified_silhouette(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.avg(silhouette_of_point()).alias("silhouette"))


def cluster_moments(assigned: DataFrame, scaler: Scaler) -> DataFrame:
    """Per cluster the number of points, the sum of each scaled coordinate, and the sum of
    squared lengths: all that mean squared distances to a cluster need."""
    scaled = scaler.sql()
    squares = " + ".join(f"pow({text}, 2)" for text in scaled.values())
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"sum({squares})").alias("squares"),
        *[F.expr(f"sum({text})").alias(f"sum_{f}") for f, text in scaled.items()],
    )


def silhouette(assigned: DataFrame, scaler: Scaler) -> DataFrame:
    """The silhouette over all rows, by squared distances between points.

    A point's mean squared distance to the points of a cluster follows from the cluster's
    moments, so no pair of points is formed: one pass for the moments, one row per cluster,
    and one for the mean. A point alone in its cluster counts as 0, as do points if there is
    one cluster only.
    """
    scaled = scaler.sql()
    own_squares = F.expr(" + ".join(f"pow({text}, 2)" for text in scaled.values()))
    moments = cluster_moments(assigned, scaler).collect()

    def total(m) -> Column:
        """The sum of squared distances from a row to all points of a cluster."""
        dot = " + ".join(f"{text} * {sql_double(m[f'sum_{f}'])}" for f, text in scaled.items())
        sum_ = m["n"] * own_squares - 2 * F.expr(dot) + F.lit(m["squares"])
        return F.greatest(sum_, F.lit(0.0))

    inside, outside, sizes = F.lit(None), [], F.lit(None)
    for m in moments:
        own = F.col("cluster") == m["cluster"]
        inside = F.when(own, total(m) / max(m["n"] - 1, 1)).otherwise(inside)
        sizes = F.when(own, F.lit(m["n"])).otherwise(sizes)
        outside.append(F.when(~own, total(m) / m["n"]))
    if len(moments) < 2:
        return assigned.agg(
            F.when(F.count(F.lit(1)) > 0, F.lit(0.0)).alias("silhouette")
        )
    of_point = assigned.select(
        inside.alias("a"), F.least(*outside).alias("b"), sizes.alias("size")
    )
    larger = F.greatest("a", "b")
    value = F.when((F.col("size") == 1) | (larger == 0), 0.0).otherwise(
        (F.col("b") - F.col("a")) / larger
    )
    return of_point.agg(F.avg(value).alias("silhouette"))


def cluster_profile(
    assigned: DataFrame, features: list[str] = schema.FEATURE_COLS
) -> DataFrame:
    """Size and mean of every feature in its own unit, per cluster."""
    return assigned.groupBy(F.col("cluster").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("cluster_size"),
        *[F.avg(f).alias(f"mean_{f}") for f in features],
    )


def cluster_sums(
    assigned: DataFrame, features: list[str] = schema.FEATURE_COLS
) -> DataFrame:
    """The profile with the ``wcss`` and the ``silhouette_sum`` of each cluster: all that the
    metrics need, in one pass."""
    return assigned.groupBy(F.col("cluster").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("cluster_size"),
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        F.sum("nearest").alias("wcss"),
        F.sum(silhouette_of_point()).alias("silhouette_sum"),
    )


def evaluate(assigned: DataFrame) -> DataFrame:
    """``wcss`` and ``silhouette`` over all rows, in one pass."""
    return assigned.agg(
        F.sum("nearest").alias("wcss"), F.avg(silhouette_of_point()).alias("silhouette")
    )
