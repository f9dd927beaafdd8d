"""Cohort summary, model comparison and the tables behind each dashboard panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import schema

MODEL_COLUMNS = (
    "model string, auc_roc double, f1 double, precision double, recall double, "
    "accuracy double, train_seconds double"
)


def cohort_summary(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("n_editors"),
        F.avg("dropout").alias("dropout_rate"),
    )


def model_compare(spark: SparkSession, metrics: list[dict]) -> DataFrame:
    """One row per model that has metrics; models that were not trained are left out."""
    names = [part.split()[0] for part in MODEL_COLUMNS.split(", ")]
    rows = [tuple(m[name] for name in names) for m in metrics if m is not None]
    return spark.createDataFrame(rows, MODEL_COLUMNS)


def panel_auc(compared: DataFrame) -> DataFrame:
    return compared.select("model", "auc_roc")


def panel_confusion(confusion: DataFrame) -> DataFrame:
    """The confusion matrix as ``actual, predicted, n``."""
    return confusion.select(
        F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)")
    )


def panel_cluster_sizes(profile: DataFrame) -> DataFrame:
    return profile.select("cluster_id", "cluster_size").orderBy("cluster_id")


def panel_revert_vs_velocity(profile: DataFrame) -> DataFrame:
    return profile.select(
        "cluster_id", "cluster_size", "mean_revert_rate", "mean_velocity"
    ).orderBy("cluster_id")


def results_table(
    profile: DataFrame, logreg: dict, kmeans: dict, mlp: dict | None = None
) -> DataFrame:
    """One row per cluster with the scalars of every model; no network gives NULL."""
    scalars = {
        "model_auc_logreg": logreg["auc_roc"],
        "model_auc_dnn": None if mlp is None else mlp["auc_roc"],
        "kmeans_silhouette": kmeans["silhouette"],
        "logreg_train_seconds": logreg["train_seconds"],
        "kmeans_train_seconds": kmeans["train_seconds"],
    }
    columns = {name: F.lit(value).cast("double") for name, value in scalars.items()}
    return profile.select(
        *[
            columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schema.RESULTS.fields
        ]
    ).orderBy("cluster_id")


def summary(features: DataFrame, logreg: dict, kmeans: dict, mlp: dict | None = None) -> dict:
    """The summary object that goes next to the dashboard."""
    out = cohort_summary(features).first().asDict()
    out.update({"logreg": logreg, "kmeans": kmeans})
    if mlp is not None:
        out["dnn"] = mlp
    return out


def top_risk_by_archetype(
    scored: DataFrame, k: int, score: str = "score", cluster: str = "cluster"
) -> DataFrame:
    """The ``k`` editors of each cluster who are most likely to leave, with their ``place``.

    ``scored`` has a score and a cluster per editor: both models add columns, so nothing is
    joined. There are a handful of clusters and each may hold most editors; Spark limits the
    groups before the shuffle, so a task sends ``k`` rows a cluster. Ties go by editor id. A
    missing score comes last.
    """
    order = Window.partitionBy(cluster).orderBy(F.desc_nulls_last(score), "event_user_id")
    return scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_risk(scored: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The ``k`` editors most likely to leave."""
    return scored.orderBy(F.desc(score), "event_user_id").limit(k)
