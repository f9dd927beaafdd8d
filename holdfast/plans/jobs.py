"""The jobs of the pipeline. Each reads stored tables and writes its result, so any of them
can be rerun alone after a failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from holdfast import schema
from holdfast.config import FeatureSpec, KMeansSpec, LogRegSpec, MLPSpec
from holdfast.operators import clean, evaluate, features, kmeans, logreg, mlp, vectors
from holdfast.plans import report
from holdfast.sources import files
from holdfast.streaming import endpoints, feed
from holdfast.workspace import require_utc


def run_clean(
    spark: SparkSession,
    raw_path: str,
    clean_path: str,
    pattern: str = "*.tsv.bz2",
    grouped_by_month: bool = True,
    max_rejected: int | None = 0,
) -> dict[str, int]:
    """Raw history files to clean edits partitioned by month, in one pass.

    Returns the number of ``lines``, and of those ``rejected`` because their cells do not
    match the layout. More than ``max_rejected`` (None: any number) fail the job after
    writing; ``files.rejected`` shows the lines.
    """
    require_utc(spark)
    seen = Observation("raw lines")
    lines = files.read_raw_lines(spark, raw_path, pattern=pattern)
    counted = files.accepted(lines.observe(seen, *files.line_counts()))
    files.write_clean(clean.clean(counted), clean_path, grouped_by_month)
    counts = seen.get
    if max_rejected is not None and counts["rejected"] > max_rejected:
        raise ValueError(
            f"{raw_path}: {counts['rejected']} of {counts['lines']} lines do not have the "
            f"{len(schema.RAW)} tab-separated cells of the layout"
        )
    return counts


def run_features(
    spark: SparkSession,
    clean_path: str,
    features_path: str,
    spec: FeatureSpec = FeatureSpec(),
    start: tuple[int, int] | None = None,
    end: tuple[int, int] | None = None,
) -> None:
    require_utc(spark)
    edits = files.read_clean(spark, clean_path, start, end)
    files.write_features(features.editor_features(edits, spec), features_path)


def _binary_metrics(scored: DataFrame) -> dict:
    row = evaluate.evaluate_binary(scored).first().asDict()
    row["confusion"] = {cell: row.pop(cell) for cell in ("tp", "fp", "tn", "fn")}
    return row


def logreg_metrics(model: logreg.LogRegModel, scored: DataFrame, spec: LogRegSpec) -> dict:
    return {
        "model": "logreg",
        "n_train": model.scaler.count,
        "n_features": len(model.scaler.features),
        "epochs": spec.epochs,
        "lr": spec.lr,
        "batch": model.scaler.count if spec.batch is None else spec.batch,
        "train_seconds": model.train_seconds,
        **_binary_metrics(scored),
    }


def run_logreg(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    metrics_path: str,
    spec: LogRegSpec = LogRegSpec(),
) -> dict:
    train, test = vectors.train_test_split(files.read_features(spark, features_path))
    model = logreg.fit(train, spec)
    metrics = logreg_metrics(model, model.score(test), spec)
    files.save_json(spark, model.to_dict(), model_path)
    files.save_json(spark, metrics, metrics_path)
    return metrics


def kmeans_metrics(model: kmeans.KMeansModel, assigned: DataFrame) -> dict:
    """``wcss`` is the cost of the final centers; ``wcss_lagged`` the cost that was compared
    with last when fitting stopped."""
    names = model.scaler.features
    rows = kmeans.cluster_sums(assigned, names).collect()  # one row per cluster
    n = sum(row["cluster_size"] for row in rows)
    profile = {
        str(row["cluster_id"]): {
            "size": row["cluster_size"],
            "feature_mean": {f: row[f"mean_{f}"] for f in names},
        }
        for row in rows
    }
    return {
        "model": "kmeans",
        "k": len(model.centers),
        "train_seconds": model.train_seconds,
        "silhouette": sum(row["silhouette_sum"] for row in rows) / n if n else None,
        "wcss": sum(row["wcss"] for row in rows) if n else None,
        "wcss_lagged": model.lagged_cost,
        "cluster_profile": profile,
    }


def run_kmeans(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    metrics_path: str,
    spec: KMeansSpec = KMeansSpec(),
) -> dict:
    table = files.read_features(spark, features_path)
    model = kmeans.fit(table, spec)
    metrics = kmeans_metrics(model, model.assign(table))
    files.save_json(spark, model.to_dict(), model_path)
    files.save_json(spark, metrics, metrics_path)
    return metrics


def mlp_metrics(model: mlp.MLPModel, scored: DataFrame, spec: MLPSpec) -> dict:
    return {
        "model": "mlp",
        "n_train": model.scaler.count,
        "n_features": len(model.scaler.features),
        "epochs": spec.epochs,
        "batch": spec.batch,
        "train_seconds": model.train_seconds,
        **_binary_metrics(scored),
    }


def run_mlp(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    metrics_path: str,
    spec: MLPSpec = MLPSpec(),
) -> dict:
    train, test = vectors.train_test_split(files.read_features(spark, features_path))
    model = mlp.fit(train, spec)
    metrics = mlp_metrics(model, model.score(test), spec)
    files.save_json(spark, model.to_dict(), model_path)
    files.save_json(spark, metrics, metrics_path)
    return metrics


def run_feed(lines: DataFrame, wiki: str, start_sink) -> StreamingQuery:
    """Forward change lines as envelope records; ``start_sink`` starts the writing."""
    return start_sink(feed.normalize_feed(lines, wiki))


def run_scorer(
    records: DataFrame,
    model_path: str,
    out_path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Score envelope records with a saved model into an append-only Parquet table."""
    saved = files.load_json(records.sparkSession, model_path)
    model = logreg.LogRegModel.from_dict(saved)
    scored = feed.score_stream(feed.partial_features(feed.parse_envelope(records)), model)
    return endpoints.file_sink(scored, out_path, checkpoint, available_now=available_now)


def run_report(
    spark: SparkSession,
    features_path: str,
    logreg_metrics_path: str,
    kmeans_metrics_path: str,
    mlp_metrics_path: str,
    dashboard_path: str,
    results_target: str,
    results_format: str = "parquet",
    **results_options,
) -> dict:
    """Summary beside the dashboard, and the flat results table."""
    table = files.read_features(spark, features_path)
    lr = files.load_json(spark, logreg_metrics_path)
    km = files.load_json(spark, kmeans_metrics_path)
    nn = files.load_json_optional(spark, mlp_metrics_path)
    summary = report.summary(table, lr, km, nn)
    files.write_summary(spark, summary, dashboard_path)
    rows = [
        {
            "cluster_id": int(cluster),
            "cluster_size": entry["size"],
            **{f"mean_{f}": v for f, v in entry["feature_mean"].items()},
        }
        for cluster, entry in km["cluster_profile"].items()
    ]
    layout = ", ".join(
        ["cluster_id int", "cluster_size bigint"]
        + [f"mean_{f} double" for f in schema.FEATURE_COLS]
    )
    profile = spark.createDataFrame(rows, layout)
    results = report.results_table(profile, lr, km, nn)
    files.write_results(results, results_target, results_format, **results_options)
    return summary
