"""Headline timings: one JSON line on standard output.

``python bench.py`` reads ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` (the best of
that many runs counts). ``python bench.py --scaling FEATURES`` trains on a stored feature
table with two and with four cores.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from checks import raw
from checks.queries import QUERIES
from holdfast.config import FeatureSpec, KMeansSpec, LogRegSpec, MLPSpec
from holdfast.operators import evaluate, features, kmeans, logreg, mlp, ranking, vectors
from holdfast.plans import jobs
from holdfast.sources import files, views
from holdfast.workspace import materialize, new_path, use_local_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_folder(spark)
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cases(spark: SparkSession) -> dict:
    """Whole jobs with the default parameters, each over all rows of its table."""
    landed = new_path(spark, "raw")
    # The history comes as one file per month; here, as several files by time.
    history = raw.orders_as_raw(spark, SF_DIR).repartitionByRange(16, "event_timestamp")
    raw.write_revision_tsv(history, landed)
    table = materialize(
        features.editor_features(views.orders_as_edits(spark, SF_DIR)), "features"
    )
    train, test = vectors.train_test_split(table)
    lr = logreg.fit(train, LogRegSpec(epochs=1))

    def clean() -> None:
        jobs.run_clean(spark, landed, new_path(spark, "clean"), pattern="*.txt.bz2")

    def orders() -> DataFrame:
        return views.orders_as_edits(spark, SF_DIR)

    def events() -> DataFrame:
        return views.events_as_edits(spark, SF_DIR)

    return {
        "clean": clean,
        "editor_features": lambda: run(features.editor_features(orders())),
        "event_user_features": lambda: run(
            features.editor_features(events(), FeatureSpec(horizon_days=1))
        ),
        "edit_rank": lambda: run(ranking.edit_rank(orders())),
        "logreg_fit": lambda: logreg.fit(train, LogRegSpec()),
        "evaluate_binary": lambda: run(evaluate.evaluate_binary(lr.score(test))),
        "kmeans_fit": lambda: kmeans.fit(table, KMeansSpec()),
        "mlp_fit": lambda: mlp.fit(train, MLPSpec()),
        "results_table": lambda: run(QUERIES["results_table"](spark, SF_DIR)),
        "stream_scores": lambda: run(QUERIES["stream_scores"](spark, SF_DIR)),
        "stream_first_features": lambda: run(QUERIES["stream_first_features"](spark, SF_DIR)),
        "survival_curve": lambda: run(QUERIES["survival_curve"](spark, SF_DIR)),
    }


def measure() -> dict:
    spark = session()
    seconds = {}
    for name, job in cases(spark).items():
        times = []
        for _ in range(RUNS):
            started = time.monotonic()
            job()
            times.append(time.monotonic() - started)
        seconds[name] = round(min(times), 3)
    spark.stop()
    return {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "runs": RUNS,
    }


def measure_logreg(features_path: str) -> dict:
    """Training time on a stored feature table, the job whose scaling has a target."""
    spark = session()
    train, _ = vectors.train_test_split(files.read_features(spark, features_path))
    model = logreg.fit(train, LogRegSpec())
    spark.stop()
    return {"rows": model.scaler.count, "seconds": round(model.train_seconds, 3)}


def scaling(features_path: str) -> dict:
    """The same training on two and on four cores, each in a process of its own."""
    by_cores = {}
    for cores in ("2", "4"):
        out = subprocess.run(
            [sys.executable, __file__, "--logreg", features_path],
            env={**os.environ, "BENCH_CPUS": cores},
            check=True,
            capture_output=True,
            text=True,
        )
        by_cores[cores] = json.loads(out.stdout.strip().splitlines()[-1])
    saved = 1 - by_cores["4"]["seconds"] / by_cores["2"]["seconds"]
    return {
        "metric": "training_time_saved_from_2_to_4_cores",
        "value": round(saved, 3),
        "unit": "share",
        "cores": by_cores,
    }


if __name__ == "__main__":
    if "--logreg" in sys.argv:
        result = measure_logreg(sys.argv[-1])
    elif "--scaling" in sys.argv:
        result = scaling(sys.argv[-1])
    else:
        result = measure()
    print(json.dumps(result))
