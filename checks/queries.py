"""Every operator as a query over the given tables.

Queries call the library as a user would. ``tidy`` only makes results comparable with
another engine: integers as bigint, times as microseconds, doubles to six places.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import raw
from holdfast import schema
from holdfast.config import FeatureSpec, KMeansSpec, LogRegSpec, MLPSpec
from holdfast.functions.edits import gap_seconds, starts_session
from holdfast.operators import (
    clean,
    evaluate,
    features,
    kmeans,
    logreg,
    mlp,
    ranking,
    survival,
    vectors,
)
from holdfast.plans import jobs, report
from holdfast.sources import files, manifest, views
from holdfast.streaming import endpoints, feed, framing
from holdfast.streaming.first_edits import first_edits_stream, keep_state_on_disk
from holdfast.workspace import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]

USER = "event_user_id"
WINDOW = 10
EVENT_SPEC = FeatureSpec(horizon_days=1)
LOGREG, KMEANS = LogRegSpec(), KMeansSpec()
THREE_EPOCHS = LogRegSpec(epochs=3)
# The batch follows from the number of rows, so that six epochs go once through the table and
# the seventh begins again.
IN_TURNS = LogRegSpec(epochs=7, batches=100)
# Tolerances below any possible change: always three iterations.
THREE_ITERATIONS = KMeansSpec(iters=3, shift_tol=0.0, cost_tol=0.0)
# Networks that SQL can follow: no dropout. First, all rows in one batch, one step an epoch.
ONE_COPY = MLPSpec(
    hidden=(4, 3), dropout=0.0, epochs=3, batch=10**9, workers=1, validation_split=0.0
)
TWO_COPIES = replace(ONE_COPY, workers=2)
# Some steps an epoch, whatever the size of the table (see ``mini_batches``), and a held-out
# share. Two copies hold half of the rows each, so they take three or four steps.
MINI_BATCHES = replace(ONE_COPY, hidden=(3, 2), workers=2, validation_split=0.1)
UNTRAINED = MLPSpec(hidden=(8, 4))
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
CENSOR_AFTER = "1999-06-30 00:00:00"
BASE_URL = "https://history.example.org/dumps"
WIKI, SNAPSHOT = "mainwiki", "2026-03"


def tidy(df: DataFrame) -> DataFrame:
    by_type = {
        "double": "round({0}, 6) + 0D AS {0}",
        "timestamp": "unix_micros({0}) AS {0}",
        "int": "bigint({0}) AS {0}",
    }
    return df.selectExpr(*[by_type.get(kind, "{0}").format(c) for c, kind in df.dtypes])


# Inputs shared by several queries.


def orders(spark, sf_dir):
    return views.orders_as_edits(spark, sf_dir)


def events(spark, sf_dir):
    return views.events_as_edits(spark, sf_dir)


def typed_raw(spark, sf_dir):
    """Orders in the raw layout, as reading them from files would give them."""
    text = raw.orders_as_raw(spark, sf_dir)
    return text.select(
        *[F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.RAW]
    )


def stored_features(spark, sf_dir):
    return materialize(features.editor_features(orders(spark, sf_dir)), "features")


def split(spark, sf_dir):
    return vectors.train_test_split(stored_features(spark, sf_dir))


def fitted_logreg(spark, sf_dir, spec=LOGREG):
    train, test = split(spark, sf_dir)
    if spec == IN_TURNS:
        spec = replace(spec, batch=-(-train.count() // (spec.batches * (spec.epochs - 1))))
    return logreg.fit(train, spec), test


def fitted_kmeans(spark, sf_dir, spec=KMEANS):
    table = stored_features(spark, sf_dir)
    return kmeans.fit(table, spec), table


def fitted_mlp(spark, sf_dir, spec=TWO_COPIES):
    train, test = split(spark, sf_dir)
    return mlp.fit(train, spec), test


# Sources and cleaning.


def landed_history(spark, sf_dir) -> str:
    path = new_path(spark, "raw")
    raw.write_revision_tsv(raw.orders_as_raw(spark, sf_dir, spread=True), path)
    return path


def clean_orders(spark, sf_dir):
    """Raw text files to a partitioned table and back."""
    clean_path = new_path(spark, "clean")
    jobs.run_clean(
        spark,
        landed_history(spark, sf_dir),
        clean_path,
        pattern="*.txt.bz2",
        grouped_by_month=False,
    )
    return tidy(files.read_clean(spark, clean_path))


def clean_orders_as_landed(spark, sf_dir):
    """The same without moving rows: each task writes the months it reads."""
    clean_path = new_path(spark, "clean")
    jobs.run_clean(spark, landed_history(spark, sf_dir), clean_path, pattern="*.txt.bz2")
    return tidy(files.read_clean(spark, clean_path))


def read_revision_tsv(spark, sf_dir):
    """All columns of the layout."""
    path = landed_history(spark, sf_dir)
    return tidy(files.read_revision_tsv(spark, path, pattern="*.txt.bz2"))


def history_with_an_odd_file(spark, sf_dir) -> DataFrame:
    """Raw lines of a folder in which one file has a column too many."""
    path = landed_history(spark, sf_dir)
    odd = raw.orders_as_raw(spark, sf_dir).filter("revision_id % 50 = 0")
    raw.write_revision_tsv(odd.withColumn("new_column", F.lit("new")), path, mode="append")
    return files.read_raw_lines(spark, path, pattern="*.txt.bz2")


def raw_rejects(spark, sf_dir):
    found = files.rejected(history_with_an_odd_file(spark, sf_dir))
    at = schema.RAW.fieldNames().index("revision_id")
    revision = F.split("line", "\t").getItem(at).alias("revision_id")
    return tidy(found.select("first_cell", "cells", revision))


def raw_line_counts(spark, sf_dir):
    return history_with_an_odd_file(spark, sf_dir).agg(*files.line_counts())


def raw_accepted(spark, sf_dir):
    """What is left beside the odd file is read as without it."""
    lines = history_with_an_odd_file(spark, sf_dir)
    return tidy(files.accepted(lines))


def stored_by_status(spark, sf_dir) -> str:
    path = new_path(spark, "by_status")
    files.write_by_status(clean.with_status(history_with_an_odd_file(spark, sf_dir)), path)
    return path


def quarantine_counts(spark, sf_dir):
    path = stored_by_status(spark, sf_dir)
    status = [clean.ACCEPTED, clean.MALFORMED_TIME, clean.REJECTED_LINE]
    counted = [
        files.read_status(spark, path, s).agg(F.lit(s).alias("status"), F.count(F.lit(1)).alias("n"))
        for s in status
    ]
    return functools.reduce(DataFrame.unionAll, counted)


def quarantine_accepted(spark, sf_dir):
    path = stored_by_status(spark, sf_dir)
    return tidy(files.read_status(spark, path, clean.ACCEPTED).drop("time", "line"))


def quarantined(spark, sf_dir):
    """What can be looked into: the text of the time, or of the line."""
    path = stored_by_status(spark, sf_dir)
    times = files.read_status(spark, path, clean.MALFORMED_TIME)
    lines = files.read_status(spark, path, clean.REJECTED_LINE)
    at = schema.RAW.fieldNames().index("revision_id")
    revision = F.split("line", "\t").getItem(at).alias("revision_id")
    cells = F.size(F.split("line", "\t", -1)).cast("bigint").alias("cells")
    found = times.select("revision_id", "time", F.lit(None).cast("bigint").alias("cells"))
    return found.unionByName(lines.select(revision, "time", cells))


def landing_faults(spark, sf_dir):
    """Months up to 1997 are expected, and for those of March a size that is wrong."""
    path = new_path(spark, "landed")
    raw.land_by_month(spark.read.parquet(f"{sf_dir}/orders.parquet"), path)
    until = F.least("last_month", F.lit("1997-12-01").cast("date")).alias("last_month")
    bounds = manifest.observed_bounds(orders(spark, sf_dir)).select("first_month", until)
    expected = manifest.month_manifest(bounds, BASE_URL, WIKI, SNAPSHOT).withColumn(
        "size", F.when(F.col("month") == 3, F.lit(1).cast("bigint")).otherwise(F.col("size"))
    )
    landed = manifest.landed_files(spark, path, r"ym=(\d{4})-(\d{2})/")
    faults = manifest.landing_faults(expected, landed)
    return tidy(faults.select("fault", "year", "month", "bytes"))


def clean_month_range(spark, sf_dir):
    path = new_path(spark, "clean")
    files.write_clean(clean.clean(typed_raw(spark, sf_dir)), path)
    months = files.read_clean(spark, path, start=(1996, 3), end=(1998, 2))
    return tidy(months.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")))


def parse_ts_year_month(spark, sf_dir):
    parsed = clean.parse_time(typed_raw(spark, sf_dir))
    return tidy(parsed.select("revision_id", "ts", "year", "month"))


def only_revision_ids(op) -> Query:
    return lambda spark, sf_dir: op(typed_raw(spark, sf_dir)).select("revision_id")


def month_manifest(spark, sf_dir):
    bounds = manifest.observed_bounds(orders(spark, sf_dir))
    return tidy(manifest.month_manifest(bounds, BASE_URL, WIKI, SNAPSHOT))


def month_missing(spark, sf_dir):
    landed = orders(spark, sf_dir).unionByName(events(spark, sf_dir))
    expected = manifest.month_manifest(
        manifest.observed_bounds(landed), BASE_URL, WIKI, SNAPSHOT
    )
    return tidy(manifest.missing_months(expected, landed).select("year", "month", "url"))


# Ranking.


def edit_rank(spark, sf_dir):
    ranked = ranking.edit_rank(orders(spark, sf_dir))
    return tidy(ranked.select(USER, "revision_id", "edit_rank"))


def edit_rank_events(spark, sf_dir):
    ranked = ranking.edit_rank(events(spark, sf_dir), slices=50)
    return tidy(ranked.select(USER, "revision_id", "edit_rank"))


def first_window(spark, sf_dir):
    first = ranking.first_window(orders(spark, sf_dir), WINDOW)
    return tidy(first.select(USER, "revision_id", "ts", "edit_rank"))


def post_window(spark, sf_dir):
    after = ranking.post_window(orders(spark, sf_dir), WINDOW)
    return tidy(after.select(USER, "revision_id", "ts"))


def session_gaps(spark, sf_dir):
    edits = ranking.with_neighbours(events(spark, sf_dir), WINDOW)
    return tidy(
        edits.selectExpr(
            USER,
            "revision_id",
            f"{gap_seconds('ts', 'prev_ts')} / 60D AS gap_minutes",
            f"{starts_session(FeatureSpec())} AS new_session",
        )
    )


# Features. Selecting a feature prunes the work of the others.


def profile_of(source, *columns: str, spec: FeatureSpec = FeatureSpec()) -> Query:
    return lambda spark, sf_dir: tidy(
        features.editor_profile(source(spark, sf_dir), spec).select(USER, *columns)
    )


def features_of(source, spec: FeatureSpec = FeatureSpec()) -> Query:
    return lambda spark, sf_dir: tidy(features.editor_features(source(spark, sf_dir), spec))


def stored_feature_table(spark, sf_dir):
    path = new_path(spark, "features")
    files.write_features(features.editor_features(orders(spark, sf_dir)), path)
    return tidy(files.read_features(spark, path))


def feature_vector(spark, sf_dir):
    """The vector column, one row per entry."""
    vector = features.with_vector(features.editor_features(orders(spark, sf_dir)))
    entries = vector.select(USER, F.posexplode("features").alias("position", "value"))
    return tidy(entries)


def standardize_stats(spark, sf_dir):
    train, _ = vectors.train_test_split(features.editor_features(orders(spark, sf_dir)))
    return tidy(vectors.standardize_stats(train))


def train_test_split(spark, sf_dir):
    table = features.editor_features(orders(spark, sf_dir))
    return table.select(USER, vectors.in_train().alias("in_train"))


def sample_fraction(spark, sf_dir):
    table = features.editor_features(orders(spark, sf_dir))
    return vectors.sample_rows(table, 0.25, seed=7).select(USER)


def scaled_features(spark, sf_dir):
    train, test = split(spark, sf_dir)
    return tidy(vectors.scaled_features(test, vectors.fit_scaler(train), [USER, "dropout"]))


# Logistic regression and evaluation.


def weights_frame(spark, saved: dict) -> DataFrame:
    rows = [("intercept", saved["intercept"]), *saved["weights"].items()]
    return tidy(spark.createDataFrame(rows, "feature string, weight double"))


def logreg_weights_of(spec) -> Query:
    def query(spark, sf_dir):
        model, _ = fitted_logreg(spark, sf_dir, spec)
        return weights_frame(spark, model.to_dict())

    return query


def logreg_loss_of(spec) -> Query:
    def query(spark, sf_dir):
        model, _ = fitted_logreg(spark, sf_dir, spec)
        rows = [(h["epoch"], h["rows"], h["log_loss"]) for h in model.history]
        return tidy(spark.createDataFrame(rows, "epoch int, n bigint, log_loss double"))

    return query


def model_json(spark, sf_dir):
    """The model after a round trip through its saved form."""
    model, _ = fitted_logreg(spark, sf_dir)
    path = new_path(spark, "model")
    files.save_json(spark, model.to_dict(), path)
    table = files.load_json_frame(spark, path, schema.LOGREG_MODEL)
    weights = table.select(F.explode("weights").alias("feature", "weight"))
    intercept = table.select(F.lit("intercept").alias("feature"), F.col("intercept"))
    return tidy(weights.union(intercept))


def logreg_scores(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    return tidy(model.score(test).select(USER, "dropout", "score"))


def predictions(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    return tidy(
        model.score(test).select(USER, "dropout", evaluate.predicted().alias("predicted"))
    )


def class_split(spark, sf_dir):
    """Test rows of each class per distinct (rounded) score."""
    model, test = fitted_logreg(spark, sf_dir)
    scored = model.score(test).withColumn("score", F.round("score", 6))
    return evaluate.score_counts(scored)


def confusion_matrix(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    return evaluate.confusion_matrix(evaluate.score_counts(model.score(test)))


def auc_roc(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    counts = materialize(evaluate.score_counts(model.score(test)), "score_counts")
    return tidy(evaluate.auc_roc(counts))


def auc_roc_many_slices(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    counts = materialize(evaluate.score_counts(model.score(test)), "score_counts")
    return tidy(evaluate.auc_roc(counts, slices=700))


def missing_scores(spark, sf_dir):
    """Metrics where every third score is missing, as NULL or as NaN."""
    model, test = fitted_logreg(spark, sf_dir)
    digit = F.substring(F.col(USER), -1, 1).cast("int")
    missing = F.when(digit % 3 == 0, F.lit(None)).when(digit == 1, F.lit(float("nan")))
    scored = model.score(test).withColumn(
        "score", F.when(digit % 3 == 0, missing).when(digit == 1, missing).otherwise(F.col("score"))
    )
    return tidy(evaluate.evaluate_binary(scored))


def binary_metrics(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    return tidy(evaluate.evaluate_binary(model.score(test)))


def mlp_scores(spark, sf_dir):
    """The forward pass with seeded weights, over all rows."""
    table = stored_features(spark, sf_dir)
    scaler = vectors.fit_scaler(table)
    weights = mlp.initial_weights(len(schema.FEATURE_COLS), UNTRAINED)
    model = mlp.MLPModel(scaler, weights, UNTRAINED.hidden)
    return tidy(model.score(table).select(USER, "score"))


def mlp_weights_of(spec) -> Query:
    def query(spark, sf_dir):
        model, _ = fitted_mlp(spark, sf_dir, spec)
        rows = [(i, float(w)) for i, w in enumerate(model.weights)]
        return tidy(spark.createDataFrame(rows, "id int, weight double"))

    return query


def mlp_weights_mini_batches(spark, sf_dir):
    train, _ = split(spark, sf_dir)
    model = mlp.fit(train, replace(MINI_BATCHES, batch=-(-train.count() // 6)))
    rows = [(i, float(w)) for i, w in enumerate(model.weights)]
    return tidy(spark.createDataFrame(rows, "id int, weight double"))


def mlp_default_history(spark, sf_dir):
    """Losses of each epoch of the network as it ships, on training and held-out rows."""
    train, _ = split(spark, sf_dir)
    model = mlp.fit(train, MLPSpec())
    rows = [(h["epoch"], h["log_loss"], h["val_log_loss"]) for h in model.history]
    return tidy(
        spark.createDataFrame(rows, "epoch int, log_loss double, val_log_loss double")
    )


def mlp_metrics(spark, sf_dir):
    model, test = fitted_mlp(spark, sf_dir)
    return tidy(evaluate.evaluate_binary(model.score(test)))


# Clustering.


def kmeans_init(spark, sf_dir):
    table = features.editor_features(orders(spark, sf_dir))
    return vectors.pick_rows(table, 4, seed=7).select(USER)


def kmeans_centers_of(spec) -> Query:
    def query(spark, sf_dir):
        model, _ = fitted_kmeans(spark, sf_dir, spec)
        return tidy(kmeans.centers_frame(spark, model))

    return query


def kmeans_iterations(spark, sf_dir):
    """After how many iterations the fit stopped by itself."""
    model, _ = fitted_kmeans(spark, sf_dir)
    return spark.createDataFrame([(model.iterations,)], "iterations bigint")


def kmeans_assign(spark, sf_dir):
    model, table = fitted_kmeans(spark, sf_dir)
    return tidy(model.assign(table).select(USER, "cluster", "nearest", "second"))


def wcss(spark, sf_dir):
    """Cost of the final centers, and the cost one iteration earlier."""
    model, table = fitted_kmeans(spark, sf_dir)
    cost = kmeans.wcss(model.assign(table))
    return cost.select(
        F.round("wcss", 3).alias("wcss"),
        F.round(F.lit(model.lagged_cost), 3).alias("wcss_lagged"),
    )


def silhouette(spark, sf_dir):
    """That of all points by all points, and the one by centers."""
    model, table = fitted_kmeans(spark, sf_dir)
    assigned = model.assign(table)
    simplified = kmeans.simplified_silhouette(assigned).toDF("simplified")
    return tidy(kmeans.silhouette(assigned, model.scaler).join(simplified))


def simplified_silhouette(spark, sf_dir):
    model, table = fitted_kmeans(spark, sf_dir)
    return tidy(kmeans.simplified_silhouette(model.assign(table)))


def cluster_profile(spark, sf_dir):
    model, table = fitted_kmeans(spark, sf_dir)
    return tidy(kmeans.cluster_profile(model.assign(table)))


# The live feed.


def landed_changes(spark, sf_dir) -> str:
    path = new_path(spark, "changes")
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    raw.events_as_changes(table).write.text(path)
    return path


def run_feed(spark, sf_dir) -> str:
    """The forwarding job, over all lines that have landed."""
    lines = endpoints.text_source(spark, landed_changes(spark, sf_dir))
    out = new_path(spark, "envelopes")
    endpoints.run_to_end(
        endpoints.file_sink(
            feed.normalize_feed(lines, "mainwiki"),
            out,
            new_path(spark, "checkpoint"),
            format="text",
            available_now=True,
        )
    )
    return out


def run_on_envelopes(spark, sf_dir, transform) -> DataFrame:
    records = endpoints.text_source(spark, run_feed(spark, sf_dir))
    out = new_path(spark, "stream_out")
    result = transform(feed.parse_envelope(records))
    endpoints.run_to_end(
        endpoints.file_sink(result, out, new_path(spark, "checkpoint"), available_now=True)
    )
    return spark.read.schema(result.schema).parquet(out)


def feed_filter(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    changes = feed.parse_changes(raw.events_as_changes(table))
    return feed.feed_filter(changes, "mainwiki").select("title", "wiki", "type")


def feed_envelope(spark, sf_dir):
    return tidy(run_on_envelopes(spark, sf_dir, lambda envelopes: envelopes))


def landed_blocks(spark, sf_dir) -> str:
    """Blocks of the framed feed; after a break, some come again."""
    path = new_path(spark, "blocks")
    blocks = raw.events_as_blocks(spark.read.parquet(f"{sf_dir}/events.parquet"))
    raw.land_blocks(blocks, path)
    raw.land_blocks(blocks.filter("event_id % 20 IN (3, 9)"), path)
    return path


def feed_framed(spark, sf_dir):
    """From blocks to envelopes: what came twice counts once, if it has an id."""
    blocks = framing.framed_source(spark, landed_blocks(spark, sf_dir))
    changes = framing.messages(framing.parse_events(blocks))
    lines = framing.without_replays(changes, delay="60 days")
    out = new_path(spark, "envelopes")
    result = feed.parse_envelope(feed.normalize_feed(lines, "mainwiki"))
    endpoints.run_to_end(
        endpoints.file_sink(result, out, new_path(spark, "checkpoint"), available_now=True)
    )
    return tidy(spark.read.schema(result.schema).parquet(out))


def feed_events(spark, sf_dir):
    """Every event with its type and id."""
    events = framing.parse_events(framing.read_framed(spark, landed_blocks(spark, sf_dir)))
    title = F.get_json_object("data", "$.title").alias("title")
    return events.select("id", "event", title)


def feed_resume_point(spark, sf_dir):
    blocks = framing.read_framed(spark, landed_blocks(spark, sf_dir))
    return framing.resume_point(framing.parse_events(blocks))


def feed_coerced(spark, sf_dir):
    """Lines whose fields come as numbers, texts and flags of other kinds than usual."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = raw.events_as_odd_changes(table)
    return tidy(feed.parse_envelope(feed.normalize_feed(lines, "mainwiki")))


def feed_counts(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return feed.feed_counts(raw.events_as_changes(table))


def stream_malformed(spark, sf_dir):
    """Envelopes that are broken, or lack fields: scored with 0 for what is not known."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    parsed = feed.parse_envelope(raw.events_as_bad_envelopes(table))
    model = logreg.LogRegModel.from_dict(raw.PLAIN_MODEL)
    return tidy(feed.score_stream(feed.partial_features(parsed), model))


def stream_partial_features(spark, sf_dir):
    return tidy(run_on_envelopes(spark, sf_dir, feed.partial_features).drop("corrupt"))


def stream_scores(spark, sf_dir):
    model, _ = fitted_logreg(spark, sf_dir)
    return tidy(
        run_on_envelopes(
            spark, sf_dir, lambda e: feed.score_stream(feed.partial_features(e), model)
        )
    )


def stream_scores_table(spark, sf_dir):
    """Scores in a catalogue table, a few files a batch."""
    model, _ = fitted_logreg(spark, sf_dir)
    records = endpoints.text_source(spark, run_feed(spark, sf_dir), maxFilesPerTrigger=3)
    scores = feed.score_stream(feed.partial_features(feed.parse_envelope(records)), model)
    path = new_path(spark, "table")
    table = f"scored_{path.split('/')[-2]}"
    endpoints.run_to_end(
        endpoints.table_sink(
            scores, table, new_path(spark, "checkpoint"), available_now=True, path=path
        )
    )
    return tidy(endpoints.read_table(spark, table).drop("batch_id"))


def stream_first_features(spark, sf_dir):
    """First edits kept by a stateful stream, then the batch feature job on what it kept."""
    store = spark.conf.get(STATE_STORE)
    keep_state_on_disk(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = endpoints.table_source(spark, sf_dir, "events.parquet", table.schema)
    out = new_path(spark, "first_edits")
    try:
        kept = first_edits_stream(views.events_to_edits(stream), EVENT_SPEC.window + 1)
        endpoints.run_to_end(
            endpoints.file_sink(kept, out, new_path(spark, "checkpoint"), available_now=True)
        )
    finally:
        spark.conf.set(STATE_STORE, store)  # other streams of the session choose their own
    edits = spark.read.schema(schema.CLEAN).parquet(out)
    return tidy(features.editor_features(edits, EVENT_SPEC))


# Reports.


def cohort_summary(spark, sf_dir):
    return tidy(report.cohort_summary(features.editor_features(orders(spark, sf_dir))))


def model_metrics(spark, sf_dir) -> dict:
    model, test = fitted_logreg(spark, sf_dir)
    return jobs.logreg_metrics(model, model.score(test), LOGREG)


def network_metrics(spark, sf_dir) -> dict:
    model, test = fitted_mlp(spark, sf_dir)
    return jobs.mlp_metrics(model, model.score(test), TWO_COPIES)


def model_compare(spark, sf_dir):
    metrics = [model_metrics(spark, sf_dir), None]
    return tidy(report.model_compare(spark, metrics).drop("train_seconds"))


def model_compare_both(spark, sf_dir):
    metrics = [model_metrics(spark, sf_dir), network_metrics(spark, sf_dir)]
    return tidy(report.model_compare(spark, metrics).drop("train_seconds"))


def panel_auc(spark, sf_dir):
    metrics = [model_metrics(spark, sf_dir), None]
    return tidy(report.panel_auc(report.model_compare(spark, metrics)))


def panel_auc_both(spark, sf_dir):
    metrics = [model_metrics(spark, sf_dir), network_metrics(spark, sf_dir)]
    return tidy(report.panel_auc(report.model_compare(spark, metrics)))


def optional_metrics(spark, sf_dir):
    """Saved metrics are found again, others are reported as absent."""
    path = new_path(spark, "metrics")
    files.save_json(spark, model_metrics(spark, sf_dir), path)
    rows = []
    for name, at in (("saved", path), ("absent", path + "-absent")):
        found = files.load_json_optional(spark, at)
        rows.append((name, found is not None, found and found["n_train"]))
    return spark.createDataFrame(rows, "name string, found boolean, n_train bigint")


def panel_confusion(spark, sf_dir):
    return tidy(report.panel_confusion(confusion_matrix(spark, sf_dir)))


def panel_cluster_sizes(spark, sf_dir):
    model, table = fitted_kmeans(spark, sf_dir)
    return tidy(report.panel_cluster_sizes(kmeans.cluster_profile(model.assign(table))))


def panel_revert_vs_velocity(spark, sf_dir):
    model, table = fitted_kmeans(spark, sf_dir)
    return tidy(report.panel_revert_vs_velocity(kmeans.cluster_profile(model.assign(table))))


def fitted_all(spark, sf_dir, with_network: bool):
    """The feature table, cluster profile, and metrics of each model."""
    table = stored_features(spark, sf_dir)
    train, test = vectors.train_test_split(table)
    lr = logreg.fit(train, LOGREG)
    km = kmeans.fit(table, KMEANS)
    assigned = km.assign(table)
    nn = None
    if with_network:
        net = mlp.fit(train, TWO_COPIES)
        nn = jobs.mlp_metrics(net, net.score(test), TWO_COPIES)
    return (
        table,
        kmeans.cluster_profile(assigned),
        jobs.logreg_metrics(lr, lr.score(test), LOGREG),
        jobs.kmeans_metrics(km, assigned),
        nn,
    )


def results_table_of(with_network: bool) -> Query:
    """Written and read back; training times differ per run and are left out here."""

    def query(spark, sf_dir):
        _, profile, lr, km, nn = fitted_all(spark, sf_dir, with_network)
        path = new_path(spark, "results")
        files.write_results(report.results_table(profile, lr, km, nn), path)
        stored = spark.read.schema(schema.RESULTS).parquet(path)
        return tidy(stored.drop("logreg_train_seconds", "kmeans_train_seconds"))

    return query


def summary_of(with_network: bool) -> Query:
    """The summary object, written and read back."""

    def query(spark, sf_dir):
        table, _, lr, km, nn = fitted_all(spark, sf_dir, with_network)
        folder = new_path(spark, "dashboard")
        files.write_summary(spark, report.summary(table, lr, km, nn), folder)
        layout = (
            "n_editors bigint, dropout_rate double, "
            "logreg struct<n_train: bigint, auc_roc: double, confusion: struct<tp: bigint>>, "
            "kmeans struct<k: bigint, silhouette: double>, dnn struct<auc_roc: double>"
        )
        stored = files.load_json_frame(spark, f"{folder}/summary.json", layout)
        more = ["dnn.auc_roc AS dnn_auc_roc"] if with_network else []
        return tidy(
            stored.selectExpr(
                "n_editors",
                "dropout_rate",
                "logreg.n_train AS n_train",
                "logreg.auc_roc AS auc_roc",
                "logreg.confusion.tp AS tp",
                "kmeans.k AS k",
                "kmeans.silhouette AS silhouette",
                *more,
            )
        )

    return query


def survival_curve(spark, sf_dir):
    lifetimes = survival.editor_lifetimes(orders(spark, sf_dir), FeatureSpec().horizon_days)
    return tidy(survival.survival_curve(lifetimes))


def top_risk(spark, sf_dir):
    model, test = fitted_logreg(spark, sf_dir)
    scored = model.score(test).withColumn("score", F.round("score", 6))
    return tidy(report.top_risk(scored, 20).select(USER, "score"))


def top_risk_by_archetype(spark, sf_dir):
    table = stored_features(spark, sf_dir)
    train, _ = vectors.train_test_split(table)
    scored = logreg.fit(train, LOGREG).score(table).withColumn("score", F.round("score", 6))
    placed = report.top_risk_by_archetype(kmeans.fit(table, KMEANS).assign(scored), 5)
    return tidy(placed.select("cluster", "place", USER, "score"))


QUERIES: dict[str, Query] = {
    "read_revision_tsv": read_revision_tsv,
    "only_revisions": only_revision_ids(clean.only_revisions),
    "drop_bots": only_revision_ids(clean.drop_bots),
    "drop_anonymous": only_revision_ids(clean.drop_anonymous),
    "keep_namespaces": only_revision_ids(clean.keep_namespaces),
    "parse_ts_year_month": parse_ts_year_month,
    "raw_rejects": raw_rejects,
    "raw_line_counts": raw_line_counts,
    "raw_accepted": raw_accepted,
    "quarantine_counts": quarantine_counts,
    "quarantine_accepted": quarantine_accepted,
    "quarantined": quarantined,
    "clean_orders": clean_orders,
    "clean_orders_as_landed": clean_orders_as_landed,
    "clean_month_range": clean_month_range,
    "month_manifest": month_manifest,
    "month_missing": month_missing,
    "landing_faults": landing_faults,
    "edit_rank": edit_rank,
    "edit_rank_events": edit_rank_events,
    "first_window": first_window,
    "post_window": post_window,
    "session_gaps": session_gaps,
    "window_bounds": profile_of(orders, "first_ts", "last_window_ts", "window_edits"),
    "velocity": profile_of(orders, "velocity"),
    "revert_rate": profile_of(orders, "revert_rate"),
    "namespace_diversity": profile_of(orders, "namespace_diversity"),
    "bytes_added_removed": profile_of(orders, "avg_bytes_added", "avg_bytes_removed"),
    "talk_page_ratio": profile_of(orders, "talk_page_ratio"),
    "peak_hour": profile_of(events, "peak_hour", "peak_hour_sin", "peak_hour_cos"),
    "weekend_ratio": profile_of(orders, "weekend_ratio"),
    "edit_summary_rate": profile_of(orders, "edit_summary_rate"),
    "minor_edit_ratio": profile_of(orders, "minor_edit_ratio"),
    "session_count": profile_of(events, "session_count"),
    "first_edit_size": profile_of(orders, "first_edit_size"),
    "dropout_label": profile_of(orders, "dropout"),
    "editor_features": features_of(orders),
    "editor_features_window_5": features_of(orders, FeatureSpec(window=5)),
    "editor_features_full_window": features_of(orders, FeatureSpec(require_full_window=True)),
    "editor_features_censored": features_of(orders, FeatureSpec(censor_after=CENSOR_AFTER)),
    "event_user_features": features_of(events, EVENT_SPEC),
    "stored_feature_table": stored_feature_table,
    "feature_vector": feature_vector,
    "standardize_stats": standardize_stats,
    "train_test_split": train_test_split,
    "sample_fraction": sample_fraction,
    "scaled_features": scaled_features,
    "logreg_weights_3ep": logreg_weights_of(THREE_EPOCHS),
    "logreg_loss_3ep": logreg_loss_of(THREE_EPOCHS),
    "logreg_weights": logreg_weights_of(LOGREG),
    "logreg_loss": logreg_loss_of(LOGREG),
    "logreg_weights_in_turns": logreg_weights_of(IN_TURNS),
    "logreg_loss_in_turns": logreg_loss_of(IN_TURNS),
    "model_json": model_json,
    "logreg_scores": logreg_scores,
    "predictions": predictions,
    "class_split": class_split,
    "confusion_matrix": confusion_matrix,
    "auc_roc": auc_roc,
    "binary_metrics": binary_metrics,
    "auc_roc_many_slices": auc_roc_many_slices,
    "missing_scores": missing_scores,
    "mlp_scores": mlp_scores,
    "mlp_weights": mlp_weights_of(ONE_COPY),
    "mlp_weights_two_copies": mlp_weights_of(TWO_COPIES),
    "mlp_weights_mini_batches": mlp_weights_mini_batches,
    "mlp_default_history": mlp_default_history,
    "mlp_metrics": mlp_metrics,
    "kmeans_init": kmeans_init,
    "kmeans_centers_3it": kmeans_centers_of(THREE_ITERATIONS),
    "kmeans_centers": kmeans_centers_of(KMEANS),
    "kmeans_iterations": kmeans_iterations,
    "kmeans_assign": kmeans_assign,
    "wcss": wcss,
    "silhouette": silhouette,
    "simplified_silhouette": simplified_silhouette,
    "cluster_profile": cluster_profile,
    "feed_filter": feed_filter,
    "feed_envelope": feed_envelope,
    "feed_coerced": feed_coerced,
    "feed_framed": feed_framed,
    "feed_events": feed_events,
    "feed_resume_point": feed_resume_point,
    "feed_counts": feed_counts,
    "stream_malformed": stream_malformed,
    "stream_partial_features": stream_partial_features,
    "stream_scores": stream_scores,
    "stream_scores_table": stream_scores_table,
    "stream_first_features": stream_first_features,
    "cohort_summary": cohort_summary,
    "model_compare": model_compare,
    "model_compare_both": model_compare_both,
    "panel_auc": panel_auc,
    "panel_auc_both": panel_auc_both,
    "optional_metrics": optional_metrics,
    "panel_confusion": panel_confusion,
    "panel_cluster_sizes": panel_cluster_sizes,
    "panel_revert_vs_velocity": panel_revert_vs_velocity,
    "results_table": results_table_of(False),
    "results_table_with_network": results_table_of(True),
    "summary": summary_of(False),
    "summary_with_network": summary_of(True),
    "survival_curve": survival_curve,
    "top_risk": top_risk,
    "top_risk_by_archetype": top_risk_by_archetype,
}
