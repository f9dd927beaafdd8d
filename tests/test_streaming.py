import json

import pytest
from pyspark.sql import functions as F

from checks import raw
from holdfast import schema
from holdfast.config import FeatureSpec, LogRegSpec
from holdfast.operators import features, logreg
from holdfast.plans import jobs
from holdfast.sources import files, views
from holdfast.streaming import endpoints, feed
from holdfast.streaming.first_edits import first_edits_stream, keep_state_on_disk
from holdfast.workspace import new_path

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def model(spark):
    return logreg.fit(
        features.editor_features(views.orders_as_edits(spark, SF_SMALL)), LogRegSpec(epochs=2)
    )


def lines(spark, *objects):
    texts = [o if isinstance(o, str) else json.dumps(o) for o in objects]
    return spark.createDataFrame([(t,) for t in texts], "value string")


EDIT = {
    "wiki": "w",
    "type": "edit",
    "bot": False,
    "user": "u",
    "title": "t",
    "namespace": 1,
    "timestamp": 1700000000,
    "length": {"old": 50, "new": 20},
    "comment": "c",
    "minor": True,
    "tags": ["x", "mw-revert"],
}


def envelopes(spark, *objects):
    return feed.parse_envelope(feed.normalize_feed(lines(spark, *objects), "w")).collect()


def test_envelope_fields(spark):
    (got,) = envelopes(spark, EDIT)
    assert got.asDict() == {
        "user": "u",
        "title": "t",
        "namespace": 1,
        "ts": 1700000000,
        "bytes_diff": -30,
        "comment": "c",
        "minor": 1,
        "is_revert": 1,
        "corrupt": False,
    }


def test_envelope_defaults(spark):
    (got,) = envelopes(spark, {"wiki": "w", "type": "edit", "user": "u"})
    assert (got.namespace, got.ts, got.bytes_diff, got.comment) == (0, 0, 0, "")
    assert (got.minor, got.is_revert, got.title) == (0, 0, None)


@pytest.mark.parametrize(
    "fields, expected",
    [
        ({"minor": 1}, {"minor": 1}),
        ({"minor": 0}, {"minor": 0}),
        ({"timestamp": 1700000000.0}, {"ts": 1700000000}),
        ({"timestamp": "1700000001"}, {"ts": 1700000001}),
        ({"namespace": "1"}, {"namespace": 1}),
        ({"namespace": None}, {"namespace": 0}),
        ({"length": {"old": 1, "new": 2.0}}, {"bytes_diff": 1}),
        ({"length": {"new": "9"}}, {"bytes_diff": 9}),
        ({"length": None}, {"bytes_diff": 0}),
        ({"tags": "mw-revert"}, {"is_revert": 1}),
        ({"tags": []}, {"is_revert": 0}),
        ({"tags": ["mw-reverted"]}, {"is_revert": 0}),
        ({"bot": 0}, {}),
        ({"bot": ""}, {}),
    ],
)
def test_fields_of_other_types_are_kept(spark, fields, expected):
    (got,) = envelopes(spark, {**EDIT, **fields})
    assert {k: got[k] for k in expected} == expected and not got.corrupt


def test_skipped_lines_are_counted(spark):
    counts = feed.feed_counts(lines(spark, EDIT, "{broken", {**EDIT, "bot": 1}, "")).first()
    assert (counts["lines"], counts.unreadable) == (4, 2)


def test_hour_of_the_stream_does_not_depend_on_the_time_zone(spark):
    parsed = feed.parse_envelope(feed.normalize_feed(lines(spark, EDIT), "w"))
    hours = []
    try:
        for zone in ("America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            hours.append(feed.partial_features(parsed).first().peak_hour_sin)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hours[0] == hours[1]


def test_feed_drops_other_edits(spark):
    dropped = [{**EDIT, "bot": True}, {**EDIT, "bot": 1}, {**EDIT, "wiki": "x"}, {**EDIT, "type": "new"}, "{broken"]
    assert envelopes(spark, *dropped) == []


def test_corrupt_records_are_flagged_and_scored_as_unknown(spark, model):
    parsed = feed.parse_envelope(lines(spark, '{"user": broken'))
    assert parsed.first().corrupt
    partial = feed.partial_features(parsed)
    row = feed.score_stream(partial, model).first()
    assert row.user is None and 0 <= row.dropout_risk <= 1
    assert feed.score_stream(partial, model, keep_corrupt=False).count() == 0


def test_partial_features(spark):
    parsed = feed.parse_envelope(feed.normalize_feed(lines(spark, EDIT), "w"))
    got = feed.partial_features(parsed).first()
    assert (got.avg_bytes_added, got.avg_bytes_removed, got.first_edit_size) == (0.0, 30.0, 0.0)
    assert (got.revert_rate, got.talk_page_ratio, got.session_count) == (1.0, 1.0, 1.0)
    assert (got.velocity, got.namespace_diversity, got.weekend_ratio) == (0.0, 0.0, 0.0)


def test_scored_stream_equals_batch_and_resumes(spark, model, tmp_path):
    """Two arrivals, two runs with one checkpoint: every record is scored once."""
    table = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    records = feed.normalize_feed(raw.events_as_changes(table), "mainwiki")
    arrivals, out, checkpoint, saved = (str(tmp_path / n) for n in ("in", "out", "check", "model"))
    files.save_json(spark, model.to_dict(), saved)
    for part in (0, 1):
        records.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == part).write.mode("append").text(
            arrivals
        )
        endpoints.run_to_end(
            jobs.run_scorer(
                endpoints.text_source(spark, arrivals), saved, out, checkpoint, available_now=True
            )
        )
    got = spark.read.parquet(out)
    want = feed.score_stream(feed.partial_features(feed.parse_envelope(records)), model)
    assert [f.name for f in got.schema] == schema.SCORED.fieldNames()
    assert sorted(got.collect()) == sorted(want.collect())


def test_feed_job_writes_through_any_sink(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines(spark, EDIT, "{broken", {**EDIT, "user": "v"}).write.text(source)
    query = jobs.run_feed(
        endpoints.text_source(spark, source),
        "w",
        lambda records: endpoints.file_sink(
            records, out, str(tmp_path / "check"), format="text", available_now=True
        ),
    )
    endpoints.run_to_end(query)
    assert {json.loads(r.value)["user"] for r in spark.read.text(out).collect()} == {"u", "v"}


@pytest.fixture
def on_disk(spark):
    keep_state_on_disk(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_first_edits_need_a_store_on_disk(spark):
    with pytest.raises(RuntimeError, match="RocksDB"):
        first_edits_stream(views.events_as_edits(spark, SF_SMALL), 3)


@pytest.mark.parametrize("shards", [1, 3])
def test_first_edits_of_a_shuffled_stream_equal_the_batch(spark, tmp_path, on_disk, shards):
    """Edits arrive out of order, in several batches."""
    spec = FeatureSpec(horizon_days=1)
    edits = views.events_as_edits(spark, SF_SMALL)
    arrivals = str(tmp_path / "in")
    edits.repartition(4, F.xxhash64("revision_id")).write.parquet(arrivals)
    stream = endpoints.table_source(
        spark, arrivals, "*.parquet", edits.schema, maxFilesPerTrigger=1
    )
    out = new_path(spark, "first")
    endpoints.run_to_end(
        endpoints.file_sink(
            first_edits_stream(stream, spec.window + 1, shards),
            out,
            str(tmp_path / "check"),
            available_now=True,
        )
    )
    kept = spark.read.schema(schema.CLEAN).parquet(out)
    assert kept.count() < edits.count()
    want = sorted(features.editor_features(edits, spec).collect())
    assert sorted(features.editor_features(kept, spec).collect()) == want


def test_missing_revision_ids_and_evicted_editors(spark, tmp_path, on_disk):
    """Ids that are NULL order as in the batch job, and state that was dropped costs rows only."""
    spec = FeatureSpec(horizon_days=1, window=3)
    edits = views.events_as_edits(spark, SF_SMALL).withColumn(
        "revision_id",
        F.when(F.xxhash64("revision_id") % 3 != 0, F.col("revision_id")),
    )
    arrivals, out = str(tmp_path / "in"), str(tmp_path / "out")
    days = edits.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()
    assert len(days) > 20
    for day in days:  # one file a day, in the order of time
        edits.filter(F.to_date("ts") == F.lit(day.d)).coalesce(1).write.mode("append").parquet(arrivals)
    stream = endpoints.table_source(
        spark, arrivals, "*.parquet", edits.schema, maxFilesPerTrigger=1
    )
    kept = first_edits_stream(stream, spec.window + 1, idle_days=2)
    sink = endpoints.file_sink(kept, out, str(tmp_path / "check"), available_now=True)
    endpoints.run_to_end(sink)
    kept = spark.read.schema(schema.CLEAN).parquet(out)
    want = sorted(features.editor_features(edits, spec).collect())
    assert sorted(features.editor_features(kept, spec).collect()) == want


def held_keys(spark, checkpoint):
    """(editor, number of edits held) of the state that a finished stream left."""
    state = spark.read.format("statestore").option("stateVarName", "first").load(checkpoint)
    rows = state.select("key.event_user_id", F.size("value.micros").alias("n")).collect()
    return sorted(tuple(r) for r in rows)


def test_state_ends_with_the_watermark_and_moves_with_later_edits(spark, tmp_path, on_disk):
    """u: one edit. v: an edit as old, and one that moves its end. w: brings the watermark on."""
    arrivals, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for user, ts in (
        ("u", "2020-01-01 00:00:00"),
        ("v", "2020-01-01 00:00:00"),
        ("v", "2020-01-02 00:00:00"),
        ("w", "2020-01-04 12:00:00"),
        ("w", "2020-01-04 13:00:00"),
    ):
        edits = spark.sql(f"SELECT '{user}' AS event_user_id, TIMESTAMP '{ts}' AS ts, '1' AS revision_id, 7 AS more")
        edits.coalesce(1).write.mode("append").parquet(arrivals)

    def run():
        stream = endpoints.table_source(
            spark, arrivals, "*.parquet", edits.schema, maxFilesPerTrigger=1
        )
        kept = first_edits_stream(stream, 3, shards=1, idle_days=3)
        endpoints.run_to_end(endpoints.file_sink(kept, out, check, available_now=True))

    run()
    assert held_keys(spark, check) == [("v", 2), ("w", 2)]
    edits = edits.withColumn("ts", F.expr("ts + INTERVAL 20 DAYS"))
    edits.coalesce(1).write.mode("append").parquet(arrivals)
    run()
    assert held_keys(spark, check) == [("w", 3)]
    assert spark.read.schema(edits.schema).parquet(out).count() == 6


def test_an_editor_with_many_edits_keeps_the_first_of_them(spark, tmp_path, on_disk):
    """A third of all rows are of one editor; equal keys are kept once each, up to the limit."""
    arrivals, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id % 500) END AS event_user_id",
        "timestamp_seconds(1600000000 + pmod(xxhash64(id), 1000)) AS ts",
        "string(id % 40) AS revision_id",
        "id AS more",
    ).repartition(3, "more").write.parquet(arrivals)
    edits = spark.read.parquet(arrivals)
    stream = endpoints.table_source(
        spark, arrivals, "*.parquet", edits.schema, maxFilesPerTrigger=1
    )
    kept = first_edits_stream(stream, 5, shards=2)
    endpoints.run_to_end(endpoints.file_sink(kept, out, check, available_now=True))

    def first(rows):
        keys = {}
        for r in rows:
            key = (r.ts, len(r.revision_id), r.revision_id)
            keys.setdefault(r.event_user_id, []).append(key)
        return {user: sorted(k)[:5] for user, k in keys.items()}

    rows = spark.read.schema(edits.schema).parquet(out).collect()
    assert first(rows) == first(edits.collect())
    assert sum(r.event_user_id == "hot" for r in rows) <= 3 * 2 * 5


def test_a_trigger_by_time_takes_what_has_arrived_since(spark, tmp_path):
    """Two triggers of one running query, each with what lay in the folder when it fired."""
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    lines(spark, "one").coalesce(1).write.mode("append").text(source)
    query = endpoints.file_sink(
        endpoints.text_source(spark, source), out, check, format="text", trigger="1 second"
    )
    try:
        query.processAllAvailable()
        assert [r.value for r in spark.read.text(out).collect()] == ["one"]
        lines(spark, "two", "three").coalesce(1).write.mode("append").text(source)
        query.processAllAvailable()
        assert sorted(r.value for r in spark.read.text(out).collect()) == ["one", "three", "two"]
        starts = [p["timestamp"] for p in query.recentProgress if p["numInputRows"]]
        assert len(starts) == 2 and starts[0] < starts[1]
    finally:
        query.stop()
