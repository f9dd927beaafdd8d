import bz2
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries, raw
from holdfast import schema
from holdfast.operators import clean
from holdfast.plans import jobs
from holdfast.sources import files, manifest
from holdfast.streaming import endpoints

from .helpers import daily, edits_frame


def raw_line(**cells):
    defaults = {
        "event_entity": "revision",
        "event_timestamp": "2023-05-06 07:08:09.0",
        "event_user_id": "7",
        "event_user_is_anonymous": "false",
        "page_namespace": "0",
        "revision_id": "1",
    }
    known = {**defaults, **cells}
    return "\t".join(known.get(name, "") for name in schema.RAW.fieldNames())


def land(folder, lines, name="2023-05.tsv.bz2"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(bz2.compress(("\n".join(lines) + "\n").encode()))
    return str(folder)


def test_raw_layout_has_seventy_columns():
    assert len(schema.RAW) == 70


def test_cleaning_rules(spark, tmp_path):
    lines = [
        raw_line(revision_id="kept", event_comment='a "quoted" \\ comment'),
        raw_line(revision_id="talk", page_namespace="1"),
        raw_line(revision_id="bot", event_user_is_bot_by="name"),
        raw_line(revision_id="anonymous", event_user_is_anonymous="true"),
        raw_line(revision_id="anonymity unknown", event_user_is_anonymous=""),
        raw_line(revision_id="namespace 2", page_namespace="2"),
        raw_line(revision_id="no namespace", page_namespace=""),
        raw_line(revision_id="user event", event_entity="user"),
        raw_line(revision_id="no time", event_timestamp="junk"),
    ]
    raw = files.read_revision_tsv(spark, land(tmp_path / "raw", lines))
    rows = {r.revision_id: r for r in clean.clean(raw).collect()}
    assert set(rows) == {"kept", "talk", "no time"}
    assert rows["kept"].event_comment == 'a "quoted" \\ comment'
    assert rows["kept"].ts == datetime(2023, 5, 6, 7, 8, 9)
    assert (rows["kept"].year, rows["kept"].month) == (2023, 5)
    assert rows["no time"].ts is None


def test_cells_that_do_not_parse_become_null(spark, tmp_path):
    path = land(tmp_path / "raw", [raw_line(revision_text_bytes="many")])
    assert files.read_revision_tsv(spark, path).first().revision_text_bytes is None


def test_lines_with_other_cells_are_rejected_wherever_they_are(spark, tmp_path):
    """Good lines in one file, and others deep in the second."""
    path = land(tmp_path / "raw", [raw_line(revision_id=f"a{i}") for i in range(500)], "1.tsv.bz2")
    odd = [raw_line(revision_id=f"b{i}") for i in range(40)]
    odd += [raw_line(revision_text_bytes="many") + "\textra", "one cell", "two\tcells"]
    land(tmp_path / "raw", odd, "2.tsv.bz2")
    lines = files.read_raw_lines(spark, path)
    assert files.read_revision_tsv(spark, path).count() == 540
    assert {(r.cells, r.first_cell) for r in files.rejected(lines).collect()} == {
        (71, ""),
        (1, "one cell"),
        (2, "two"),
    }
    with pytest.raises(ValueError, match="3 of 543 lines"):
        jobs.run_clean(spark, path, str(tmp_path / "clean"))
    counts = jobs.run_clean(spark, path, str(tmp_path / "clean"), max_rejected=3)
    assert counts == {"lines": 543, "rejected": 3}
    assert files.read_clean(spark, str(tmp_path / "clean")).count() == 540


def test_jobs_refuse_another_time_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(RuntimeError, match="must be UTC"):
            jobs.run_clean(spark, str(tmp_path), str(tmp_path / "clean"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_jobs_from_raw_files_to_report(spark, tmp_path):
    """All jobs after one another, on files, as they would be scheduled."""
    lines = []
    for user in range(40):
        for i in range(3 + user % 10):
            lines.append(
                raw_line(
                    event_user_id=str(user),
                    revision_id=str(100 * user + i),
                    event_timestamp=f"2023-0{1 + i % 3}-{1 + (user + 2 * i) % 27:02d} "
                    f"{(user + i) % 24:02d}:00:00.0",
                    page_namespace=str((user + i) % 2),
                    revision_text_bytes_diff=str(37 * (user % 5) - 50),
                    revision_minor_edit="true" if i % 2 else "false",
                )
            )
    at = {n: str(tmp_path / n) for n in "clean features dashboard results scored".split()}
    jobs.run_clean(spark, land(tmp_path / "raw", lines), at["clean"])
    jobs.run_features(spark, at["clean"], at["features"])
    paths = {
        m: (str(tmp_path / f"{m}-model"), str(tmp_path / f"{m}-metrics"))
        for m in ("logreg", "kmeans", "mlp")
    }
    lr = jobs.run_logreg(spark, at["features"], *paths["logreg"])
    km = jobs.run_kmeans(spark, at["features"], *paths["kmeans"])
    args = (paths["logreg"][1], paths["kmeans"][1], paths["mlp"][1])
    summary = jobs.run_report(spark, at["features"], *args, at["dashboard"], at["results"])
    assert summary["n_editors"] == 40 and "dnn" not in summary
    assert files.load_json(spark, at["dashboard"] + "/summary.json") == summary
    results = spark.read.parquet(at["results"]).orderBy("cluster_id").collect()
    assert sum(r.cluster_size for r in results) == 40
    assert all(r.model_auc_dnn is None for r in results)
    assert results[0].kmeans_silhouette == km["silhouette"]

    nn = jobs.run_mlp(spark, at["features"], *paths["mlp"])
    assert nn["n_train"] == lr["n_train"]
    summary = jobs.run_report(spark, at["features"], *args, at["dashboard"], at["results"])
    assert summary["dnn"]["epochs"] == 15
    results = spark.read.parquet(at["results"]).collect()
    assert all(r.model_auc_dnn == nn["auc_roc"] for r in results)


def test_month_range_is_pruned(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = daily("u", 100, "2022-11-15 00:00:00")
    for row in rows:
        row["year"], row["month"] = row["ts"].year, row["ts"].month
    files.write_clean(edits_frame(spark, rows), path)
    df = files.read_clean(spark, path, start=(2022, 12), end=(2023, 1))
    assert df.count() == 62
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(+year", plan)
    assert files.read_clean(spark, path).count() == 100


def test_optional_json(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert files.load_json_optional(spark, path) is None
    files.save_json(spark, {"a": {"b": 1.5}}, path)
    files.save_json(spark, {"a": {"b": 2.5}}, path)  # replaces
    assert files.load_json_optional(spark, path) == {"a": {"b": 2.5}}


def test_transfer_list(spark, tmp_path):
    months = manifest.month_manifest(
        manifest.month_bounds(spark, "2021-01", "2025-12"), "https://host/base/", "w", "2026-03"
    )
    assert months.count() == 60
    path = str(tmp_path / "list")
    manifest.write_transfer_list(months, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 61
    assert lines[0] == "TsvHttpData-1.0"
    assert lines[1] == "https://host/base/2026-03/w/w.2026-03.2021-01.tsv.bz2\t-1\t"
    assert lines[-1].startswith("https://host/base/2026-03/w/w.2026-03.2025-12.")


def test_results_to_a_named_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    try:
        files.write_results(df, "results_check", format="table", path=str(tmp_path / "t"))
        assert spark.table("results_check").collect() == [(1, 2)]
    finally:
        spark.sql("DROP TABLE IF EXISTS results_check")


def test_kafka_options():
    options = endpoints.kafka_options("host:9092", "key", "secret")
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert "username='key' password='secret'" in options["kafka.sasl.jaas.config"]


def test_landing_faults_of_named_files(spark, tmp_path):
    folder = tmp_path / "landed"
    (folder / "more").mkdir(parents=True)
    for name, size in {
        "w.2026-03.2021-01.tsv.bz2": 100,
        "more/w.2026-03.2021-02.tsv.bz2": 14,
        "w.2026-03.2021-04.tsv.bz2": 90,
        "w.2026-03.2021-09.tsv.bz2": 50,
        "README": 3,
    }.items():
        (folder / name).write_bytes(b"x" * size)
    bounds = manifest.month_bounds(spark, "2021-01", "2021-04")
    expected = manifest.month_manifest(bounds, "https://x.example/d", "w", "2026-03")
    expected = expected.withColumn("size", F.when(F.col("month") == 4, 91).otherwise(-1).cast("bigint"))
    landed = manifest.landed_files(spark, f"{folder}/")
    assert "content" not in landed.columns
    got = {(r.fault, r.month, r.name.rsplit("/")[-1], r.bytes) for r in manifest.landing_faults(expected, landed).collect()}
    assert got == {
        ("empty", 2, "w.2026-03.2021-02.tsv.bz2", 14),
        ("missing", 3, "w.2026-03.2021-03.tsv.bz2", 0),
        ("size", 4, "w.2026-03.2021-04.tsv.bz2", 90),
        ("unexpected", 9, "w.2026-03.2021-09.tsv.bz2", 50),
        ("unexpected", None, "README", 3),
    }


def test_quarantine_is_written_in_one_pass(spark, tmp_path):
    cells = dict.fromkeys(schema.RAW.fieldNames(), "")
    good = {
        **cells,
        "event_entity": "revision",
        "event_timestamp": "2023-05-06 07:08:09.0",
        "event_user_is_anonymous": "false",
        "page_namespace": "0",
        "revision_id": "1",
    }
    lines = [
        good,
        {**good, "event_timestamp": "junk", "revision_id": "2"},
        {**good, "event_timestamp": "", "revision_id": "3"},
        {**good, "event_user_is_bot_by": "name", "event_timestamp": "junk"},
    ]
    text = ["\t".join(x.values()) for x in lines] + ["too\tfew", "\t".join(good.values()) + "\tmore"]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.tsv").write_text("\n".join(text) + "\n")
    path = f"{tmp_path}/out"
    raw_lines = files.read_raw_lines(spark, f"{tmp_path}/raw", pattern="*.tsv")
    found = clean.with_status(raw_lines)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    files.write_by_status(found, path)
    (accepted,) = files.read_status(spark, path, clean.ACCEPTED).collect()
    assert (accepted.revision_id, accepted.year, accepted.month) == ("1", 2023, 5)
    times = files.read_status(spark, path, clean.MALFORMED_TIME).collect()
    assert sorted((r.revision_id, r.time, r.ts) for r in times) == [("2", "junk", None), ("3", None, None)]
    rejected = files.read_status(spark, path, clean.REJECTED_LINE).collect()
    assert sorted(r.line for r in rejected) == sorted(text[-2:])
    assert all(r.revision_id is None for r in rejected)


def test_a_history_lands_in_files_of_like_size(spark, tmp_path, monkeypatch):
    """Whatever the layout of the table that it comes from."""
    monkeypatch.setattr(raw, "FEWEST_LINES_A_FILE", 100)
    orders = spark.range(2000).selectExpr(
        "nullif(id % 1990, 7) AS o_orderkey",
        "id % 30 AS o_custkey",
        "'F' AS o_orderstatus",
        "id * 1.5D AS o_totalprice",
        "if(id % 40 = 0, NULL, timestamp '1996-02-03 00:00:00') AS o_orderdate",
        "'1-URGENT' AS o_orderpriority",
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    path = queries.landed_history(spark, str(tmp_path))
    counts = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
    cores = spark.sparkContext.defaultParallelism
    assert len(counts) == cores and max(r["count"] for r in counts) < 2 * 2000 / cores
    got = queries.read_revision_tsv(spark, str(tmp_path))
    want = queries.tidy(queries.typed_raw(spark, str(tmp_path)))
    assert got.count() == 2000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_number_of_history_files():
    assert raw.history_files(0, 12) == 1
    assert raw.history_files(150_000, 12) == 3
    assert raw.history_files(9_000_000, 12) == 12
    assert raw.history_files(54_000_000, 12) == 60
