"""The framed change feed, and sinks that replace a batch that comes again."""

import json
import shutil
import time
from pathlib import Path

import pytest

from checks import raw
from holdfast.streaming import endpoints, feed, framing


def events(spark, tmp_path, text, line_end="\n"):
    (tmp_path / "feed").mkdir(exist_ok=True)
    (tmp_path / "feed" / "part-1.txt").write_bytes(text.encode())
    blocks = framing.read_framed(spark, f"{tmp_path}/feed", line_end)
    return framing.parse_events(blocks)


def rows(df):
    return [(r.id, r.event, r.data) for r in df.orderBy(framing.PLACE).collect()]


def test_fields_of_events(spark, tmp_path):
    text = (
        "﻿:hello\n\n"
        "id: 1\ndata: one\n\n"
        "event: other\ndata:two\ndata: lines\ndata\nid:2\n\n"
        "id: 3\n\n"  # no data: no event
        "data:  a blank stays\nretry: 10\nunknown: x\nevent\nid: a:b\n\n\n"
        "event: x\nevent: message\nid: 4\nid: bad\0id\ndata: {\ndata: }\n\n"
        "data: no id\n\n"
    )
    assert rows(events(spark, tmp_path, text)) == [
        ("1", "message", "one"),
        ("2", "other", "two\nlines\n"),
        ("a:b", "message", " a blank stays"),
        ("4", "message", "{\n}"),
        (None, "message", "no id"),
    ]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_line_ends_and_long_events(spark, tmp_path, line_end):
    parts = [f"data: {'x' * 70_000}{i}" for i in range(40)]
    text = (line_end * 2).join(f"id: {i}{line_end}{p}" for i, p in enumerate(parts)) + line_end * 2
    got = rows(events(spark, tmp_path, text, line_end))
    assert got == [(str(i), "message", p[6:]) for i, p in enumerate(parts)]


def test_no_events(spark, tmp_path):
    df = events(spark, tmp_path, ": only a comment\n\n")
    assert rows(df) == []
    assert framing.resume_point(df).collect()[0].id is None


def test_resume_point_is_that_of_the_file_that_landed_last(spark, tmp_path):
    events(spark, tmp_path, "id: 9\ndata: a\n\nid: 8\ndata: b\n\ndata: c\n\n")
    time.sleep(0.05)
    (tmp_path / "feed" / "a-later-file.txt").write_text("id: 7\ndata: b\n\ndata: d\n\n")
    df = framing.parse_events(framing.read_framed(spark, f"{tmp_path}/feed"))
    assert framing.resume_point(df).collect()[0].id == "7"


def change(i, at):
    return json.dumps({"wiki": "w", "type": "edit", "user": f"u{i}", "timestamp": at})


def test_replays_count_once_across_batches(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    block = lambda i, at, name=True: (f"id: {i}\n" if name else "") + f"data: {change(i, at)}\n\n"
    landed = [
        block(1, 1000) + block(2, 1001) + "event: canary\nid: 3\n" + block(3, 1002),
        block(2, 1001) + block(3, 1002) + block(4, 1003),
        block(5, 1004, False) + block(5, 1004, False) + "data: {broken\n\n",
    ]
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for n, text in enumerate(landed):
        (folder / f"{n}.txt").write_text(text)
        blocks = framing.framed_source(spark, str(folder))
        lines = framing.without_replays(framing.messages(framing.parse_events(blocks)))
        envelopes = feed.parse_envelope(feed.normalize_feed(lines, "w"))
        endpoints.run_to_end(
            endpoints.file_sink(envelopes, out, checkpoint, available_now=True)
        )
    users = sorted(r.user for r in spark.read.parquet(out).collect())
    assert users == ["u1", "u2", "u3", "u4", "u5", "u5"]


def stream(spark, folder):
    return spark.readStream.schema("id bigint, x string").option("maxFilesPerTrigger", 1).json(str(folder))


def land(folder, name, *ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"id": i, "x": f"x{i}"}) for i in ids))


def test_a_retried_batch_leaves_no_duplicates(spark, tmp_path):
    folder, checkpoint, path = tmp_path / "in", tmp_path / "checkpoint", f"{tmp_path}/table"
    for i in range(3):
        land(folder, f"{i}.json", i, 10 + i)

    def run():
        query = endpoints.table_sink(
            stream(spark, folder), "retried", str(checkpoint), available_now=True, path=path
        )
        endpoints.run_to_end(query)
        return sorted(r.id for r in endpoints.read_table(spark, "retried").collect())

    spark.sql("DROP TABLE IF EXISTS retried")
    whole = [0, 1, 2, 10, 11, 12]
    assert run() == whole and run() == whole
    # As after a failure between writing a batch and recording that it is done.
    for name in ("2", ".2.crc"):
        done = Path(checkpoint) / "commits" / name
        if done.exists():
            shutil.copy(done, tmp_path / f"saved{name}")
            done.unlink()
    assert run() == whole
    assert endpoints.read_table(spark, "retried").groupBy("batch_id").count().count() == 3


def test_a_target_of_its_own_kind(spark, tmp_path):
    land(tmp_path / "in", "0.json", 1, 2)
    seen = {}

    def replace(batch, batch_id, table, **options):
        seen[table, batch_id] = [r.id for r in batch.orderBy("id").collect()]

    endpoints.run_to_end(
        endpoints.table_sink(
            stream(spark, tmp_path / "in"), "t", f"{tmp_path}/c", available_now=True, replace=replace
        )
    )
    assert seen == {("t", 0): [1, 2]}


def test_two_timed_triggers(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "0.json", 1)
    query = endpoints.file_sink(
        stream(spark, folder), f"{tmp_path}/out", f"{tmp_path}/c", trigger="1 second"
    )
    try:
        for n, name in ((1, "1.json"), (2, None)):
            until = time.time() + 60
            while time.time() < until and query.isActive:
                progress = [p for p in query.recentProgress if p.numInputRows]
                if len(progress) >= n:
                    break
                time.sleep(0.2)
            if name:
                land(folder, name, 2)
    finally:
        query.stop()
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert [p.numInputRows for p in batches] == [1, 1]
    starts = [p.timestamp for p in batches]
    assert starts[0] < starts[1]
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]




def test_blocks_land_in_ranges_of_bounded_size(spark, tmp_path, monkeypatch):
    """In places that follow their ids, each landing after the one before it."""
    monkeypatch.setattr(raw, "BLOCKS_A_FILE", 100)
    path = f"{tmp_path}/feed"
    ids = spark.range(0, 1000, 1, 4).selectExpr("(id * 7919) % 1000 AS event_id")
    blocks = ids.selectExpr("event_id", "concat('id: ', event_id, '\ndata: x') AS value")
    landings = [blocks, blocks.where("event_id % 4 = 3"), blocks.where("event_id < 10")]
    want = []
    for landing in landings:
        raw.land_blocks(landing, path)
        want += sorted(r.event_id for r in landing.collect())
        read = framing.parse_events(framing.read_framed(spark, path))
        assert [int(r.id) for r in read.orderBy(framing.PLACE).collect()] == want
        assert framing.resume_point(read).first().id == str(want[-1])
    sizes = [f.read_text().count("id: ") for f in Path(path).glob("part-*")]
    assert sum(sizes) == len(want) and len(sizes) >= 12 and max(sizes) < 250


def test_blocks_with_repeated_and_missing_ids_all_land(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "BLOCKS_A_FILE", 5)
    rows = [(None, "data: a"), (None, "data: b"), *[(1, "id: 1\ndata: c")] * 20, (2, "data: d")]
    path = f"{tmp_path}/feed"
    raw.land_blocks(spark.createDataFrame(rows, "event_id bigint, value string"), path)
    read = framing.parse_events(framing.read_framed(spark, path))
    got = [(r.id, r.data) for r in read.orderBy(framing.PLACE).collect()]
    assert got == [(None, "a"), (None, "b"), *[("1", "c")] * 20, (None, "d")]
    raw.land_blocks(spark.createDataFrame([], "event_id bigint, value string"), path)
    assert framing.parse_events(framing.read_framed(spark, path)).count() == len(rows)
