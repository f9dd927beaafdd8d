import math
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from holdfast import schema
from holdfast.config import FeatureSpec
from holdfast.operators import features, ranking
from holdfast.sources import views

from .conftest import SF_SMALL
from .helpers import daily, edits_frame


def one(spark, rows, spec=FeatureSpec()):
    return features.editor_features(edits_frame(spark, rows), spec).collect()


def test_feature_edges(spark):
    rows = [
        dict(ts="2023-01-07 23:50:00", event_comment="a", revision_text_bytes_diff=100),
        dict(
            ts="2023-01-08 00:20:00",
            event_comment="",
            revision_text_bytes_diff=-40,
            revision_is_identity_reverted=True,
            revision_minor_edit=True,
        ),
        dict(
            ts="2023-01-08 00:50:01",
            page_namespace=1,
            event_comment=None,
            revision_text_bytes_diff=None,
            revision_is_identity_reverted=None,
        ),
        dict(
            ts="2023-01-09 00:00:00",
            page_namespace=1,
            event_comment="b",
            revision_text_bytes_diff=0,
            revision_minor_edit=None,
        ),
    ]
    (got,) = one(spark, rows)
    want = {
        "dropout": 1,
        "velocity": 4 / (87000 / 86400),
        "revert_rate": 1 / 3,
        "namespace_diversity": 1.0,
        "avg_bytes_added": 25.0,
        "avg_bytes_removed": 10.0,
        "talk_page_ratio": 0.5,
        "peak_hour_sin": 0.0,
        "peak_hour_cos": 1.0,
        "weekend_ratio": 0.75,
        "edit_summary_rate": 0.5,
        "minor_edit_ratio": 1 / 3,
        "session_count": 3.0,
        "first_edit_size": 100.0,
    }
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=1e-9), name


def test_output_layout(spark):
    df = features.editor_features(edits_frame(spark, daily("u", 3)))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schema.FEATURES
    ]


def test_twelve_daily_edits(spark):
    (got,) = one(spark, daily("u", 12))
    assert got.velocity == pytest.approx(10 / 9)
    assert (got.session_count, got.namespace_diversity, got.dropout) == (10.0, 0.0, 0)


@pytest.mark.parametrize("extra_seconds, dropout", [(0, 0), (1, 1)])
def test_horizon_is_inclusive(spark, extra_seconds, dropout):
    rows = daily("u", 10)
    rows.append(
        {
            "event_user_id": "u",
            "ts": rows[-1]["ts"] + timedelta(days=180, seconds=extra_seconds),
        }
    )
    (got,) = one(spark, rows)
    assert got.dropout == dropout


def test_too_few_edits_and_short_windows(spark):
    rows = daily("two", 2) + daily("nine", 9)
    (got,) = one(spark, rows)
    assert (got.event_user_id, got.dropout) == ("nine", 1)
    assert one(spark, rows, FeatureSpec(require_full_window=True)) == []


def test_velocity_floor_of_one_day(spark):
    rows = [{"ts": f"2023-01-01 12:{m:02d}:00"} for m in (0, 10, 50)]
    (got,) = one(spark, rows)
    assert got.velocity == 3.0


def test_equal_times_are_ordered_by_revision(spark):
    rows = [
        {"ts": "2023-01-01 12:00:00", "revision_id": "10", "revision_text_bytes": 2},
        {"ts": "2023-01-01 12:00:00", "revision_id": "9", "revision_text_bytes": 1},
        {"ts": "2023-01-01 13:00:00", "revision_id": "11"},
    ]
    df = edits_frame(spark, rows)
    ranks = {r.revision_id: r.edit_rank for r in ranking.edit_rank(df).collect()}
    assert ranks == {"9": 1, "10": 2, "11": 3}
    (got,) = one(spark, rows)
    assert got.first_edit_size == 1.0


def test_hour_ties_go_to_the_earliest(spark):
    rows = [{"ts": f"2023-01-01 {h:02d}:{m}0:00"} for h in (9, 5) for m in (0, 1)]
    (got,) = one(spark, rows)
    assert got.peak_hour_sin == pytest.approx(math.sin(2 * math.pi * 5 / 24))


def test_all_unknown_flags_give_zero(spark):
    rows = daily("u", 3, revision_is_identity_reverted=None, revision_minor_edit=None)
    (got,) = one(spark, rows)
    assert (got.revert_rate, got.minor_edit_ratio) == (0.0, 0.0)


def test_unknown_namespace_is_a_namespace_of_its_own(spark):
    rows = daily("u", 2) + daily("u", 2, start="2023-02-01 12:00:00", page_namespace=None)
    (got,) = one(spark, rows)
    assert got.namespace_diversity == pytest.approx(1.0)
    assert got.talk_page_ratio == 0.0


def test_unknown_user_or_time_is_never_ranked(spark):
    rows = daily("u", 3) + [
        {"ts": None, "event_user_id": "u"},
        {"ts": "2023-01-01 12:00:00", "event_user_id": None},
    ]
    df = edits_frame(spark, rows)
    assert ranking.edit_rank(df).count() == 3
    assert len(one(spark, rows)) == 1


def test_censoring_keeps_who_returned_and_who_had_the_time(spark):
    rows = daily("returned", 11) + daily("gone", 10) + daily("early", 10, "2020-01-01 00:00:00")
    spec = FeatureSpec(censor_after="2023-02-01 00:00:00")
    assert {r.event_user_id for r in one(spark, rows, spec)} == {"returned", "early"}


def test_newcomers_only(spark):
    rows = daily("old", 3, event_user_first_edit_timestamp="2019-05-01 00:00:00.0") + daily(
        "new", 3, event_user_first_edit_timestamp="2022-05-01 00:00:00.0"
    )
    spec = FeatureSpec(newcomers_since="2021-01-01 00:00:00")
    assert [r.event_user_id for r in one(spark, rows, spec)] == ["new"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_take_one_shuffle_with_a_limit_before_it(spark):
    plan = plan_of(features.editor_features(views.orders_as_edits(spark, SF_SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("WindowGroupLimit") == 2
    assert "Join" not in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_one_feature_reads_only_its_columns(spark):
    df = features.editor_profile(views.orders_as_edits(spark, SF_SMALL))
    plan = plan_of(df.select("event_user_id", "velocity"))
    assert "o_totalprice" not in plan and "o_orderstatus" not in plan


def test_result_does_not_depend_on_partitioning(spark):
    edits = views.events_as_edits(spark, SF_SMALL)
    spec = FeatureSpec(horizon_days=1)
    results = [
        sorted(features.editor_features(edits.repartition(n), spec).collect()) for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_label_and_diversity_by_hand(spark):
    """Each editor's edits as a sorted list in plain Python."""
    n, horizon = 5, timedelta(days=180)
    histories = defaultdict(list)
    edits = views.orders_as_edits(spark, SF_SMALL)
    for r in edits.collect():
        histories[r.event_user_id].append((r.ts, len(r.revision_id), r.revision_id, r.page_namespace))
    want = {}
    for user, history in histories.items():
        history.sort()
        spaces = Counter(space for *_, space in history[:n])
        if len(history) < 3:
            continue
        shares = [count / spaces.total() for count in spaces.values()]
        stays = len(history) > n and history[n][0] - history[n - 1][0] <= horizon
        want[user] = (0 if stays else 1, -sum(p * math.log2(p) for p in shares))
    got = features.editor_features(edits, FeatureSpec(window=n)).collect()
    assert {r.event_user_id: r.dropout for r in got} == {u: d for u, (d, _) in want.items()}
    for r in got:
        assert r.namespace_diversity == pytest.approx(want[r.event_user_id][1], abs=1e-9)


def hot_editor(spark):
    """One editor holds nearly all rows, many of them at one time."""
    start = datetime(2023, 1, 1)
    rows = [{"event_user_id": "hot", "ts": start + timedelta(minutes=7 * i)} for i in range(500)]
    rows += [{"event_user_id": "hot", "ts": start + timedelta(days=50)}] * 400
    rows += daily("cold", 5) + daily("mild", 12)
    return edits_frame(spark, rows).repartition(5)


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_rank_of_a_hot_editor(spark, slices):
    df = hot_editor(spark)
    ranked = ranking.edit_rank(df, slices).collect()
    assert len(ranked) == 917
    for user, n in (("hot", 900), ("cold", 5), ("mild", 12)):
        own = sorted(
            (r.ts, len(r.revision_id), r.revision_id, r.edit_rank) for r in ranked if r.event_user_id == user
        )
        assert [rank for *_, rank in own] == list(range(1, n + 1))


def test_ranking_shuffles_rows_once_and_stays_in_the_jvm(spark):
    for ranked in (ranking.edit_rank(hot_editor(spark), 20), ranking.post_window(hot_editor(spark), 3, 20)):
        text = ranked._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "SortMergeJoin" not in text
        rows, offsets = text.split("BroadcastExchange")
        assert rows.count("Exchange hash") == 1 and "row_number()" in rows
        assert "partial_count" in offsets and "row_number()" not in offsets


def test_cuts_split_a_hot_time_and_need_few_offsets(spark):
    rows, offsets = ranking.sliced(hot_editor(spark), 20)
    same_time = rows.filter("ts = '2023-02-20 00:00:00'")
    assert same_time.select("_slice").distinct().count() > 5
    assert max(r["count"] for r in rows.groupBy("_slice").count().collect()) < 200
    assert 10 < offsets.count() < 40
    assert [c.event_user_id for c in ranking.cut_points(hot_editor(spark), 3)].count("hot") >= 2


def test_few_rows_need_no_cut(spark):
    df = edits_frame(spark, daily("a", 1))
    assert [r.edit_rank for r in ranking.edit_rank(df, 50).collect()] == [1]
    assert ranking.edit_rank(df.limit(0)).count() == 0


def test_window_and_rest_agree_on_edits_of_one_time_and_id(spark):
    start = datetime(2023, 1, 1)
    rows = [{"ts": start, "revision_id": "1", "event_comment": f"c{i}"} for i in range(9)]
    found = set()
    for parts in (1, 4):
        df = edits_frame(spark, rows).repartition(parts)
        first = {r.event_comment for r in ranking.first_window(df, 4).collect()}
        rest = {r.event_comment for r in ranking.post_window(df, 4).collect()}
        assert len(first) == 4 and first | rest == {f"c{i}" for i in range(9)}
        found.add(frozenset(first))
    assert len(found) == 1


def test_edits_after_the_window(spark):
    df = hot_editor(spark)
    after = ranking.post_window(df, 10)
    assert {r.event_user_id: r["count"] for r in after.groupBy("event_user_id").count().collect()} == {
        "hot": 890,
        "mild": 2,
    }


def test_repeats_of_the_last_edit_of_the_window_come_after_it(spark):
    start = datetime(2023, 1, 1)
    rows = [
        {"event_user_id": user, "ts": start + timedelta(days=day), "revision_id": f"{day}"}
        for user, days in (("again", [0, 1, 2, 2, 2, 2, 3]), ("within", [0, 2, 2]), ("few", [0, 2]))
        for day in days
    ]
    df = edits_frame(spark, rows)
    for n in (2, 3, 4, 6, 7):
        want = ranking.edit_rank(df).filter(f"edit_rank > {n}")
        keys = ["event_user_id", "ts", "revision_id"]
        after = [tuple(r) for r in ranking.post_window(df, n).select(*keys).collect()]
        assert sorted(after) == sorted(tuple(r) for r in want.select(*keys).collect())


@pytest.mark.parametrize("window", [3, 10, 15, 16, 300])
def test_most_frequent_hour_for_any_window(spark, window):
    """Counts per hour up to the whole window, in every hour of the day."""
    rows = []
    for hour in range(24):
        start = datetime(2023, 1, 1, hour)
        rows += [
            {"event_user_id": f"only {hour}", "ts": start + timedelta(days=i)}
            for i in range(window)
        ]
        late = [start + timedelta(days=i, hours=(i % 2) * 5) for i in range(window)]
        rows += [{"event_user_id": f"mixed {hour}", "ts": ts} for ts in late]
    spec = FeatureSpec(window=window)
    got = features.editor_profile(edits_frame(spark, rows), spec)
    hours = {r.event_user_id: r.peak_hour for r in got.collect()}
    for hour in range(24):
        assert hours[f"only {hour}"] == hour
        other = (hour + 5) % 24
        want = min(hour, other) if window % 2 == 0 else hour
        assert hours[f"mixed {hour}"] == want
