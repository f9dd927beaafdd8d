"""Keeping each editor's first edits from an unending stream.

The stream passes on an edit if, when it arrives, it is among the first ``n`` of its
editor. The result is a small append-only table that holds the first ``n`` edits of every
editor (and a few that were overtaken by late ones), so the batch feature job over that
table gives the same rows as over the whole history, in whatever order edits arrive.

State is the sort keys of at most ``n`` edits, per editor and ``shard``, on RocksDB, which the
session must name as its state store (:func:`keep_state_on_disk`). Keeping the first ``n`` of
each shard keeps the first ``n`` of the editor, so an editor with very many edits can be
spread over several tasks.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from itertools import chain

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from holdfast.operators.ranking import USER

# The processor also runs in a worker of the driver, which sees no files sent to executors, so
# this module's functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIRST = T.StructType(
    [
        T.StructField("micros", T.ArrayType(T.LongType())),
        T.StructField("revisions", T.ArrayType(T.StringType())),
    ]
)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams that start from now on keep their state on RocksDB. A stream that goes on from
    a checkpoint keeps the store it began with."""
    spark.conf.set(_STORE, _ROCKSDB)


def _sort_key(micros: int, revision: str | None) -> tuple[int, int, str]:
    """As the batch job orders edits: a missing id comes first, shorter ids before longer."""
    return (micros, -1, "") if revision is None else (micros, len(revision), revision)


class _FirstEdits(StatefulProcessor):
    """The first ``n`` sort keys of a key, and a timer at the last of them that ends the state.

    A timer is set once, when the state begins. When it fires and later edits have moved the
    state's end, it is set again, so a batch costs an editor one read and at most one write.
    """

    def __init__(self, n: int) -> None:
        self._n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._first = handle.getValueState("first", _FIRST)

    def handleInputRows(
        self, key: tuple, rows: Iterator[Row], timerValues: TimerValues
    ) -> Iterator[Row]:
        state = self._first.get()
        known = [] if state is None else [(*_sort_key(m, r), None) for m, r in zip(*state)]
        fresh = ((*_sort_key(r["_micros"], r["revision_id"]), r) for r in rows)
        if len(known) == self._n:
            latest = known[-1][:3]
            fresh = (x for x in fresh if x[:3] < latest)
        # Rows beyond the first n are let go as they come; ties keep what came first.
        first = heapq.nsmallest(self._n, chain(known, fresh), key=lambda x: x[:3])
        kept = [row for *_, row in first if row is not None]
        if kept:
            revisions = [None if length < 0 else r for _, length, r, _ in first]
            self._first.update(([m for m, *_ in first], revisions))
            if state is None:
                self._end_after(first[-1][0], timerValues)
        return iter(kept)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[Row]:
        state = self._first.get()
        if state is not None:
            if state[0][-1] // 1000 > timerValues.getCurrentWatermarkInMs():
                self._end_after(state[0][-1], timerValues)
            else:
                self._first.clear()
        return iter(())

    def _end_after(self, micros: int, timerValues: TimerValues) -> None:
        now = timerValues.getCurrentWatermarkInMs()
        self._handle.registerTimer(max(micros // 1000, now + 1))

    def close(self) -> None:
        pass


def first_edits_stream(
    edits: DataFrame, n: int, shards: int = 2, idle_days: int = 365
) -> DataFrame:
    """``edits`` without those that can not be among the first ``n`` of their editor.

    An editor's rows pass one by one, and ``n`` of them are held at a time. Use more ``shards``
    if what one editor brings in a batch is too much for two tasks. Columns but the sort key
    travel as one.

    The watermark is ``idle_days`` behind the newest edit. The state of an editor and shard ends
    when it has passed the last edit held there. An editor who comes back may then bring up to
    ``n`` edits more into the result, which changes nothing in what the batch job makes of it.
    Edits that arrive later than that are lost, so it should exceed any delay of the feed.
    """
    if edits.sparkSession.conf.get(_STORE) != _ROCKSDB:
        raise RuntimeError(f"{_STORE} must be {_ROCKSDB}, see keep_state_on_disk")
    packed = [c for c in edits.columns if c not in (USER, "ts", "revision_id")]
    packed_type = T.StructType([edits.schema[c] for c in packed])
    ranked = edits.filter(F.col(USER).isNotNull() & F.col("ts").isNotNull())
    arriving = ranked.withWatermark("ts", f"{idle_days} days").select(
        USER,
        "ts",
        F.unix_micros("ts").alias("_micros"),
        "revision_id",
        F.to_json(F.struct(*packed)).alias("_packed"),
        F.pmod(F.xxhash64("revision_id"), F.lit(shards)).alias("_shard"),
    )
    kept = arriving.groupBy(USER, "_shard").transformWithState(
        _FirstEdits(n), arriving.schema, "append", "eventTime"
    )
    unpacked = kept.select(
        USER,
        "ts",
        "revision_id",
        F.from_json("_packed", packed_type).alias("_other"),
    ).select(USER, "ts", "revision_id", "_other.*")
    return unpacked.select(*edits.columns)
