"""Numbering each editor's edits in time, and what follows from the number.

Order is by time, then by revision id (shorter ids first, so that numeric ids compare as
numbers). Edits without a user or without a time are never ranked.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

USER = "event_user_id"
_ORDER = ["ts", "_id_length", "revision_id"]


def require_user(edits: DataFrame) -> DataFrame:
    return edits.filter(F.col(USER).isNotNull())


def _rankable(edits: DataFrame) -> DataFrame:
    return (
        require_user(edits)
        .filter(F.col("ts").isNotNull())
        .withColumn("_id_length", F.length("revision_id"))
    )


def _by_user(ties: Iterable[Column] = ()):
    return Window.partitionBy(USER).orderBy(*_ORDER, *ties)


def _every_column(edits: DataFrame) -> list[Column]:
    """An order of edits that agree in time and id, from what else they hold."""
    return [F.xxhash64(*[F.col(f"`{c}`") for c in edits.columns])]


_PLACE = [USER, *_ORDER]
#: Rows of the sample that lie between two cuts.
_PER_CUT = 20


def cut_points(edits: DataFrame, slices: int) -> list[Row]:
    """Places in the order by editor, time and id that cut the edits into about equal slices.

    They are drawn from the ``20 * slices`` rows whose hash is smallest, the same ones on any
    partitioning, so what the driver sees is bounded. They decide only how evenly work is dealt.
    """
    rows = _rankable(edits).select(*_PLACE)
    sample = rows.orderBy(F.xxhash64(*_PLACE), *_PLACE).limit(_PER_CUT * slices)
    ordered = sample.orderBy(*_PLACE).collect()
    every = max(1, len(ordered) // slices)
    return ordered[every::every]


def _slice_of(cuts: list[Row]) -> Column:
    """How many cuts lie at or before a row; 0 for editors that no cut falls in, as they lie in
    one slice anyway."""
    editors = sorted({cut[USER] for cut in cuts})
    if not editors:
        return F.lit(0)
    # A search by halves over the cuts, for the rows of those editors alone.
    listed = F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(_PLACE, cut)]) for cut in cuts])
    place = F.struct(*_PLACE)
    n = len(cuts)
    steps = [F.lit(1 << i) for i in reversed(range(n.bit_length()))]
    found = F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= n) & (F.try_element_at(listed, low + step) <= place), low + step
        ).otherwise(low),
    )
    return F.when(F.col(USER).isin(*editors), found).otherwise(0)


def sliced(edits: DataFrame, slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rankable edits with their ``_slice``, and the number of an editor's edits in earlier
    slices (editor, ``_slice``, ``_offset``) for the editors whom a cut falls in. There are
    fewer such rows than twice the slices."""
    n = slices or int(edits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = cut_points(edits, n)
    rows = _rankable(edits).withColumn("_slice", _slice_of(cuts))
    cut_editors = sorted({cut[USER] for cut in cuts})
    counts = (
        rows.filter(F.col(USER).isin(*cut_editors) if cut_editors else F.lit(False))
        .groupBy(USER, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    before = (
        Window.partitionBy(USER).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(USER, "_slice", F.sum("_n").over(before).alias("_offset"))
    return rows, offsets.filter(F.col("_offset").isNotNull())


def edit_rank(
    edits: DataFrame, slices: int | None = None, ties: Iterable[Column] = ()
) -> DataFrame:
    """All edits with their ``edit_rank``.

    An editor's whole history is never gathered in one task: the order is cut at explicit
    points, edits are numbered in generated code by editor and slice, and slices are shifted by
    the number of the editor's edits before them. Rows are shuffled once and never leave the
    JVM. Edits that agree in time and id are numbered in the order of ``ties``, if given; they
    lie in one slice. Use :func:`first_edits` when only the first few ranks matter.
    """
    rows, offsets = sliced(edits, slices)
    inside = Window.partitionBy(USER, "_slice").orderBy(*_ORDER, *ties)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), [USER, "_slice"], "left")
        .withColumn("edit_rank", F.col("_rank") + F.coalesce("_offset", F.lit(0)))
        .select(*edits.columns, "edit_rank")
    )


def first_edits(edits: DataFrame, n: int, ties: Iterable[Column] = ()) -> DataFrame:
    """Edits of rank 1 to ``n`` with ``edit_rank``.

    Ranking is the only window under the filter, so Spark limits the groups before the
    shuffle: a task sends at most ``n`` rows per editor, however many it has read.
    """
    return (
        _rankable(edits)
        .withColumn("edit_rank", F.row_number().over(_by_user(ties)))
        .filter(F.col("edit_rank") <= n)
    )


def first_window(edits: DataFrame, n: int) -> DataFrame:
    """Edits of rank 1 to ``n``; of edits that agree in time and id the same ones each time."""
    return first_edits(edits, n, _every_column(edits)).drop("_id_length")


def post_window(edits: DataFrame, n: int, slices: int | None = None) -> DataFrame:
    """Edits of a rank above ``n``, without ``edit_rank``: those that :func:`first_window` leaves.

    Rows are shuffled once, by editor and slice, and nothing is joined by editor.
    """
    ranked = edit_rank(edits, slices, _every_column(edits))
    return ranked.filter(F.col("edit_rank") > n).select(*edits.columns)


def with_neighbours(edits: DataFrame, n: int) -> DataFrame:
    """First ``n`` edits with the time of the edit before and after each of them.

    One more rank than ``n`` is kept until the neighbour is read, so that the last edit
    of the window knows its successor. The windows share one shuffle and one sort.
    """
    w = _by_user()
    return (
        first_edits(edits, n + 1)
        .withColumn("prev_ts", F.lag("ts").over(w))
        .withColumn("next_ts", F.lead("ts").over(w))
        .filter(F.col("edit_rank") <= n)
        .drop("_id_length")
    )
