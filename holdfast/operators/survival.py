"""Time until an editor stops editing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.scalars import DAY_SECONDS, flag
from holdfast.operators.ranking import USER
from holdfast.workspace import materialize


def editor_lifetimes(edits: DataFrame, horizon_days: int) -> DataFrame:
    """Days from first to last edit, and whether the editor left or was still around.

    An editor has left if the data goes on for longer than the horizon after the last edit.
    The edits are scanned once: their spans are stored, and the last of them ends the data.
    """
    spans = materialize(
        edits.filter(F.col(USER).isNotNull() & F.col("ts").isNotNull())
        .groupBy(USER)
        .agg(F.unix_timestamp(F.min("ts")).alias("t0"), F.unix_timestamp(F.max("ts")).alias("t1")),
        "spans",
    )
    end = spans.agg(F.max("t1")).first()[0]
    left = F.lit(end) - F.col("t1") > horizon_days * DAY_SECONDS
    return spans.select(
        USER,
        F.floor((F.col("t1") - F.col("t0")) / DAY_SECONDS).alias("days"),
        flag(left).alias("left"),
    )


def survival_curve(lifetimes: DataFrame) -> DataFrame:
    """Kaplan-Meier estimate per day on which someone left.

    The window has no key, but it runs over distinct days: their number is bounded by
    the calendar, not by the number of editors.
    """
    days = lifetimes.groupBy("days").agg(
        F.count(F.lit(1)).alias("leaving_sample"), F.sum("left").alias("events")
    )
    after = Window.orderBy("days").rowsBetween(0, Window.unboundedFollowing)
    until = Window.orderBy("days").rowsBetween(Window.unboundedPreceding, 0)
    at_risk = days.withColumn("at_risk", F.sum("leaving_sample").over(after))
    # All at risk leaving ends the curve at 0; the log of that factor is left out.
    factor = F.when(
        F.col("events") < F.col("at_risk"), F.log(1.0 - F.col("events") / F.col("at_risk"))
    ).otherwise(0.0)
    curve = at_risk.withColumn("log_survival", F.sum(factor).over(until))
    return curve.select(
        "days",
        "events",
        "at_risk",
        F.when(F.col("events") == F.col("at_risk"), 0.0)
        .otherwise(F.exp("log_survival"))
        .alias("survival"),
    ).filter(F.col("events") > 0)
