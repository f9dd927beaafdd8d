"""One feature row and one dropout label per editor, from a single shuffle.

Edits are shuffled by editor once, for the ranking. Everything after that groups by the
editor, alone or with a second column, which the existing partitioning already satisfies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schema
from holdfast.config import FeatureSpec
from holdfast.functions import edits as E
from holdfast.functions.scalars import DAY_SECONDS, hour_cos, hour_sin
from holdfast.operators.ranking import USER, with_neighbours


def newcomers(edits: DataFrame, spec: FeatureSpec) -> DataFrame:
    if spec.newcomers_since is None:
        return edits
    first = F.try_to_timestamp("event_user_first_edit_timestamp")
    return edits.filter(first >= F.lit(spec.newcomers_since).cast("timestamp"))


def window_sums(edits: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Per editor: window bounds, counts and sums, and the namespace entropy term.

    Grouping by editor and namespace first gives the namespace counts; everything else
    carries over to the grouping by editor. All buffers are numbers of fixed size.
    """
    counts = E.counts(spec)
    window = with_neighbours(newcomers(edits, spec), spec.window)
    per_namespace = (
        window.withColumn("hour", F.hour("ts"))
        .groupBy(USER, "page_namespace")
        .agg(
            F.expr("min(ts) AS first_ts"),
            F.expr("max(ts) AS last_window_ts"),
            *[F.expr(f"{text} AS {name}") for name, text in counts.items()],
        )
    )
    return per_namespace.groupBy(USER).agg(
        F.expr("min(first_ts) AS first_ts"),
        F.expr("max(last_window_ts) AS last_window_ts"),
        F.expr("sum(window_edits * log2(window_edits)) AS count_log_count"),
        *[F.expr(f"sum({name}) AS {name}") for name in counts],
    )


_WINDOW_DAYS = f"{E.gap_seconds('last_window_ts', 'first_ts')} / double({DAY_SECONDS})"

# The features over :func:`window_sums`. A mean over nothing is NULL. Namespace diversity is
# Shannon entropy in bits, -sum(c/n * log2(c/n)), rearranged to need only one more sum; with
# a single namespace it is exactly 0, which rounding must not turn negative.
_FEATURES = {
    "velocity": f"window_edits / greatest(1D, {_WINDOW_DAYS})",
    "revert_rate": "try_divide(reverted, reverted_known)",
    "namespace_diversity": "greatest(0D, log2(window_edits) - count_log_count / window_edits)",
    "avg_bytes_added": "bytes_added / window_edits",
    "avg_bytes_removed": "bytes_removed / window_edits",
    "talk_page_ratio": "try_divide(talk, talk_known)",
    "peak_hour_sin": hour_sin("peak_hour"),
    "peak_hour_cos": hour_cos("peak_hour"),
    "weekend_ratio": "weekend / window_edits",
    "edit_summary_rate": "summarised / window_edits",
    "minor_edit_ratio": "try_divide(minor, minor_known)",
    "session_count": "sessions",
    "first_edit_size": "coalesce(first_bytes, 0L)",
}


def enough_edits(spec: FeatureSpec) -> Column:
    needed = spec.window if spec.require_full_window else spec.min_edits
    return F.col("window_edits") >= needed


def observable(spec: FeatureSpec) -> Column:
    """False for editors whose horizon ends after the data does and who did not return."""
    if spec.censor_after is None:
        return F.lit(True)
    room = F.lit(spec.censor_after).cast("timestamp").cast("bigint") - F.unix_timestamp(
        "last_window_ts"
    )
    return (F.col("kept") > 0) | (room >= spec.horizon_days * DAY_SECONDS)


def editor_profile(edits: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Editors with bounds, label, most frequent hour and features before null handling.

    Selecting a few columns of this makes Catalyst prune the sums of all the others.
    """
    sums = window_sums(edits, spec).filter(enough_edits(spec) & observable(spec))
    return sums.withColumn("peak_hour", F.expr(E.most_frequent_hour(spec))).selectExpr(
        USER,
        "first_ts",
        "last_window_ts",
        "window_edits",
        "peak_hour",
        "if(kept > 0, 0, 1) AS dropout",
        *[f"{text} AS {name}" for name, text in _FEATURES.items()],
    )


def feature_projection(profile: DataFrame) -> DataFrame:
    """The feature table: fixed order, NULL to 0, all doubles."""
    return profile.selectExpr(
        USER, "dropout", *[f"coalesce(double({c}), 0D) AS {c}" for c in schema.FEATURE_COLS]
    )


def editor_features(edits: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    return feature_projection(editor_profile(edits, spec))


def with_vector(df: DataFrame, features: list[str] = schema.FEATURE_COLS) -> DataFrame:
    """Add the feature vector as an ``array<double>`` column."""
    return df.withColumn("features", F.array(*features))
