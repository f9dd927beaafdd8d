"""From change-feed lines to scored edits. Every step is stateless and works on a batch
of lines as well as on a stream of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import schema
from holdfast.functions.scalars import flag, hour_cos, hour_sin
from holdfast.operators.logreg import LogRegModel

# Fixed value: the tag the feed puts on an edit that undoes earlier ones.
REVERT_TAG = "mw-revert"

# Tags are a list, or the text of one.
_TAGGED = f"""
if(startswith(tags, '['), array_contains(from_json(tags, 'array<string>'), '{REVERT_TAG}'),
   contains(tags, '{REVERT_TAG}'))
"""

_CORRUPT = "_corrupt"


def _parse(records: DataFrame, layout: T.StructType) -> DataFrame:
    """Columns of the JSON object in ``value``, and whether it could not be read."""
    with_corrupt = T.StructType([*layout.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    return records.select(parsed.alias("e")).select(
        *[F.col(f"e.{name}") for name in layout.fieldNames()],
        (F.col("e").isNull() | F.col(f"e.{_CORRUPT}").isNotNull()).alias("corrupt"),
    )


def parse_changes(lines: DataFrame) -> DataFrame:
    """The fields of each change line as text, whatever their JSON type; lines that are not
    a JSON object are skipped. Objects and arrays are text in JSON again."""
    return _parse(lines, schema.CHANGE).filter(~F.col("corrupt")).drop("corrupt")


def feed_counts(lines: DataFrame) -> DataFrame:
    """One row: how many ``lines`` there are, and how many are ``unreadable`` and skipped."""
    return _parse(lines, schema.CHANGE).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("corrupt").alias("unreadable")
    )


def is_set(field: str) -> Column:
    """Whether a field counts as true: not missing, false, zero, or empty."""
    return F.expr(
        f"coalesce({field} NOT IN ('', 'false', '[]', '{{}}') "
        f"AND coalesce(try_cast({field} AS double) <> 0, true), false)"
    )


def whole(text: str) -> Column:
    """A field as a whole number, cut towards zero; 0 if it is missing or no number."""
    cut = f"try_cast(try_cast({text} AS double) AS bigint)"
    return F.expr(f"coalesce(try_cast({text} AS bigint), {cut}, 0L)")


def feed_filter(changes: DataFrame, wiki: str) -> DataFrame:
    """Edits of one wiki that are not marked as made by a bot."""
    return changes.filter((F.col("wiki") == wiki) & (F.col("type") == "edit") & ~is_set("bot"))


def feed_envelope(changes: DataFrame) -> DataFrame:
    length = {k: f"get_json_object(length, '$.{k}')" for k in ("new", "old")}
    return changes.select(
        "user",
        "title",
        whole("namespace").cast("int").alias("namespace"),
        whole("timestamp").alias("ts"),
        (whole(length["new"]) - whole(length["old"])).alias("bytes_diff"),
        F.coalesce("comment", F.lit("")).alias("comment"),
        flag(is_set("minor")).cast("int").alias("minor"),
        flag(F.expr(_TAGGED)).cast("int").alias("is_revert"),
    )


def normalize_feed(lines: DataFrame, wiki: str) -> DataFrame:
    """Change lines to envelope records: one JSON ``value`` per edit that is kept."""
    edits = feed_envelope(feed_filter(parse_changes(lines), wiki))
    return edits.select(F.to_json(F.struct("*")).alias("value"))


def parse_envelope(records: DataFrame) -> DataFrame:
    """Envelope records to columns plus ``corrupt``; unreadable records stay, as NULLs."""
    return _parse(records, schema.ENVELOPE)


# What a single edit says about each feature; 0 where it says nothing. ``revert_rate`` here
# is whether the edit is a revert, while the batch feature is whether edits were reverted
# later. That difference is part of the contract.
# The hour is that of UTC, whatever the session's time zone.
_HOUR = "pmod(ts div 3600, 24)"
_PROXIES = {
    "velocity": "0",
    "revert_rate": "is_revert",
    "namespace_diversity": "0",
    "avg_bytes_added": "greatest(bytes_diff, 0L)",
    "avg_bytes_removed": "greatest(-bytes_diff, 0L)",
    "talk_page_ratio": "namespace = 1",
    "peak_hour_sin": hour_sin(_HOUR),
    "peak_hour_cos": hour_cos(_HOUR),
    "weekend_ratio": "0",
    "edit_summary_rate": "coalesce(comment <> '', false)",
    "minor_edit_ratio": "minor",
    "session_count": "1",
    "first_edit_size": "greatest(bytes_diff, 0L)",
}


def partial_features(envelopes: DataFrame) -> DataFrame:
    keep = [c for c in ("user", "title", "ts", "corrupt") if c in envelopes.columns]
    return envelopes.selectExpr(
        *keep, *[f"double({text}) AS {name}" for name, text in _PROXIES.items()]
    )


def score_stream(
    features: DataFrame, model: LogRegModel, keep_corrupt: bool = True
) -> DataFrame:
    """Dropout risk per edit. Missing features count as 0, so a corrupt record scores as
    an edit with no known features unless it is left out."""
    if not keep_corrupt:
        features = features.filter(~F.col("corrupt"))
    return model.score(features, "dropout_risk").select(*schema.SCORED.fieldNames())
