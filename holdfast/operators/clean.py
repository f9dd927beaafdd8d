"""Cleaning the raw history: row filters, time parsing and projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schema
from holdfast.sources.files import LINE, REJECTED

MAIN_AND_TALK = (0, 1)


def is_revision() -> Column:
    return F.col("event_entity") == "revision"


def is_human() -> Column:
    """The bot column lists detection methods; nothing listed means no bot."""
    detected = F.col("event_user_is_bot_by")
    return detected.isNull() | (detected == "")


def is_registered() -> Column:
    """An unknown anonymity flag does not count as registered."""
    return ~F.col("event_user_is_anonymous")


def only_revisions(df: DataFrame) -> DataFrame:
    return df.filter(is_revision())


def drop_bots(df: DataFrame) -> DataFrame:
    return df.filter(is_human())


def drop_anonymous(df: DataFrame) -> DataFrame:
    return df.filter(is_registered())


def keep_namespaces(df: DataFrame, namespaces=MAIN_AND_TALK) -> DataFrame:
    return df.filter(F.col("page_namespace").isin(*namespaces))


def parse_time(df: DataFrame) -> DataFrame:
    """Add ``ts``, ``year`` and ``month``; an unreadable time gives NULL."""
    return df.withColumn("ts", F.try_to_timestamp("event_timestamp")).withColumns(
        {"year": F.year("ts"), "month": F.month("ts")}
    )


def prune(df: DataFrame) -> DataFrame:
    return df.select(*schema.CLEAN.fieldNames())


#: What became of a raw line that is kept, see :func:`with_status`.
ACCEPTED, MALFORMED_TIME, REJECTED_LINE = "accepted", "malformed_time", "rejected"


def with_status(lines: DataFrame, namespaces=MAIN_AND_TALK) -> DataFrame:
    """Clean edits and what is quarantined, with a ``status``, in one pass and without a shuffle.

    ``lines`` are those of ``files.read_raw_lines``. A line that does not fit the layout is
    ``rejected`` and has only its text (``line``); an edit that the filters keep but whose time
    is missing or unreadable is ``malformed_time`` and has the text of its time (``time``).
    """
    bad = F.col(REJECTED)
    kept = lines.filter(
        bad
        | (
            is_revision()
            & is_human()
            & is_registered()
            & F.col("page_namespace").isin(*namespaces)
        )
    )
    timed = parse_time(kept)
    status = (
        F.when(bad, REJECTED_LINE)
        .when(F.col("ts").isNull(), MALFORMED_TIME)
        .otherwise(ACCEPTED)
    )
    return timed.select(
        *[F.when(~bad, F.col(c)).alias(c) for c in schema.CLEAN.fieldNames()],
        F.when(status == MALFORMED_TIME, F.col("event_timestamp")).alias("time"),
        F.when(bad, F.col(LINE)).alias("line"),
        status.alias("status"),
    )


def clean(raw: DataFrame, namespaces=MAIN_AND_TALK) -> DataFrame:
    """Raw history to clean edits. Map-only: one scan, one filter, one projection."""
    kept = keep_namespaces(drop_anonymous(drop_bots(only_revisions(raw))), namespaces)
    return prune(parse_time(kept))
