"""Hand-made edits."""

from datetime import datetime, timedelta

from holdfast import schema

_DEFAULTS = {
    "wiki_db": "w",
    "event_user_id": "u",
    "page_namespace": 0,
    "revision_minor_edit": False,
    "revision_text_bytes": 100,
    "revision_text_bytes_diff": 10,
    "revision_is_identity_reverted": False,
    "event_comment": "c",
}


def edits_frame(spark, rows):
    """Clean edits from dictionaries with at least ``ts``; revision ids count up."""
    filled = []
    for i, row in enumerate(rows):
        full = {**_DEFAULTS, "revision_id": str(i + 1), **row}
        if isinstance(full["ts"], str):
            full["ts"] = datetime.fromisoformat(full["ts"])
        filled.append(tuple(full.get(name) for name in schema.CLEAN.fieldNames()))
    return spark.createDataFrame(filled, schema.CLEAN)


def daily(user, n, start="2023-01-01 12:00:00", **more):
    first = datetime.fromisoformat(start)
    return [{"event_user_id": user, "ts": first + timedelta(days=i), **more} for i in range(n)]
