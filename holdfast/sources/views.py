"""Views that present other event tables in the layouts of this package.

``orders`` gives years of history per customer, ``events`` gives a time of day and a
dense month. Both become clean edits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast import schema


def project(df: DataFrame, layout, known: dict[str, str], default: str = "NULL") -> DataFrame:
    """The columns of a layout from SQL text; columns without any get the default."""
    return df.selectExpr(
        *[
            f"CAST({known.get(f.name, default)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in layout.fields
        ]
    )


_ORDER_EDIT = {
    "wiki_db": "'orders'",
    "ts": "o_orderdate",
    "year": "year(o_orderdate)",
    "month": "month(o_orderdate)",
    "event_user_id": "o_custkey",
    "event_user_text": "concat('customer ', o_custkey)",
    "page_id": "o_orderkey % 1000",
    "page_namespace": "substring(o_orderpriority, 1, 1) IN ('1', '2')",
    "revision_id": "o_orderkey",
    "revision_minor_edit": "o_orderkey % 3 = 0",
    "revision_text_bytes": "round(o_totalprice)",
    "revision_text_bytes_diff": "round(o_totalprice) - 200000",
    "revision_is_identity_revert": "o_orderstatus = 'P'",
    "revision_is_identity_reverted": "o_orderstatus = 'F'",
    "event_comment": """CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
                        ELSE concat('order ', o_orderkey) END""",
}

EVENT_K = "bigint(get_json_object(props, '$.k'))"

_EVENT_EDIT = {
    "wiki_db": "'events'",
    "ts": "ts",
    "year": "year(ts)",
    "month": "month(ts)",
    "event_user_id": "user_id",
    "page_id": "event_id % 1000",
    "page_namespace": "event_type IN ('purchase', 'error')",
    "revision_id": "event_id",
    "revision_minor_edit": f"{EVENT_K} % 2 = 1",
    "revision_text_bytes": "round(value * 100)",
    "revision_text_bytes_diff": f"{EVENT_K} - 50",
    "revision_is_identity_reverted": "event_type = 'error'",
    "event_comment": f"if({EVENT_K} % 4 = 0, '', event_type)",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_as_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is an edit of its customer."""
    return project(table(spark, sf_dir, "orders"), schema.CLEAN, _ORDER_EDIT)


def events_as_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is an edit of its user."""
    return events_to_edits(table(spark, sf_dir, "events"))


def events_to_edits(events: DataFrame) -> DataFrame:
    return project(events, schema.CLEAN, _EVENT_EDIT)
