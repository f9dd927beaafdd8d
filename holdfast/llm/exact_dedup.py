"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.workspace import materialize


def md5_128(text: Column) -> Column:
    """The 16 bytes of a text's MD5."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "min",
    content_hash: Callable[[Column], Column] = md5_128,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the id that stays of equal texts, ``min`` or ``max``. Grouping by hash and
    text compares bytes, and its map-side half reduces any number of copies to one row per
    task, so texts move once and no group meets in one task. What goes back to the rows is
    joined by hash alone. Hashes that stand for several texts go back by their text instead.

    A NULL text counts as empty, empty texts are equal. A NULL id never wins over another; a
    group of NULL ids has keep_id NULL and keeps all. Repeated rows share one answer. Only the
    two named columns are read, so others may have any name.
    """
    best = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("body")
    ).withColumn("hash", content_hash(F.col("body")))
    by_text = rows.groupBy("hash", "body").agg(
        best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = materialize(by_text.drop("body"), "groups")
    members = rows.withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256))
    collided = groups.groupBy("hash").count().where("count > 1").select("hash")
    if collided.isEmpty():
        found = members.drop("body").join(groups, "hash")
    else:
        alone = groups.join(collided, "hash", "left_anti")
        shared = by_text.join(collided, "hash", "left_semi")
        found = (
            members.drop("body")
            .join(alone, "hash")
            .unionByName(members.join(shared, ["hash", "body"]).drop("body"))
        )
    return found.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
