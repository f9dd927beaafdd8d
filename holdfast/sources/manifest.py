"""Which monthly files should exist, and which of them have not landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The header line of a transfer list and its file name pattern.
TRANSFER_HEADER = "TsvHttpData-1.0"
FILE_PATTERN = "%s/%s/%s/%s.%s.%s.tsv.bz2"
#: Year and month in the name of a history file, compressed or not.
MONTH_IN_NAME = r"(\d{4})-(\d{2})\.tsv(?:\.\w+)?$"


def month_manifest(
    bounds: DataFrame, base_url: str, wiki: str, snapshot: str
) -> DataFrame:
    """One row per month between ``first_month`` and ``last_month`` (dates, inclusive).

    ``bounds`` is a one-row DataFrame. Size -1 and an empty checksum tell the transfer
    service to find out itself.
    """
    month_text = F.date_format("month_start", "yyyy-MM")
    return (
        bounds.select(
            F.explode(
                F.sequence(
                    F.trunc("first_month", "month"),
                    F.trunc("last_month", "month"),
                    F.expr("interval 1 month"),
                )
            ).alias("month_start")
        )
        .select(
            F.year("month_start").alias("year"),
            F.month("month_start").alias("month"),
            F.format_string(
                FILE_PATTERN,
                F.lit(base_url.rstrip("/")),
                F.lit(snapshot),
                F.lit(wiki),
                F.lit(wiki),
                F.lit(snapshot),
                month_text,
            ).alias("url"),
            F.lit(-1).cast("bigint").alias("size"),
            F.lit("").alias("md5"),
        )
    )


def month_bounds(spark, start: str, end: str) -> DataFrame:
    """Bounds for :func:`month_manifest` from two ``yyyy-MM`` strings."""
    return spark.range(1).select(
        F.to_date(F.lit(start + "-01")).alias("first_month"),
        F.to_date(F.lit(end + "-01")).alias("last_month"),
    )


def observed_bounds(edits: DataFrame) -> DataFrame:
    """Bounds for :func:`month_manifest` from the first and last edit."""
    return edits.agg(
        F.to_date(F.min("ts")).alias("first_month"),
        F.to_date(F.max("ts")).alias("last_month"),
    )


def write_transfer_list(manifest: DataFrame, path: str) -> None:
    """The manifest as the text file a transfer service reads."""
    lines = manifest.select(
        F.lit(1).alias("part"),
        "url",
        F.concat_ws("\t", "url", F.col("size").cast("string"), "md5").alias("value"),
    )
    header = manifest.sparkSession.range(1).select(
        F.lit(0).alias("part"), F.lit("").alias("url"), F.lit(TRANSFER_HEADER).alias("value")
    )
    (
        header.unionByName(lines)
        .coalesce(1)
        .sortWithinPartitions("part", "url")
        .select("value")
        .write.mode("overwrite")
        .text(path)
    )


def landed_files(spark, path: str, month_pattern: str = MONTH_IN_NAME) -> DataFrame:
    """Files under ``path`` with the ``year`` and ``month`` that their path names (NULL if none),
    and their size. Only the listing is read, never a file.

    ``month_pattern`` has a group for the year and one for the month, and applies to the path
    below ``path``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    # The part of the path that lies below the folder, wherever the folder's own name ends.
    root = path.rstrip("/").rsplit("/", 1)[-1]
    below = F.substring_index("path", f"/{root}/", -1)
    year, month = (
        F.nullif(F.regexp_extract(below, month_pattern, i), F.lit("")).cast("int") for i in (1, 2)
    )
    return files.select(
        below.alias("name"),
        "length",
        year.alias("year"),
        month.alias("month"),
    )


def landing_faults(manifest: DataFrame, landed: DataFrame, min_bytes: int = 15) -> DataFrame:
    """What is wrong with a landing: ``fault``, ``year``, ``month``, ``name``, ``bytes``.

    ``missing``: a month of the manifest without a file; ``empty``: one whose files have fewer
    than ``min_bytes`` together (an empty bz2 file has 14); ``size``: one whose files do not add
    up to the size that the manifest states; ``unexpected``: a file of a month that the manifest
    does not have, or of none.
    """
    sizes = (
        landed.filter(F.col("year").isNotNull())
        .groupBy("year", "month")
        .agg(F.sum("length").alias("bytes"))
    )
    both = manifest.join(sizes, ["year", "month"], "left")
    fault = (
        F.when(F.col("bytes").isNull(), "missing")
        .when(F.col("bytes") < min_bytes, "empty")
        .when((F.col("size") >= 0) & (F.col("size") != F.col("bytes")), "size")
    )
    expected = manifest.select("year", "month")
    unexpected = landed.join(expected, ["year", "month"], "left_anti").select(
        F.lit("unexpected").alias("fault"),
        "year",
        "month",
        "name",
        F.col("length").alias("bytes"),
    )
    wrong = both.select(
        fault.alias("fault"),
        "year",
        "month",
        F.element_at(F.split("url", "/"), -1).alias("name"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
    )
    return wrong.filter(F.col("fault").isNotNull()).unionByName(unexpected)


def missing_months(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows for whose month no clean edit has landed."""
    have = landed.filter(F.col("year").isNotNull()).select("year", "month").distinct()
    return manifest.join(have, ["year", "month"], "left_anti")
