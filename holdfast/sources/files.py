"""File sources and sinks."""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import schema


LINE = "_line"
#: True for a line whose number of cells is not that of the layout.
REJECTED = "_rejected"


def read_raw_lines(
    spark: SparkSession,
    path: str,
    layout: T.StructType = schema.RAW,
    pattern: str = "*.tsv.bz2",
) -> DataFrame:
    """Every line of headerless tab-separated history files, and whether it is rejected.

    Cells that do not parse become NULL. Columns bind by position, so a line with another
    number of cells than the layout has can not be bound; ``_line`` is its text.
    """
    with_line = T.StructType([*layout.fields, T.StructField(LINE, T.StringType())])
    # The reader keeps the text of a line only if a cell or their number does not fit. A line
    # of one cell equals its first cell; that is asked as well, because the reader does not
    # tell about lines of which no column is read.
    first = F.col(layout[0].name)
    wrong = (F.size(F.split(LINE, "\t", -1)) != len(layout)) | first.eqNullSafe(F.col(LINE))
    return (
        spark.read.schema(with_line)
        .option("pathGlobFilter", pattern)
        .option("sep", "\t")
        .option("header", False)
        .option("quote", "")
        .option("escape", "")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)  # with it, cells beyond the last one used go unseen
        .csv(path)
        .withColumn(REJECTED, F.col(LINE).isNotNull() & wrong)
    )


def accepted(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col(REJECTED)).drop(LINE, REJECTED)


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that can not be bound: their first cell, number of cells, and text."""
    return lines.filter(REJECTED).select(
        F.split(LINE, "\t").getItem(0).alias("first_cell"),
        F.size(F.split(LINE, "\t", -1)).alias("cells"),
        F.col(LINE).alias("line"),
    )


def line_counts() -> list[Column]:
    """For ``observe``: all lines of a raw table, and how many of them are rejected."""
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col(REJECTED)).alias("rejected"),
    ]


def read_revision_tsv(
    spark: SparkSession,
    path: str,
    layout: T.StructType = schema.RAW,
    pattern: str = "*.tsv.bz2",
) -> DataFrame:
    """The lines that have as many cells as the layout. See :func:`read_raw_lines`."""
    return accepted(read_raw_lines(spark, path, layout, pattern))


def write_clean(df: DataFrame, path: str, grouped_by_month: bool = False) -> None:
    """Write clean edits partitioned by year and month.

    History files cover one month each, so every task already writes to about one
    partition and no shuffle is needed (``grouped_by_month=True``). Otherwise rows are
    first rebalanced by month, where adaptive execution splits a month that is too large
    and merges months that are too small.
    """
    if not grouped_by_month:
        df = df.hint("rebalance", "year", "month")
    df.write.mode("overwrite").partitionBy("year", "month").parquet(path)


def write_by_status(df: DataFrame, path: str) -> None:
    """Write edits and what is quarantined in one pass, partitioned by status, year and month.

    Each task writes what it reads. A reader of accepted months lists only their folders.
    """
    df.write.mode("overwrite").partitionBy("status", "year", "month").parquet(path)


def read_status(spark: SparkSession, path: str, status: str) -> DataFrame:
    """What :func:`write_by_status` wrote under a status: clean edits, ``time`` and ``line``."""
    more = [T.StructField(c, T.StringType()) for c in ("time", "line", "status")]
    layout = T.StructType([*schema.CLEAN.fields, *more])
    return spark.read.schema(layout).parquet(path).filter(F.col("status") == status).drop("status")


def read_clean(
    spark: SparkSession,
    path: str,
    start: tuple[int, int] | None = None,
    end: tuple[int, int] | None = None,
) -> DataFrame:
    """Clean edits, optionally of the months ``start`` to ``end`` (both included).

    The bounds are on partition columns, so folders outside them are never listed.
    """
    df = spark.read.schema(schema.CLEAN).parquet(path)
    year, month = F.col("year"), F.col("month")
    if start:
        df = df.filter((year > start[0]) | ((year == start[0]) & (month >= start[1])))
    if end:
        df = df.filter((year < end[0]) | ((year == end[0]) & (month <= end[1])))
    return df


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.FEATURES).parquet(path)


def save_json(spark: SparkSession, obj: dict[str, Any], path: str) -> None:
    """Write one model or metrics object as a single indented JSON text."""
    text = json.dumps(obj, indent=2)
    one = spark.createDataFrame([(text,)], "value string")
    one.coalesce(1).write.mode("overwrite").text(path)


def load_json_frame(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The saved object as a one-row DataFrame of the given layout."""
    return spark.read.schema(layout).option("multiLine", True).json(path)


def load_json(spark: SparkSession, path: str) -> dict[str, Any]:
    """The saved object as a dictionary. Its size is that of a model, not of the data."""
    return json.loads(spark.read.text(path, wholetext=True).first().value)


def load_json_optional(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """As :func:`load_json`, but an object that was never written gives ``None``."""
    try:
        return load_json(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_results(df: DataFrame, target: str, format: str = "parquet", **options) -> None:
    """Replace the results table.

    ``target`` is a path for file formats and a table name otherwise, so a warehouse
    connector is chosen with ``format`` and configured with ``options``.
    """
    writer = df.write.mode("overwrite").format(format).options(**options)
    if format in ("parquet", "orc", "json", "csv"):
        writer.save(target)
    elif format == "table":
        df.write.mode("overwrite").options(**options).saveAsTable(target)
    else:
        writer.option("table", target).save()


def write_summary(spark: SparkSession, summary: dict[str, Any], folder: str) -> None:
    save_json(spark, summary, folder.rstrip("/") + "/summary.json")
