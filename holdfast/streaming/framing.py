"""The change feed as it comes over the wire: events framed by empty lines.

An event is a block of ``name: value`` lines that an empty line ends. ``data`` lines of an event
are joined by line ends, lines that begin with a colon are comments, and an event without data
is none. Only events of the type ``message`` are changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "message"
#: Where a block stands among all that have landed, see :func:`with_place`.
PLACE = "_place"


def framed_source(spark: SparkSession, path: str, line_end: str = "\n", **options) -> DataFrame:
    """Blocks of the files that arrive in a folder, one record each, whatever their length.

    Files are split at empty lines, so a file ends with a whole event. ``line_end`` is that of
    the feed.
    """
    return spark.readStream.option("lineSep", line_end * 2).options(**options).text(path)


def read_framed(spark: SparkSession, path: str, line_end: str = "\n") -> DataFrame:
    """The blocks that have landed so far, with their place."""
    blocks = spark.read.option("lineSep", line_end * 2).text(path)
    return with_place(blocks)


def with_place(blocks: DataFrame) -> DataFrame:
    """Add the order of landing: by file, by part of the file, and inside the part."""
    place = F.struct(
        "_metadata.file_modification_time",
        "_metadata.file_path",
        "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("row"),
    )
    return blocks.select("value", place.alias(PLACE))


def _field(line: Column) -> Column:
    """Name and value of a line; one blank after the colon is not part of the value."""
    at = F.instr(line, ":")
    text = F.regexp_replace(F.substring(line, at + 1, F.length(line)), "^ ", "")
    return F.struct(
        F.when(at == 0, line).otherwise(F.substring(line, F.lit(1), at - 1)).alias("name"),
        F.when(at == 0, F.lit("")).otherwise(text).alias("text"),
    )


def parse_events(blocks: DataFrame) -> DataFrame:
    """``id``, ``event`` and ``data`` of each block that has data, beside the block's place.

    The type of an event without one is ``message``; of repeated fields the last counts. ``id``
    is NULL where the event has none. Unknown fields are ignored.
    """
    text = F.regexp_replace("value", "^\ufeff", "")
    fields = F.transform(F.split(text, "\r\n|\n|\r", -1), _field)
    read = blocks.withColumn("_fields", fields)
    of = lambda name: F.transform(
        F.filter("_fields", lambda f: f["name"] == name), lambda f: f["text"]
    )
    ids = F.filter(of("id"), lambda x: F.instr(x, "\0") == 0)
    read = read.select(
        *[c for c in blocks.columns if c != "value"],
        F.nullif(F.try_element_at(ids, F.lit(-1)), F.lit("")).alias("id"),
        F.coalesce(
            F.nullif(F.try_element_at(of("event"), F.lit(-1)), F.lit("")), F.lit(MESSAGE)
        ).alias("event"),
        of("data").alias("_data"),
    )
    with_data = read.where(F.size("_data") > 0)
    return with_data.withColumn("data", F.array_join("_data", "\n")).drop("_data")


def messages(events: DataFrame) -> DataFrame:
    """The data of the messages, as the lines that :mod:`feed` reads."""
    kept = events.where(F.col("event") == MESSAGE)
    return kept.withColumnRenamed("data", "value").drop("event")


def resume_point(events: DataFrame) -> DataFrame:
    """One row: the ``id`` of the event that landed last of those that have one. A client that
    connects again sends it, and the feed goes on from there. NULL if there is none.

    ``events`` are those of :func:`read_framed`. A maximum per task; no row is shuffled.
    """
    known = events.where(F.col("id").isNotNull())
    return known.agg(F.max_by("id", PLACE).alias("id"))


def without_replays(lines: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``lines`` (id, value) of a stream without events that an earlier connection delivered.

    After a break the feed repeats some events; they have the same ``id``. Ids are remembered
    until the watermark, ``delay`` behind the newest change, has passed their change's time, so
    the state is bounded by the changes of that time; a change that is later than that is lost,
    so it should exceed any break. Events without an id all stay.
    """
    at = F.expr("timestamp_seconds(try_cast(get_json_object(value, '$.timestamp') AS bigint))")
    timed = lines.withColumn("_at", F.coalesce(at, F.current_timestamp()))
    named = timed.where(F.col("id").isNotNull()).withWatermark("_at", delay)
    once = named.dropDuplicatesWithinWatermark(["id"]).drop("_at")
    return once.unionByName(lines.where(F.col("id").isNull()))
