"""Streaming sources and sinks. Anything with a ``value`` column can stand in for Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

TRIGGER = "60 seconds"


def kafka_options(bootstrap: str, api_key: str, api_secret: str) -> dict[str, str]:
    """Connection options for a broker that authenticates with a key over TLS.

    Fixed values: names and the login line are those of the Kafka client.
    """
    return {
        "kafka.bootstrap.servers": bootstrap,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f"username='{api_key}' password='{api_secret}';"
        ),
    }


def kafka_source(
    spark: SparkSession, topic: str, connection: dict[str, str], **options
) -> DataFrame:
    """Records of a topic, from the newest on when the query first starts.

    Set ``maxOffsetsPerTrigger`` to bound a batch after a long stop. Needs the Kafka
    connector package on the class path.
    """
    settings = {"subscribe": topic, "startingOffsets": "latest", **connection, **options}
    return spark.readStream.format("kafka").options(**settings).load()


def text_source(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines of the files that arrive in a folder, one record per line."""
    return spark.readStream.options(**options).text(path)


def table_source(
    spark: SparkSession, folder: str, file_name: str, layout: T.StructType, **options
) -> DataFrame:
    """Rows of the Parquet files in ``folder`` whose name matches ``file_name``."""
    return (
        spark.readStream.schema(layout)
        .options(pathGlobFilter=file_name, **options)
        .parquet(folder)
    )


def _start(writer, checkpoint: str, available_now: bool, trigger: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Append to files, each batch exactly once: a batch that is retried after a failure
    replaces its earlier attempt in the sink's log."""
    writer = df.writeStream.format(format).option("path", path).outputMode("append")
    return _start(writer, checkpoint, available_now, trigger)


def replace_batch(batch: DataFrame, batch_id: int, table: str, **options) -> None:
    """Put a batch into a catalogue table, in place of what an earlier attempt at the same
    batch left there: the table is partitioned by ``batch_id`` and only that one is replaced.
    ``options`` hold when the table is made, such as ``format`` and ``path``."""
    spark = batch.sparkSession
    if not spark.catalog.tableExists(table):
        empty = batch.limit(0).withColumn("batch_id", F.lit(0).cast("bigint"))
        writer = empty.write.partitionBy("batch_id").mode("ignore")
        writer.saveAsTable(table, **{"format": "parquet", **options})
    names = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != "batch_id")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) "
        f"SELECT {names} FROM {{rows}}",
        rows=batch,
    )


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table that a stream writes, as of now. A stream has a session of its own,
    so what this one remembers of the table's files may be old."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def table_sink(
    df: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str = TRIGGER,
    replace=replace_batch,
    **options,
) -> StreamingQuery:
    """Append to a catalogue table, each batch exactly once.

    Spark may run a batch again after a failure, with the same id and the same rows. Every
    batch is written as a whole under its id, so the second attempt replaces the first. Another
    target needs a ``replace`` that does the same for it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace(batch, batch_id, table, **options)

    return _start(df.writeStream.foreachBatch(write), checkpoint, available_now, trigger)


def kafka_sink(
    records: DataFrame,
    topic: str,
    connection: dict[str, str],
    checkpoint: str,
    available_now: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Publish ``value`` to a topic, acknowledged by all replicas."""
    writer = (
        records.select(F.col("value").cast("string").alias("value"))
        .writeStream.format("kafka")
        .options(**{"topic": topic, "kafka.acks": "all", "kafka.linger.ms": "200", **connection})
    )
    return _start(writer, checkpoint, available_now, trigger)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``available_now`` query; a failure in it is raised here."""
    query.awaitTermination()
