"""Frequent lines: levelled sorted runs of line hashes with the documents that hold them."""

from __future__ import annotations

import string
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.rows import whole_row
from holdfast.workspace import materialize, new_path, remove

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["a", "b"]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(slow)


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_keys(text: Column) -> Column:
    return F.transform(lines(lower_ascii(text)), lambda x: F.btrim(x, F.lit(BLANKS)))


def key_hash(key: Column) -> Column:
    """128 bits: two hashes of different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def distinct_hashes(keys: Column, min_length: int) -> Column:
    long_enough = F.filter(keys, lambda k: F.length(k) >= min_length)
    return F.transform(F.array_distinct(long_enough), key_hash)


def contains(ordered: Column, value: Column) -> Column:
    """Whether an ordered array holds a value: by halves, or one by one if it is short. NULL for
    a NULL array."""
    n = F.size(ordered)
    powers = F.transform(
        F.sequence(F.lit(0), F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")),
        lambda i: F.call_function("shiftleft", F.lit(1), i),
    )
    place = F.aggregate(
        F.reverse(powers),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= n) & (F.try_element_at(ordered, low + step) <= value), low + step
        ).otherwise(low),
    )
    by_halves = (place > 0) & (F.try_element_at(ordered, F.greatest(place, F.lit(1))) == value)
    return F.when(n <= 16, F.array_contains(ordered, value)).otherwise(by_halves)


def document_counts(docs: DataFrame, text_column: str, min_length: int, *by: Column) -> DataFrame:
    """Rows (by..., a, b, n): in how many rows of ``docs`` a line occurs."""
    keys = line_keys(F.coalesce(text_column, F.lit("")))
    held = docs.select(*by, F.explode(distinct_hashes(keys, min_length)).alias("h"))
    names = [c for c in held.columns if c != "h"]
    return held.select(*names, "h.*").groupBy(*names, *HASH).agg(F.count(F.lit(1)).alias("n"))


class BucketedTable:
    """Rows (a, b, n) in numbered parts, each cut into the same buckets by hash and sorted there.

    A bucket of one part is one file, so parts are joined and summed as they lie, without an
    exchange. The files are under the shared folder; the table is known to this session only.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None):
        self.spark = spark
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.path = new_path(spark, name)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.exists = False

    def append(self, rows: DataFrame) -> None:
        """Add rows (a, b, n, part). Spark leaves the exchange out if they lie right already."""
        placed = rows.repartition(self.buckets, *HASH).select(*HASH, "n", "part")
        writer = placed.write.mode("append").partitionBy("part").option("path", self.path)
        writer.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(self.name)
        self.exists = True

    def read(self, *parts: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("part").isin(*parts)).select(*HASH, "n")

    def drop_part(self, part: int) -> None:
        remove(self.spark, f"{self.path}/part={part}")
        self.spark.catalog.refreshTable(self.name)

    def drop(self) -> None:
        if self.exists:
            self.spark.sql(f"DROP TABLE {self.name}")
        self.exists = False
        remove(self.spark, self.path)


class LineRuns:
    """An index of lines in levels of runs (a, b, n), bucketed and sorted by hash.

    ``add`` takes the counts of a batch, leaves out by merge-anti-join what a run already
    holds as settled (in ``settled`` documents or more), and stores the rest as a new run.
    ``fanout`` runs of a level are merged into one of the next, so that there are only about
    ``fanout`` times the logarithm of the number of batches. Counts of a line add up over runs.
    Runs have ``buckets`` buckets, as many as there are shuffle partitions if not given; anti-joins
    and merges shuffle no run.
    """

    def __init__(
        self, spark: SparkSession, settled: int, fanout: int = 4, buckets: int | None = None
    ):
        self.spark, self.settled, self.fanout = spark, settled, fanout
        self.table = BucketedTable(spark, "line_runs", buckets)
        self.levels: list[list[int]] = [[]]
        self._next = 0

    def _stored(self) -> list[int]:
        return [run for level in self.levels for run in level]

    def _store(self, run: DataFrame, level: int) -> None:
        self.table.append(run.withColumn("part", F.lit(self._next)))
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(self._next)
        self._next += 1

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """``counts`` without the lines that a run holds as settled."""
        for run in self._stored():
            known = self.table.read(run).where(F.col("n") >= self.settled)
            counts = counts.join(known.hint("merge"), HASH, "left_anti")
        return counts

    def add(self, counts: DataFrame) -> None:
        self._store(self.unsettled(counts), 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self._compact(level)

    def _compact(self, level: int) -> None:
        old, self.levels[level] = self.levels[level], []
        self._store(self.summed(old), level + 1)
        for run in old:
            self.table.drop_part(run)

    def summed(self, runs: list[int]) -> DataFrame:
        return self.table.read(*runs).groupBy(*HASH).agg(F.sum("n").alias("n"))

    def at_least(self, n: int) -> DataFrame:
        """Hashes of the lines in ``n`` documents or more, for n up to ``settled``."""
        if not self._stored():
            return self.spark.createDataFrame([], "a bigint, b bigint")
        return self.summed(self._stored()).where(F.col("n") >= n).select(*HASH)

    def remove(self) -> None:
        self.table.drop()
        self.levels = [[]]

    def novel(self, docs: DataFrame, text_column: str = "text", min_length: int = 1) -> DataFrame:
        """Hashes of the lines in ``docs`` that no run holds."""
        fresh = document_counts(docs, text_column, min_length)
        runs = [self.table.read(run).hint("merge") for run in self._stored()]
        return reduce(lambda left, run: left.join(run, HASH, "left_anti"), runs, fresh)


def index_lines(
    docs: DataFrame, text_column: str, min_docs: int, min_length: int, batches: int, fanout: int
) -> LineRuns:
    """The runs of all lines of ``docs``, added in ``batches`` by a hash of the text.

    The counts of all batches are bucketed as the runs are, by their only exchange."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64(text_column), F.lit(batches)).cast("int").alias("part")
    runs = LineRuns(spark, min_docs, fanout)
    fresh = BucketedTable(spark, "line_batches", runs.table.buckets)
    fresh.append(document_counts(docs, text_column, min_length, batch))
    for i in range(batches):
        runs.add(fresh.read(i))
    fresh.drop()
    return runs


def drop_frequent_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_docs: int = 10,
    min_length: int = 1,
    batches: int = 8,
    fanout: int = 4,
) -> DataFrame:
    """``docs`` with the lines removed whose key stands in ``min_docs`` rows or more.

    Adds n_lines and n_dropped; the result is a struct column ``row`` of the input columns
    (text cut), beside the two counts, so that input columns may have any name. A key is the
    line without blanks at its ends, A-Z in lower case; keys shorter than ``min_length`` stay.

    Rows count as documents: repeated rows count again. A NULL text counts as empty, and an
    empty text is one empty line. A document that loses all its lines stays, with empty text.
    A document of n lines costs n log n, however many of them go.
    """
    body = F.coalesce(text_column, F.lit(""))
    runs = index_lines(docs, text_column, min_docs, min_length, batches, fanout)
    # Stored, so that the join below reads it as a table and can split a common line's rows.
    frequent = materialize(runs.at_least(min_docs), "frequent")
    runs.remove()
    # Two documents under one key do no harm: what a key gathers are frequent lines only.
    key = F.xxhash64(id_column, body).alias("key")
    held = docs.select(key, F.explode(distinct_hashes(line_keys(body), min_length)).alias("h"))
    flagged = (
        held.select("key", "h.*")
        .join(frequent, HASH, "left_semi")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set(F.struct(*HASH))).alias("flagged"))
    )
    rows = docs.select(key, whole_row(docs), body.alias("body"))
    marked = rows.join(flagged.hint("shuffle_hash"), "key", "left")
    with_key = F.zip_with(
        lines(F.col("body")),
        F.col("keys"),
        lambda line, k: F.struct(line.alias("line"), key_hash(k).alias("h")),
    )
    kept = F.transform(
        F.filter(with_key, lambda x: ~contains(F.col("flagged"), x["h"])),
        lambda x: x["line"],
    )
    cut = F.when(F.col("flagged").isNull(), lines(F.col("body"))).otherwise(kept)
    n_lines = F.size(lines(F.col("body"))).cast("bigint")
    parts = marked.withColumn("keys", line_keys(F.col("body"))).select(
        "row", n_lines.alias("n_lines"), cut.alias("cut")
    )
    text = F.array_join("cut", "\n")
    return parts.select(
        F.col("row").withField(f"`{text_column}`", text).alias("row"),
        "n_lines",
        (F.col("n_lines") - F.size("cut")).alias("n_dropped"),
    )
