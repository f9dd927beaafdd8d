"""URL rules by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import whole_row


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str  # "allow" or "block"

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(host, slash + path, verdict)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules: Iterable[Rule]) -> DataFrame:
    return spark.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string"
    )


def short_prefix(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest."""
    return F.substring(digest, 1, 8)


def judge(
    pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """``row`` (struct of the input columns), host, path, rule, verdict for each input row.

    Each different URL is expanded into the pairs of host suffix and path prefix whose shape
    (number of labels, length of path) some rule has. The first 32 bits of their SHA-256 meet
    those of the rules in an equi-join; the full digest confirms; the longest rule wins, of
    equally long ones that with the longer host, then block. No rule: ``default``.

    ``rules`` (host, path, verdict) may be any table; the planner broadcasts it only below its
    own size limit. URLs are made distinct first and the verdict depends on the URL alone, so
    pages of one host or repeated pages weigh nothing. NULL or no ``://``: host and path empty,
    no rule. Repeated rules count once; rules or pages may be empty; a rule with a NULL part
    never fits.
    """
    spark = pages.sparkSession
    rules = rules.select("host", "path", "verdict").dropna().distinct()
    labels = F.size(F.split("host", "[.]")).alias("labels")
    shapes = rules.select(labels, F.length("path").alias("length")).distinct()
    # As many entries as the rules have shapes: hosts of so many labels, paths so long.
    shape_list = [(r.labels, r.length) for r in shapes.collect()]

    urls = pages.select(F.col(url_column).alias("url")).where("url IS NOT NULL").distinct()
    parts = urls.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    expressions = F.array(
        *[
            F.when(
                (F.size(F.split("h", "[.]")) >= n) & (F.length("p") >= m),
                F.concat(F.substring_index("h", ".", -n), F.lit("\n"), F.expr(f"left(p, {m})")),
            )
            for n, m in shape_list
        ]
    ).cast("array<string>")
    asked = (
        parts.select("url", F.explode(expressions).alias("expression"))
        .where("expression IS NOT NULL")
        .withColumn("digest", F.sha2("expression", 256))
        .withColumn("prefix", short_prefix(F.col("digest")))
        .drop("expression")
    )
    known = rules.withColumn(
        "rule_digest", F.sha2(F.concat("host", F.lit("\n"), "path"), 256)
    ).withColumn("prefix", short_prefix(F.col("rule_digest")))
    rank = F.struct(
        F.length(F.concat("host", "path")).alias("length"),
        F.length("host").alias("host_length"),
        (F.col("verdict") == "block").alias("block"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    best = (
        asked.join(known, "prefix")
        .where("digest = rule_digest")
        .groupBy("url")
        .agg(F.max(rank).alias("best"))
    )
    rows = pages.select(whole_row(pages), F.col(url_column).alias("url"))
    return rows.join(best, "url", "left").select(
        "row",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
