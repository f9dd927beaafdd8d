"""The operators as queries over the given tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from holdfast.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_dedup,
    merkle,
    near_dedup,
    quality,
    repeats,
    secret_scan,
    token_counts,
    topk,
    url_filter,
)
from holdfast.llm.oracle import ORACLE
from holdfast.workspace import materialize

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    url_filter.Rule.parse("allow", "org/"),
    url_filter.Rule.parse("block", "example.org/es/"),
    url_filter.Rule.parse("block", "example.org/en/1"),
    url_filter.Rule.parse("allow", "com/fr/"),
    url_filter.Rule.parse("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    base = [F.col(k) for k in secret_scan.PATTERNS]
    return found.select(
        "row.doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in secret_scan.PATTERNS],
        sha256(secret_scan.joined(*base)).alias("base_sha256"),
        secret_scan.joined(*[F.col(k) for k in secret_scan.KINDS]).alias("spans"),
    )


def op2_token_counts(spark, sf_dir, path=public_tokenizers.path("byte_bpe_50k.json")):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = token_counts.token_count(docs, path)
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    counted = docs.select("doc_id", n_bytes.alias("n_bytes"), n.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op3_bpe(spark, sf_dir, path=public_tokenizers.path("word_bpe_49k.json")):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.select("doc_id", bpe.coded(docs, path).alias("coded")).select("doc_id", "coded.*")
    return both.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        sha256(F.col("ids")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op4_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_texts", "kept")


def op5_url_filters(spark, sf_dir):
    rules = url_filter.rule_table(spark, URL_RULES)
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op6_substring_dedup(spark, sf_dir):
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    kept = sha256(F.col("kept")).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", kept)


def quality_labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")


def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialize(docs.select("doc_id", quality.statistics(docs).alias("x")), "measured")
    model = quality.fit(measured, quality_labels(spark, sf_dir))
    score = quality.score(measured, model, F.col("x"))
    scored = measured.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), score.alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op8_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.drop_frequent_lines(docs, min_docs=10, min_length=1)
    return cut.select(
        "row.doc_id", "n_lines", "n_dropped", sha256(F.col("row.text")).alias("kept_sha256")
    )


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="max")


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = merkle.without_newlines(F.col("text"), F.col("doc_id"))
    tree = merkle.manifest(docs, checked={"text": changed})
    root = F.lit(tree.root).cast("string")
    return merkle.proofs(tree).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, label)


def op13_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_token_counts,
        op3_bpe,
        op4_near_dedup,
        op5_url_filters,
        op6_substring_dedup,
        op7_quality,
        op8_decontaminate,
        op9_line_dedup,
        op10_exact_dedup,
        op11_merkle_manifest,
        op12_hard_negatives,
        op13_exact_topk,
    )
}

__all__ = ["ORACLE", "QUERIES"]
