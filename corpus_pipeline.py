"""From raw documents to token ids: five stages, each stored before the next reads it."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from holdfast.llm.rows import whole_row
from holdfast.workspace import materialize, use_local_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

QUALITY_THRESHOLD = 0.7
FREQUENT_LINE = 10  # documents
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled ones, does not reject."""
    labels = _table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label")
    rows = docs.select(whole_row(docs), quality.statistics(docs).alias("x"))
    # Texts are measured once: the fit and the scores read the same stored table.
    rows = materialize(rows, "measured")
    model = quality.fit(rows.select("row.doc_id", "x"), labels)
    scored = rows.select("row", quality.score(rows, model, F.col("x")).alias("score"))
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many of them share; n_chars counts what is left."""
    cut = line_dedup.drop_frequent_lines(docs, min_docs=FREQUENT_LINE, min_length=1)
    left = F.length("row.text").cast("bigint")
    return cut.select(F.col("row").withField("n_chars", left).alias("row")).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return near_dedup.drop_near_duplicates(docs)


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaking(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (four bytes an id), and digests of ids and decoded text."""
    coded = docs.select("doc_id", bpe.coded(docs, TOKENIZER).alias("coded"))
    return coded.select("doc_id", "coded.*").select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def _with_folder(stage: Stage) -> Stage:
    """Stages store tables; a local session that names no folder for them gets one."""

    @functools.wraps(stage)
    def ready(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        use_local_folder(spark)
        return stage(spark, docs, sf_dir)

    return ready


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", _with_folder(keep_good)),
    ("line_dedup", _with_folder(drop_lines)),
    ("near_dedup", _with_folder(drop_near_copies)),
    ("decontamination", _with_folder(drop_leaking)),
    ("bpe", _with_folder(encode)),
]

#: SQL can express neither the fits nor the similarity search; tests compare by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each stored as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
