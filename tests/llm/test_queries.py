"""Queries over the given tables: against SQL, or against brute force."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks import compare
from holdfast.llm import queries

from .helpers import sha
from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute_classes
from .test_repeats import brute as brute_repeats
from .test_secret_scan import brute as brute_secrets


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_small, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "ORACLE", queries.ORACLE)
    assert compare.differences(spark, compare.duck(sf_small), sf_small, name) == []


def texts(spark, sf_dir, name="documents"):
    rows = queries.table(spark, sf_dir, name).collect()
    return {r[0]: r.text for r in rows}


def test_secrets(spark, sf_small):
    docs = texts(spark, sf_small)
    for r in queries.op1_secret_scan(spark, sf_small).collect():
        want = brute_secrets(docs[r.doc_id])
        counts = Counter(kind for *_, kind in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in want))


def test_substring_dedup(spark, sf_small):
    docs = texts(spark, sf_small)
    want = dict(zip(docs, brute_repeats(docs.values(), 35)))
    for r in queries.op6_substring_dedup(spark, sf_small).collect():
        n, removed, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, removed, sha(kept))


def test_near_dedup(spark, sf_small):
    docs = texts(spark, sf_small)
    got = {r.doc_id: r.class_id for r in queries.op4_near_dedup(spark, sf_small).collect()}
    assert got == brute_classes(list(docs.items()))


def test_decontamination(spark, sf_small):
    docs, items = texts(spark, sf_small), texts(spark, sf_small, "benchmark")
    want = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    found = queries.op8_decontaminate(spark, sf_small).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want


def test_pipeline_stages(spark, sf_small):
    """Every stage on what the one before kept, against brute force where there is one."""
    docs, kept = queries.table(spark, sf_small, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        kept.append(docs)
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_small), "stage")
    assert all(k.dtypes == kept[0].dtypes for k in kept)
    whole, good, cut, single, clean = ({r.doc_id: r for r in k.collect()} for k in kept)
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_small, "labels").collect()}
    assert all(labels.get(i, 0) == 0 for i in whole.keys() - good.keys())
    want = brute_lines([r.text for r in good.values()], corpus_pipeline.FREQUENT_LINE)
    assert {i: r.text for i, r in cut.items()} == dict(zip(good, (t for t, _, _ in want)))
    assert all(r.n_chars == len(r.text) for r in cut.values())
    classes = brute_classes([(i, r.text) for i, r in cut.items()])
    assert single.keys() == set(classes.values())
    items = texts(spark, sf_small, "benchmark").values()
    assert clean.keys() == {i for i, r in single.items() if not any(t in r.text for t in items)}
    encoded = {r.doc_id: r for r in docs.collect()}
    assert encoded.keys() == clean.keys()
    assert all(r.n_tokens * 4 == len(r.ids) for r in encoded.values())
    assert corpus_pipeline.run(spark, sf_small).count() == len(clean)


@pytest.mark.parametrize("texts", [[], [None], ["", None, " "], ["a b c d e f g " * 30] * 12])
def test_pipeline_on_odd_tables(spark, tmp_path, texts):
    rows = [(i, t, None, "s", None) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    left = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(left) == len({re.sub(r"\s", "", t or "") if t and t.strip() else t or "" for t in texts})


def test_pipeline_on_repeated_ids_and_columns_of_any_name(spark, tmp_path):
    """Columns named like the ones that stages make come through; an id with two texts, a
    repeated row and a NULL id are defined."""
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [
        (1, long, "en", "s", 1),
        (2, long + " end", "en", "s", 2),  # near 1: goes
        (3, other, "en", "s", 3),
        (3, other, "en", "s", 3),  # the same row again: one document
        (4, "a text of its own, short", "en", None, 4),
        (4, "and another text under the same id", None, "s", 5),
        (None, "a text without an id", "en", "s", 6),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    more = ["row", "x", "score", "label", "a", "b", "id0", "body", "class_id", "key", "id.0"]
    docs = spark.createDataFrame(rows, schema).select(
        "*", *[F.concat(F.lit(name), F.col("n_chars")).alias(name) for name in more]
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = corpus_pipeline.materialize(stage(spark, left, str(tmp_path)), "stage")
        assert left.dtypes == docs.dtypes, name
    kept = left.collect()
    assert {(r.doc_id, r.text) for r in kept} == {(r[0], r[1]) for r in rows if r[0] != 2}
    number = {(r[0], r[1]): r[4] for r in rows}
    for r in kept:
        assert r.n_chars == len(r.text)
        assert all(r[name] == f"{name}{number[r.doc_id, r.text]}" for name in more)
    encoded = corpus_pipeline.run(spark, str(tmp_path))
    assert encoded.count() == len(kept)


def test_every_query_covers_every_row(spark, sf_small):
    for name in ("op1_secret_scan", "op2_token_counts", "op3_bpe", "op4_near_dedup", "op7_quality"):
        found = queries.QUERIES[name](spark, sf_small)
        assert found.agg(F.count_distinct("doc_id")).first()[0] == 200, name
