import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.llm import quality, queries, words

from .helpers import CLASHING, ODD_TEXTS, docs_frame, prose

D = len(quality.STATISTICS)


def junk(seed):
    rng = random.Random(seed)
    return "!! ".join(w.upper() for w in prose(seed, rng.randrange(10, 80))) + "!!"


def labelled(spark, n=200):
    rows = [(i, junk(i) if i % 3 == 0 else " ".join(prose(i, 30 + i % 50)) + ".") for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(n)], "doc_id bigint, label int")
    return rows, labels


def scores(spark, docs, labels):
    measured = docs.select("doc_id", quality.statistics(docs).alias("x"))
    model = quality.fit(measured, labels)
    out = docs.select("doc_id", quality.statistics(docs).alias("x"))
    return {r.doc_id: r.s for r in out.select("doc_id", quality.score(out, model, F.col("x")).alias("s")).collect()}


def test_separates_held_out_documents_and_scores_odd_ones(spark):
    rows, labels = labelled(spark)
    odd = [(10_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id")]
    got = scores(spark, docs_frame(spark, rows + odd, [c for c in CLASHING if c != "x"]), labels)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) == (i % 3 > 0) for i in held]) > 0.95
    assert len(got) == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())


def test_labels_of_held_out_documents_change_nothing(spark):
    rows, labels = labelled(spark, 80)
    flipped = labels.withColumn("label", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("label")).otherwise(F.col("label")))
    docs = docs_frame(spark, rows)
    a, b = scores(spark, docs, labels), scores(spark, docs, flipped)
    assert a == pytest.approx(b, abs=1e-9)
    flags = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in flags)


@pytest.mark.parametrize("label, want", [(1, 1.0), (0, 0.0), (None, 0.5)])
def test_without_labels_of_both_kinds_the_share_is_the_score(spark, label, want):
    rows, labels = labelled(spark, 20)
    labels = labels.withColumn("label", F.lit(label).cast("int"))
    assert set(scores(spark, docs_frame(spark, rows), labels).values()) == {want}


def test_empty_table(spark):
    _, labels = labelled(spark, 3)
    assert scores(spark, docs_frame(spark, []), labels) == {}


def test_log_density_equals_the_direct_formula():
    rng = np.random.default_rng(5)
    x = {c: rng.normal(c, 1 + c, (300, D)) @ rng.normal(size=(D, D)) for c in (0, 1)}
    moments = np.stack([np.concatenate([[300], x[c].sum(0), (x[c].T @ x[c]).ravel()]) for c in (0, 1)])
    model = quality.Discriminant.from_moments(moments, 0.2)
    within = [np.cov(x[c].T, bias=True) for c in (0, 1)]
    target = np.diag(np.diag((within[0] + within[1]) / 2))
    probe = np.concatenate([x[0][:20], x[1][:20]])
    density = []
    for c in (0, 1):
        covariance = 0.8 * within[c] + 0.2 * target
        centered = probe - x[c].mean(0)
        maha = (centered * np.linalg.solve(covariance, centered.T).T).sum(1)
        density.append(np.log(0.5) - 0.5 * (maha + np.linalg.slogdet(covariance)[1]))
    want = 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))
    assert model.score(probe) == pytest.approx(want, abs=1e-6)


def test_statistics_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Aa bb, aa AA!", "", "x y x y x y", "é\n1234 ."]
    together = quality.block_statistics(next(words.blocks(pa.array(texts), quality._TABLE))[1])
    alone = [quality.block_statistics(next(words.blocks(pa.array([t]), quality._TABLE))[1])[0] for t in texts]
    assert together == pytest.approx(np.stack(alone))
    assert not together[1].any()


def test_query_is_accurate_on_held_out_labels(spark, sf_check):
    got = queries.op7_quality(spark, sf_check).collect()
    known = {r.doc_id: r.quality for r in queries.table(spark, sf_check, "labels").collect()}
    right = [r.predicted == known[r.doc_id] for r in got if r.held_out and r.doc_id in known]
    assert np.mean(right) > 0.97


def plain_statistics(text):
    """The statistics of a text, one after the other."""
    data = (text or "").encode()
    blanks = b" \t\n\x0b\x0c\r"
    body = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    for a in range(0x80, 0x9F):
        if a != 0x97:
            body = body.replace(bytes([0xC3, a]), bytes([0xC3, a + 32]))
    own, raw, at = [], [], 0
    while at < len(data):
        end = at
        while end < len(data) and data[end] not in blanks:
            end += 1
        if end > at:
            own.append(body[at:end])
            raw.append(data[at:end])
        at = end + 1
    if not data:
        return [0.0] * D
    kinds = dict.fromkeys(quality._CLASSES, 0)
    for b in data:
        c = chr(b)
        kind = (
            "beyond_ascii" if b > 127 else "newline" if c == "\n" else "blank" if c.isspace()
            else "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit()
            else "stop" if c in ".," else "mark"
        )
        kinds[kind] += 1
    n = max(len(own), 1)
    lengths = [len(w) for w in own]
    mean = sum(lengths) / n
    deviation = math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0))
    triples = list(zip(own, own[1:], own[2:]))
    marks = [w[-1] < 128 and not chr(w[-1]).isalnum() and chr(w[-1]) not in ".," and not chr(w[-1]).isspace() for w in raw]
    shares = [kinds[k] / len(data) for k in quality._CLASSES]
    shares += [
        len(set(own)) / n,
        max(Counter(own).values(), default=0) / n,
        len(set(triples)) / len(triples) if triples else float(bool(own)),
        sum(a == b for a, b in zip(own, own[1:])) / n,
        sum(x == 1 for x in lengths) / n,
        sum(marks) / n,
    ]
    sizes = [math.log1p(len(own)), math.log1p(mean), math.log1p(max(lengths, default=0)), deviation / max(mean, 1)]
    return sizes + [math.asin(math.sqrt(min(x, 1.0))) for x in shares]


def test_statistics_equal_plain_counts(spark):
    rows = [*(t for t in ODD_TEXTS), "Go go GO. É é, 1 a! ?? x\nx x\n", "\x1c\x1d.", *(junk(i) for i in range(5))]
    docs = docs_frame(spark, rows)
    for r in docs.select("doc_id", quality.statistics(docs).alias("x")).collect():
        assert r.x == pytest.approx(plain_statistics(rows[r.doc_id]), abs=1e-9), rows[r.doc_id]


def test_query_equals_plain_discriminant(spark, sf_small):
    """Scores of the query from densities with covariances that numpy estimates."""
    docs = {r.doc_id: r.text for r in queries.table(spark, sf_small, "documents").collect()}
    x = {i: np.array(plain_statistics(t)) for i, t in docs.items()}
    labels = {r.doc_id: r.label for r in queries.quality_labels(spark, sf_small).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs}
    rows = [[x[i] for i in docs if labels.get(i) == c and not held[i]] for c in (0, 1)]
    covariances = [np.cov(np.array(r).T, bias=True) for r in rows]
    n = [len(r) for r in rows]
    pooled = sum(k * c for k, c in zip(n, covariances)) / sum(n)
    target = np.diag(np.maximum(np.diag(pooled), 1e-6))
    found = queries.op7_quality(spark, sf_small).collect()
    assert len(found) == len(docs)
    for r in found:
        density = []
        for c in (0, 1):
            full = 0.9 * covariances[c] + 0.1 * target
            d = x[r.doc_id] - np.mean(rows[c], axis=0)
            density.append(
                math.log(n[c] / sum(n)) - 0.5 * np.linalg.slogdet(full)[1] - 0.5 * d @ np.linalg.solve(full, d)
            )
        gap = min(max(density[0] - density[1], -500), 500)
        want = 1 / (1 + math.exp(gap))
        assert r.score == pytest.approx(want, abs=1e-6)
        assert r.held_out == held[r.doc_id] and r.predicted == int(r.score >= 0.7)
