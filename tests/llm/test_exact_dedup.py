from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from holdfast.llm.exact_dedup import exact_duplicates

from .helpers import CLASHING, ODD_TEXTS, docs_frame, sha


def brute(rows, best):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = best(ids) if ids else None
        out.append((doc_id, keep, len(groups[text or ""]), doc_id == keep, sha(text or "")))
    return sorted(out, key=repr)


ROWS = [
    *((i, t) for i, t in enumerate(ODD_TEXTS)),
    *((100 + i, t) for i, t in enumerate(["a", "b", "a", "A", "a ", "", "b"])),
    (100, "a"),
    (100, "other text, same id"),
    (None, "a"),
    (None, "only here"),
]


def weak_hash(text):
    return F.length(text) % 2


@pytest.mark.parametrize("keep, best", [("min", min), ("max", max)])
@pytest.mark.parametrize("options", [{}, {"content_hash": weak_hash}])
def test_equals_brute_force_even_when_hashes_collide(spark, keep, best, options):
    docs = docs_frame(spark, ROWS, CLASHING)
    got = exact_duplicates(docs, keep=keep, **options).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS, best)


def test_empty_table(spark):
    found = exact_duplicates(docs_frame(spark, []))
    assert found.count() == 0
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = docs_frame(spark, ["copy"] * 500 + ["other"]).repartition(4)
    by_text = rows.groupBy(F.md5("text"), "text").count()
    plan = by_text._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
