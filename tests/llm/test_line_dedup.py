import random
import time
from collections import Counter

from pyspark.sql import functions as F

from holdfast.llm import line_dedup
from holdfast.llm.line_dedup import LineRuns, document_counts, drop_frequent_lines

from .helpers import CLASHING, ODD_TEXTS, docs_frame

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(texts, min_docs, min_length=1):
    held = Counter(k for t in texts for k in {key_of(x) for x in (t or "").split("\n")})
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines if len(key_of(x)) < min_length or held[key_of(x)] < min_docs
        ]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["Home", " home", "HOME\t", "É", "é", "", "  ", "Common", "x1", "İ", *map(str, range(40))]
    return ["\n".join(rng.choices(pool, k=rng.randrange(9))) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = texts(1, 60) + ODD_TEXTS
    docs = docs_frame(spark, rows, CLASHING)
    for options in ({"batches": 1}, {"batches": 7, "fanout": 2}, {"min_length": 3}):
        got = drop_frequent_lines(docs, min_docs=5, **options)
        assert got.select("row.*").columns == docs.columns
        want = brute(rows, 5, options.get("min_length", 1))
        found = got.select("row.doc_id", "row.text", "n_lines", "n_dropped").collect()
        assert {r.doc_id: tuple(r)[1:] for r in found} == dict(enumerate(want))


def test_repeated_rows_and_ids_count_as_documents(spark):
    rows = [(1, "a\nb")] * 3 + [(1, "a\nc"), (None, "a"), (None, None)]
    got = drop_frequent_lines(docs_frame(spark, rows), min_docs=3).select("row.*").collect()
    want = [(i, t) for (i, _), (t, _, _) in zip(rows, brute([t for _, t in rows], 3))]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert drop_frequent_lines(docs_frame(spark, [])).count() == 0


def test_runs_are_merged_level_by_level_and_counts_add_up(spark):
    runs, batches = LineRuns(spark, settled=3, fanout=2), [texts(i, 12) for i in range(5)]
    for batch in batches:
        runs.add(document_counts(docs_frame(spark, batch), "text", 1))
        assert all(len(level) < 2 for level in runs.levels)
    held = Counter(
        k for b in batches for t in b for k in {key_of(x) for x in t.split("\n")} if k
    )
    hashes = line_dedup.key_hash(F.col("k"))
    frequent = spark.createDataFrame([(k,) for k, n in held.items() if n >= 3], "k string")
    want = {tuple(r.h) for r in frequent.select(hashes.alias("h")).collect()}
    assert {tuple(r) for r in runs.at_least(3).collect()} == want


def test_runs_are_joined_and_merged_as_they_lie(spark):
    """Neither an anti-join of a stored batch with the runs nor a merge of runs shuffles."""
    runs = LineRuns(spark, settled=3, fanout=9)
    for seed in range(3):
        runs.add(document_counts(docs_frame(spark, texts(seed, 12)), "text", 1))
    fresh = line_dedup.BucketedTable(spark, "fresh", runs.table.buckets)
    counts = document_counts(docs_frame(spark, texts(9, 12)), "text", 1)
    fresh.append(counts.withColumn("part", F.lit(0)))
    for df, joins in ((runs.unsettled(fresh.read(0)), 3), (runs.summed([0, 1, 2]), 0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert plan.count("SortMergeJoin") == joins
    fresh.drop()
    runs.remove()


def test_novel_lines_are_those_no_run_holds(spark):
    runs = LineRuns(spark, settled=2, fanout=2)
    runs.add(document_counts(docs_frame(spark, ["old\nolder"]), "text", 1))
    assert runs.novel(docs_frame(spark, ["old\nnew", "NEW "])).first().n == 2


def test_a_document_of_many_common_lines(spark):
    rng = random.Random(3)
    common = [f"common line {i}" for i in range(32_000)]
    rows = []
    for i in range(3):
        own = [f"own {i} {j}" for j in range(0, 32_000, 7)]
        lines = common + own
        rng.shuffle(lines)
        rows.append("\n".join(lines))
    began = time.monotonic()
    got = drop_frequent_lines(docs_frame(spark, rows), min_docs=3).collect()
    assert time.monotonic() - began < 120
    assert [(r.row.text, r.n_lines, r.n_dropped) for r in sorted(got, key=lambda r: r.row.doc_id)] == brute(rows, 3)


def test_search_by_halves(spark):
    rows = [sorted(random.Random(n).sample(range(200), n)) for n in (0, 1, 2, 15, 16, 17, 31, 32, 33, 100)]
    df = spark.createDataFrame([(r,) for r in rows] + [(None,)], "x array<int>")
    numbers = F.sequence(F.lit(-1), F.lit(201))
    found = df.select("x", F.filter(numbers, lambda v: line_dedup.contains(F.col("x"), v)).alias("y"))
    for r in found.collect():
        assert r.y == (r.x or [])
