import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import decontaminate, words
from holdfast.llm.decontaminate import LeakSpec, drop_leaking, find_leaks

from .helpers import CLASHING, ODD_TEXTS, docs_frame, prose


def items(n, seed=1):
    rng = random.Random(seed)
    return [(100 + i, " ".join(prose(seed * 1000 + i, rng.randrange(8, 60), 400)) + " .") for i in range(n)]


def bench_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def build_index(spark, rows, spec):
    (index,) = decontaminate.build(bench_frame(spark, rows), spec)[0].value
    return index


def test_search_finds_every_item_above_the_threshold(spark):
    spec = LeakSpec(threshold=0.25, block_items=3)
    index = build_index(spark, items(40), spec)
    rng = random.Random(9)
    for _ in range(60):
        terms = np.unique(rng.choices(range(len(index.terms)), k=rng.randrange(1, 120)))
        scores = np.zeros(len(index.ids))
        for t in terms:
            at = slice(index.bounds[t], index.bounds[t + 1])
            np.add.at(scores, index.item[at], index.impact[at])
        want = {i: s for i, s in enumerate(scores) if s >= spec.threshold}
        assert dict(index.search(terms)) == pytest.approx(want)


def test_bound_leaves_out_no_passage(spark):
    spec = LeakSpec(threshold=0.3, block_items=2)
    index = build_index(spark, items(30), spec)
    text = pa.array([" ".join(prose(s, 300, 400)) for s in range(5)])
    block = next(words.blocks(text, decontaminate._TABLE))[1]
    term = index.lookup(block.hashes)
    cell = np.arange(len(term)) // 20
    seen = np.unique(cell[term >= 0] * len(index.terms) + term[term >= 0])
    n_cells = cell.max() + 1
    cells, blocks = index.promising(seen // len(index.terms), seen % len(index.terms), n_cells)
    hopeful = set(zip(cells.tolist(), blocks.tolist()))
    for c in range(n_cells):
        inside = np.unique(term[(cell == c) | (cell == c + 1)])
        found = index.search(inside[inside >= 0])
        assert {(c, item // index.block_size) for item, _ in found} <= hopeful
        own = np.array(sorted(b for d, b in hopeful if d == c), int)
        if len(own):
            assert index.search(inside[inside >= 0], own) == found


def test_plants_are_found_and_clean_documents_left(spark):
    bench = [*items(50), (7, None), (8, ""), (None, "no id at all " * 5), (100, items(1)[0][1]), (9, "What is x? It is forty two units long")]
    rng, rows, want = random.Random(4), [], set()
    for i in range(60):
        w = prose(5000 + i, rng.randrange(400), 400)
        if i % 3 == 0:
            item_id, text = rng.choice([*items(50), bench[-1]])
            at = rng.randrange(len(w) + 1)
            w[at:at] = [text.upper() if i % 2 else text]
            want.add((i, item_id))
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    docs = docs_frame(spark, rows, CLASHING)
    for spec in (LeakSpec(), LeakSpec(shard_bytes=1500), LeakSpec(passage_words=5)):
        found = find_leaks(docs, bench_frame(spark, bench), spec=spec).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want
        assert len(found) == len(want)
    left = drop_leaking(docs, bench_frame(spark, bench), spec=LeakSpec(shard_bytes=1500))
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in want}


def plain_words(text):
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()


def plain_leaks(docs, bench, spec):
    """BM25 of every item against every passage of its length, then the overlaps."""
    items_ = {(i, t): plain_words(t or "") for i, t in bench if i is not None}
    items_ = {key: w for key, w in items_.items() if w}
    n, mean = len(items_), sum(map(len, items_.values())) / max(len(items_), 1)
    df = Counter(t for w in items_.values() for t in set(w))
    out = {}
    for (item_id, text), own in items_.items():
        tf = Counter(own)
        length = spec.k1 * (1 - spec.b + spec.b * len(own) / mean)
        weight = {
            t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * k * (spec.k1 + 1) / (k + length)
            for t, k in tf.items()
        }
        total, step = sum(weight.values()), spec.passage_words
        while step < len(own):
            step *= 2
        asked = len(plain_words(text[: text.rfind("?") + 1]))
        cut = asked if 0 < asked < len(own) else math.ceil(len(own) * (1 - spec.answer_share))
        for doc_id, body in docs:
            words_ = plain_words(body or "")
            for low in range(0, len(words_), step):
                passage = words_[low : low + 2 * step]
                held = set(passage)
                score = sum(v for t, v in weight.items() if t in held) / total
                overlaps = []
                for part in (own[:cut], own[cut:]):
                    width = 3 if len(part) >= 3 else 1
                    runs = {tuple(part[i : i + width]) for i in range(len(part) - width + 1)}
                    seen = {tuple(passage[i : i + width]) for i in range(len(passage) - width + 1)}
                    overlaps.append(len(runs & seen) / len(runs) if runs else 1.0)
                rank = (min(overlaps), score)
                if score >= spec.threshold - 1e-9 and rank[0] >= spec.overlap:
                    if out.get((doc_id, item_id), ((-1,),))[0] < rank:
                        out[doc_id, item_id] = (rank, score, *overlaps)
    return {key: pytest.approx(found[1:]) for key, found in out.items()}


def near_items(bench, seed=8):
    """Documents that hold parts of items: some words replaced, halves far apart, cut short."""
    rng, rows = random.Random(seed), []
    for i in range(120):
        w = prose(9000 + i, rng.randrange(300), 400)
        own = (rng.choice(bench)[1] or "").split()
        own = [x if rng.random() > rng.choice([0, 0.1, 0.3]) else "other" for x in own]
        half = len(own) // 2 if i % 2 else len(own)
        gap = prose(7000 + i, rng.choice([0, 5, 40, 90, 200]), 400)
        rows.append((i, " ".join([*w, *own[:half], *gap, *own[half:], *w[:50]])))
    return rows


SPECS = [LeakSpec(), LeakSpec(passage_words=7, cells=5), LeakSpec(threshold=0.3, overlap=0.4)]


@pytest.mark.parametrize("spec", SPECS)
def test_equals_plain_bm25_and_overlap(spark, spec):
    bench = [*items(30), (5, "Who? " + " ".join(prose(77, 150, 400))), (6, "short one"), (8, "")]
    docs = near_items(bench) + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    found = find_leaks(docs_frame(spark, docs), bench_frame(spark, bench), spec=spec).collect()
    got = {(r.doc_id, r.item_id): tuple(r[2:]) for r in found}
    assert len(got) == len(found) > 20
    assert got == plain_leaks(docs, bench, spec)


def test_other_items_and_their_dealing_change_nothing(spark):
    bench = items(20)
    docs = near_items(bench)
    long = (999, " ".join(f"z{i}" for i in range(3000)))
    # As rare as before: terms of other items only change the statistics, which are those of all.
    found = [
        sorted(
            tuple(r)
            for r in find_leaks(
                docs_frame(spark, docs), bench_frame(spark, rows), spec=LeakSpec(b=0.0, shard_bytes=size)
            ).collect()
        )
        for rows, size in ((bench + [long], 16 << 20), (bench + [long], 700), (bench + [long], 9000))
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) > 5
    apart = [(1, bench[0][1].replace(" ", " " + "filler " * 40))]
    for rows in (bench, bench + [long]):
        assert find_leaks(docs_frame(spark, apart), bench_frame(spark, rows)).count() == 0


def test_a_long_text_is_searched_in_parts(spark):
    bench = items(400)
    spec = LeakSpec(cells=2000)
    indexes = decontaminate.build(bench_frame(spark, bench), spec)[0].value
    body = prose(3, 400_000, 100_000)
    body[200_000:200_000] = [bench[7][1]]
    (text,) = words.blocks(pa.array([" ".join(body)]), decontaminate._TABLE)
    tracemalloc.start()
    (found,) = decontaminate._all_leaks(text[1], indexes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x["item_id"] for x in found] == [107]
    assert peak < 100e6


def test_question_and_answer_must_both_occur(spark):
    question, answer = "Which of these rivers runs north through the old town", "the small grey one near the mill"
    bench = bench_frame(spark, [(1, f"{question}? {answer}")])
    filler = " ".join(prose(3, 60))
    rows = [f"{filler} {question}? {answer} {filler}", f"{filler} {question}? {filler}", answer]
    found = find_leaks(docs_frame(spark, rows), bench).collect()
    assert [r.doc_id for r in found] == [0]
    assert (found[0].question_overlap, found[0].answer_overlap) == (1.0, 1.0)


def test_repeated_rows_are_reported_again(spark):
    (item,) = items(1)
    rows = [(1, item[1]), (1, item[1]), (None, item[1])]
    found = find_leaks(docs_frame(spark, rows), bench_frame(spark, [item])).collect()
    assert sorted((r.doc_id for r in found), key=repr) == [1, 1, None]


def test_empty_tables(spark):
    some, none = bench_frame(spark, items(3)), bench_frame(spark, [])
    assert find_leaks(docs_frame(spark, []), some).count() == 0
    assert find_leaks(docs_frame(spark, ["text"]), none).count() == 0
    assert drop_leaking(docs_frame(spark, ["text", None]), none).count() == 2
