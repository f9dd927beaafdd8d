import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import repeats
from holdfast.llm.repeats import remove_repeats

from .helpers import CLASHING, ODD_TEXTS, docs_frame, prose


def brute(texts, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        out.append((len(w), len(w) - sum(keep), " ".join(x for x, k in zip(w, keep) if k)))
    return out


def passages(seed, n, window):
    """Texts that share stretches a little shorter and longer than the window."""
    rng = random.Random(seed)
    shared = [prose(seed + i, window + rng.randrange(-2, 30)) for i in range(4)]
    texts = []
    for i in range(n):
        parts = [prose(1000 * seed + i, rng.randrange(50))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), prose(rng.randrange(10**6), rng.randrange(30))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(x for p in parts for x in p))
    loop = " ".join(["again"] * 3 * window)
    with_nul = " ".join(prose(8, 20)) + " \x00 a\x00b " + " ".join(prose(9, 60))
    return texts + [texts[0], loop, " ".join(prose(7, 20) * 4), with_nul, with_nul + " end"]


@pytest.mark.parametrize("window", [35, 9, 8, 3, 1])
def test_equals_brute_force(spark, window):
    rows = passages(1, 30, window) + ODD_TEXTS[:-2] + ["x" * 5000]
    docs = docs_frame(spark, rows, CLASHING).repartition(3)
    got = {r.doc_id: r for r in remove_repeats(docs, window=window).collect()}
    for i, want in enumerate(brute(rows, window)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == want
        assert sum(s.end - s.start for s in got[i].spans) == want[1]


def test_repeated_rows_ids_and_nulls(spark):
    text, other = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    rows = [(1, text), (1, text), (2, other), (2, other + " end"), (None, text), (None, None)]
    got = sorted((tuple(r)[:4] for r in remove_repeats(docs_frame(spark, rows)).collect()), key=repr)
    want = [(i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], 35))]
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert remove_repeats(docs_frame(spark, [])).count() == 0


def test_minimum_of_runs():
    values = np.random.default_rng(1).integers(0, 99, 60).astype(np.uint64)
    for width in (1, 2, 3, 7, 28, 60):
        want = [values[i : i + width].min() for i in range(60 - width + 1)]
        assert repeats._smallest(values, width).tolist() == want


def test_a_batch_sends_one_row_of_a_crowded_key_to_its_group():
    part = {
        "prefix": np.array([5, 5, 5, 6], np.uint64),
        "id0": np.array([9, 10, 11, 12]),
        "version": np.ones(4, np.int64),
        "place": np.arange(4),
    }
    columns = repeats._merged([part], ["prefix"], 2, 9)
    rows = list(zip(columns["salt"].to_pylist(), columns["weight"].to_pylist()))
    assert [(salt == 0, weight) for salt, weight in rows] == [
        (True, 9), (False, 9), (False, 9), (True, 1),
    ]
    assert set(repeats._merged([part], ["prefix"], 3, 9)["salt"].to_pylist()) == {0}


@pytest.mark.parametrize("bound", [1, 2, 5])
def test_prefixes_of_any_length_give_the_same(spark, bound):
    rows = passages(2, 30, 9)
    got = remove_repeats(docs_frame(spark, rows).repartition(4), window=9, bound=bound).collect()
    want = brute(rows, 9)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == [
        (i, *b) for i, b in enumerate(want)
    ]


def test_nodes_at_depth_hold_all_suffixes_that_agree_so_far():
    rng = np.random.default_rng(5)
    for depth in (1, 2, 4, 7):
        codes = rng.integers(0, 3, 300)
        at = np.arange(len(codes) - depth)
        node = rng.integers(0, 3, len(at))
        keys = [(n, *codes[a : a + depth]) for n, a in zip(node.tolist(), at.tolist())]
        seen = Counter(keys)
        got = repeats.deep_suffixes(codes, at, node, depth)
        assert sorted(got.tolist()) == [i for i, k in enumerate(keys) if seen[k] > 1]
    assert not len(repeats.deep_suffixes(codes, at[:0], node[:0], 3))


def test_groups_that_straddle_batches():
    """A tree whose rows come in several batches, and a counted node in more than two."""
    names = [c.split()[0] for c in repeats._SUFFIXES.split(", ")]
    listed = [[1, 2, 3, 4], [1, 2, 3, 9], [7, 2, 3, 4]]
    trees = [(4, 0, 0, i, 1, 10, 1, 2, 1, w) for i, w in enumerate(listed)]
    counted = [(5, 8, 0, i, 1, 3, 1, 1, 0, None) for i in range(4)] + [(5, 9, 0, 9, 1, 0, 1, 1, 0, None)]
    schema = pa.schema([(n, pa.int64()) for n in names[:-1]] + [("words", pa.list_(pa.int64()))])

    def batch(*rows):
        return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    rows = trees + counted
    for size in (1, 2, 3, len(rows)):
        batches = [batch(*rows[i : i + size]) for i in range(0, len(rows), size)]
        found = {tuple(r.values()) for b in repeats._tree_rows(3)(iter(batches)) for r in b.to_pylist()}
        # Windows of three: 123 in texts 0 and 1, 234 in texts 0 and 2.
        assert found == {(0, 1, 31), (1, 1, 30), (2, 1, 33)} | {(i, 1, 9) for i in range(4)}


def test_a_long_text_that_repeats_itself(spark):
    """400,000 words: a passage of 2,000 words that comes back among others."""
    passage, filler = prose(3, 2000), prose(4, 396_000)
    text = " ".join(filler[:200_000] + passage + filler[200_000:] + passage)
    rows = [text, " ".join(passage[:34])]
    got = remove_repeats(docs_frame(spark, rows)).collect()
    want = brute(rows, 35)
    assert want[0][1] >= 4000
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == dict(enumerate(want))
