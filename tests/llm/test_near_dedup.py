import math
import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import near_dedup, words
from holdfast.llm.components import components
from holdfast.llm.near_dedup import NearSpec, drop_near_duplicates, near_duplicates

from .helpers import CLASHING, ODD_TEXTS, docs_frame, prose


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def plain_shingles(text):
    w = [x for x in re.split(r"[ \t-\r]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def weighted_shingles(texts, spec):
    """Per text its shingles with their weight times their frequency. Weights are counted here;
    only the hash that deals shingles to buckets is the library's."""
    flat = np.ones(spec.buckets)
    profiles = [near_dedup._profile(t or "", flat, spec) for t in texts]
    buckets = [near_dedup._bucket(h, spec) for h, _, _ in profiles]
    df = np.bincount(np.concatenate([np.unique(b) for b in buckets] or [[]]).astype(int), minlength=spec.buckets)
    idf = np.log((len(texts) + 1) / (df + 1)) / math.log(spec.buckets)
    weight = 1 + spec.idf_weight * np.clip(idf, 0, 1)
    return [dict(zip(h.tolist(), (tf * weight[b]).tolist())) for (h, tf, _), b in zip(profiles, buckets)]


def weighted_similarity(x, y):
    shared = sum(min(w, y[k]) for k, w in x.items() if k in y)
    total = sum(x.values()) + sum(y.values()) - shared
    return shared / total if total else 0.0


def brute_classes(rows, spec=NearSpec()):
    """Classes by all pairs, with weighted Jaccard similarity."""
    plain, union = [plain_shingles(t) for _, t in rows], Union()
    held = weighted_shingles([t for _, t in rows], spec)
    for i, (x, _) in enumerate(rows):
        union.find(x)
        assert len(held[i]) == len(plain[i])
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or plain[i] & plain[j] and weighted_similarity(held[i], held[j]) >= spec.similarity:
                union.join(x, rows[j][0])
    return {x: union.find(x) for x, _ in rows}


def family(seed, members, edits, n=300):
    rng, base = random.Random(seed), prose(seed, n, 10**6)
    for i in range(members):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(n)] = f"edit{seed}-{rng.random()}"
        yield " ".join(copy)


def test_classes_of_copies_and_near_copies(spark):
    texts = [t for s in range(6) for t in family(s, 5, 3)]
    texts += [" ".join(prose(90 + i, 200, 10**6)) for i in range(20)]
    texts += [texts[0], texts[0].upper(), texts[5].replace(" ", "\n"), "one two", "ONE  two", "one three"]
    texts += list(family(50, 4, 60))  # too far apart
    rows = [(10 + i, t) for i, t in enumerate(texts + ODD_TEXTS)]
    docs = docs_frame(spark, rows, CLASHING)
    found = near_duplicates(docs).collect()
    got = {r.id: r.class_id for r in found}
    assert got == brute_classes(rows)
    assert sum(r.kept for r in found) == len(set(got.values()))
    sizes = {c: list(got.values()).count(c) for c in got.values()}
    assert all(r.class_size == sizes[r.class_id] for r in found)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(got.values())


def test_a_hot_family_gives_pairs_in_proportion_and_one_class(spark):
    spec = NearSpec()
    rows = list(enumerate(family(3, 300, 2))) + [(1000 + i, " ".join(prose(i, 80, 10**6))) for i in range(50)]
    found = near_duplicates(docs_frame(spark, rows), spec=spec)
    assert {r.id: r.class_id for r in found.collect()} == brute_classes(rows)
    # Members of a band give pairs in proportion to their number, whatever the group size.
    signature = near_dedup.signatures(
        next(words.blocks(pa.array([t for _, t in rows[:300]]), near_dedup._TABLE))[1],
        np.ones(spec.buckets, np.float32),
        spec,
    )
    signed = spark.createDataFrame(
        [(i, s.tobytes()) for i, s in enumerate(signature)], "id bigint, signature binary"
    )
    held = spark.createDataFrame([(i, 7, 300) for i in range(300)], "id bigint, band bigint, n bigint")
    for group in (1000, 50):
        pairs = near_dedup.candidate_pairs(held, signed, replace(spec, group=group)).collect()
        assert 299 - 300 // group <= len(pairs) <= 300 * (1 + spec.partners)


def test_groups_stay_connected():
    """The pairs of a group connect what all pairs of enough agreement connect."""
    rng, spec = np.random.default_rng(2), NearSpec(agreement=0.6, partners=1)
    for size in (2, 3, 17, 60):
        points = rng.uniform(0, 1, size)
        agreement = 1 - np.abs(points[:, None] - points[None, :]) * 3
        want, got = Union(), Union()
        for i in range(size):
            want.find(i), got.find(i)
            for j in range(i):
                if agreement[i, j] >= 0.6:
                    want.join(i, j)
        for i, j in near_dedup._spanning_pairs(agreement.copy(), spec):
            assert agreement[i, j] >= 0.6
            got.join(i, j)
        assert [got.find(i) for i in range(size)] == [want.find(i) for i in range(size)]


def test_repeated_rows_ids_and_nulls(spark):
    a, b = family(1, 2, 2)
    rows = [(1, a), (1, a), (2, b), (3, "other"), (3, a), (None, "alone here"), (None, b)]
    found = near_duplicates(docs_frame(spark, rows)).collect()
    assert len(found) == 7
    by_id = {}
    for r in found:
        by_id.setdefault(r.id, set()).add(r.class_id)
    # A NULL id with text b belongs to the class of b, under its negative stand-in.
    stand_in = min(by_id)
    assert stand_in < 0 and by_id[1] == by_id[2] == by_id[3] == {stand_in}
    assert len(by_id) == 5


@pytest.mark.parametrize("rows", [[], [None], ["", " ", "\n"]])
def test_nothing_to_compare(spark, rows):
    found = near_duplicates(docs_frame(spark, rows)).collect()
    assert [r.class_size for r in found] == [1] * len(rows)


def test_samples_agree_as_often_as_weighted_similarity():
    spec, weights = NearSpec(samples=400), np.random.default_rng(1).uniform(1, 2, 1 << 16).astype(np.float32)
    texts = list(family(8, 2, 12)) + ["a b c d e " * 30 + "tail of it all here", "a b c d e " * 20]
    block = next(words.blocks(pa.array(texts), near_dedup._TABLE))[1]
    signed = near_dedup.signatures(block, weights, spec)
    for i, j in ((0, 1), (2, 3)):
        left, right = (near_dedup._profile(texts[k], weights, spec) for k in (i, j))
        shared, total = 0.0, 0.0
        tf = [dict(zip(p[0].tolist(), (p[1] * p[2]).tolist())) for p in (left, right)]
        for key in tf[0].keys() | tf[1].keys():
            x, y = tf[0].get(key, 0), tf[1].get(key, 0)
            shared, total = shared + min(x, y), total + max(x, y)
        assert abs((signed[i] == signed[j]).mean() - shared / total) < 0.1
        assert near_dedup.similarity(left, right) == pytest.approx(shared / total)


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(50)]
    edges += [(500, i) for i in range(501, 560)] + [(7, 7), (1, 0)]
    union = Union()
    for u, v in edges:
        union.join(u, v)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: union.find(x) for x in union.parent}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def template_family(seed, members, linked, n=600, edits=8):
    """Texts of similarity 0.74 to 0.79 to each other, of which the first ``linked`` are pairs
    that share two edits and so reach 0.817. Each edit changes five shingles."""
    rng, base, places = random.Random(seed), prose(seed, n, 10**6), range(7, n - 7, 5)
    chosen, texts = [], []
    while len(chosen) < members:
        second = len(chosen) < linked and len(chosen) % 2
        kept = sorted(chosen[-1])[:2] if second else []
        own = [k for k in places if not second or k not in chosen[-1]]
        at = {*kept, *rng.sample(own, edits - len(kept))}
        if all(len(at & other) < 3 for other in chosen):
            before = texts[-1] if kept else None
            texts.append([f"edit{rng.random()}" if k in at else w for k, w in enumerate(base)])
            for k in kept:
                texts[-1][k] = before[k]
            chosen.append(at)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_links_in_an_oversized_band_are_found(spark):
    """Bands of many times ``group`` members: near copies that no part holds together."""
    rows = template_family(21, 160, 60)
    want = brute_classes(rows)
    assert len(set(want.values())) == 130
    found = near_duplicates(docs_frame(spark, rows), spec=NearSpec(group=5))
    assert {r.id: r.class_id for r in found.collect()} == want


def test_a_link_behind_closer_partners_is_found(spark):
    """One part holds the family; its spanning forest and closest partners fail the exact test."""
    rows = template_family(21, 160, 60)
    found = near_duplicates(docs_frame(spark, rows))
    assert {r.id: r.class_id for r in found.collect()} == brute_classes(rows)


def test_a_repeated_tail_counts_as_often_as_it_stands(spark):
    """Alike as sets of shingles, but not as weighted ones: no link is promised, none is made."""
    rows = []
    for i in range(6):
        base = " ".join(prose(300 + i, 500, 10**6))
        tail = " " + " ".join(prose(400 + i, 12, 10**6))
        rows += [(2 * i, base + tail), (2 * i + 1, base + tail * (2 if i < 3 else 40))]
    want = brute_classes(rows)
    assert [want[2 * i + 1] == 2 * i for i in range(6)] == [True] * 3 + [False] * 3
    assert {r.id: r.class_id for r in near_duplicates(docs_frame(spark, rows)).collect()} == want


def test_links_near_the_threshold_are_found(spark):
    """Recall of pairs from 0.8 to 0.85, each of its own base."""
    rows, linked = [], 0
    for i in range(150):
        rng, base = random.Random(i), prose(5000 + i, 400, 10**6)
        copy = list(base)
        for at in rng.sample(range(5, 395, 5), 9 - i % 3):
            copy[at] = f"edit{i}-{at}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    held = weighted_shingles([t for _, t in rows], NearSpec())
    want = {2 * i + 1 for i in range(150) if weighted_similarity(held[2 * i], held[2 * i + 1]) >= 0.8}
    found = near_duplicates(docs_frame(spark, rows)).collect()
    got = {r.id for r in found if r.class_id != r.id}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) >= 100
