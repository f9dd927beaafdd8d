"""The manifest against a plain recursion over lists."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import merkle, queries
from holdfast.llm.merkle import MerkleSpec

from .helpers import CLASHING, ODD_TEXTS

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    value = None if value is None else str(value)
    return "-" if value is None else f"{len(value.encode())}:{value}"


def leaf_of(row, text):
    return h(*(told(v) for v in (*row[:4], text)))


def tampered(row):
    doc_id, text = row[0], row[4]
    even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
    return text.replace("\n", "") if even and text is not None else text


def climb(nodes):
    """The root, and per node its siblings as (left, right) from its run to the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            low = i // 3 * 3
            path.append((nodes[low:i], nodes[i + 1 : low + 3]))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def brute(rows):
    """Sorted results for rows (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        leaf, other = leaf_of(row, row[4]), leaf_of(row, tampered(row))
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf, other, row[0]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    sub = {s: climb([x[2] for x in sorted(trees[s])]) for s in order}
    if not order:
        return []
    root, above = climb([sub[s][0] for s in order])
    out = []
    for s, outer in zip(order, above):
        for (*_, leaf, other, doc_id), path in zip(sorted(trees[s]), sub[s][1]):
            folded, siblings = other, []
            for left, right in [*path, *outer]:
                folded = h(*left, folded, *right)
                siblings += [*left, *right]
            out.append((doc_id, leaf, sub[s][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=repr)


def measured(docs, **options):
    changed = merkle.without_newlines(F.col("text"), F.col("doc_id"))
    tree = merkle.manifest(docs, checked={"text": changed}, **options)
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    found = merkle.proofs(tree).withColumn("root", F.lit(tree.root)).select(names).collect()
    return sorted(((*r, r.folded_root == r.root) for r in found), key=repr)


def some_rows(sizes, seed=1):
    rng, rows = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice(["a\nb", "plain", None, "", "x\n\ny", "ß\n😀"])
            rows.append((rng.randrange(10_000), source, rng.choice(["en", None]), rng.randrange(9), text))
    return rows


@pytest.mark.parametrize("height", range(8))
@pytest.mark.parametrize("arity", [2, 3])
def test_van_emde_boas_order_places_every_node_once(height, arity):
    places = merkle.addresses(height, arity)
    assert [len(p) for p in places] == [arity**d for d in range(height + 1)]
    assert sorted(np.concatenate(places)) == list(range(sum(map(len, places))))
    assert places[0][0] == 0


def test_aligned_subtrees_are_contiguous():
    # Four levels of a ternary tree: the top two levels, then nine trees of two levels.
    places = merkle.addresses(3, 3)
    assert places[0].tolist() == [0] and places[1].tolist() == [1, 2, 3]
    assert places[2].tolist() == list(range(4, 40, 4))
    assert places[3][:6].tolist() == [5, 6, 7, 9, 10, 11]


@pytest.mark.parametrize("height", [1, 6])
@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 2, None: 1},
        {"a": 3, "b": 4, "": 9, "ä": 10, "z": 1, None: 27},
        {"hot": 300, "b": 28, "c": 82},
        {f"s{i}": 1 + i % 3 for i in range(40)},
    ],
)
def test_equals_plain_recursion(spark, sizes, height):
    rows = some_rows(sizes)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert measured(docs, spec=MerkleSpec(height=height)) == brute(rows)


def test_odd_rows(spark):
    rows = [(i, "s", None, None, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(7, "s", "en", 1, "same\nid"), (7, "s", "en", 1, "same\nid"), (7, "s", "en", 1, "x")]
    rows += [(None, "s", "en", 1, "no\nid")] * 2 + [(-5, None, "en", 0, "a\nb"), (8, "", "-", 0, "")]
    names = "".join(f", `{c.replace('`', '``')}` bigint" for c in [*CLASHING, "key", "node", "pos", "slice"] if c not in ("a", "key"))
    extra = names.count(",")
    docs = spark.createDataFrame([(*r, *[1] * extra) for r in rows], SCHEMA + names)
    assert measured(docs) == brute(rows)


def test_many_equal_rows_of_one_id(spark):
    rows = [(1, "hot", "en", 3, "a\nb")] * 2000 + [(2, "cold", "en", 3, "c")]
    assert measured(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(docs).root is None
    assert measured(docs) == []


def test_siblings_fold_to_the_root(spark):
    rows = some_rows({"a": 40, "b": 5})
    tree = merkle.manifest(spark.createDataFrame(rows, SCHEMA), spec=MerkleSpec(height=2))
    for r in merkle.proofs(tree, with_siblings=True).collect():
        assert r.folded_root == tree.root
        assert h(bytes(r.siblings).hex()) == r.proof_sha256


def test_paths_survive_packing():
    path = [("a" * 64, ""), ("", "b" * 128), ("0" * 64, "f" * 64), ("", "")]
    assert merkle.unpack(merkle.pack(path)) == path
    assert merkle.fold("leaf", path[:1]) == h("a" * 64, "leaf")


def test_query_equals_plain_recursion(spark, sf_check):
    docs = queries.table(spark, sf_check, "documents").select(*merkle.COLUMNS).collect()
    found = queries.op11_merkle_manifest(spark, sf_check).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute([tuple(r) for r in docs])
    assert 0 < sum(r.verified for r in found) < len(found)
