import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm import bpe, queries, token_counts
from holdfast.llm.vocabulary import read_file

from .helpers import CLASHING, ODD_TEXTS, docs_frame, sha

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANGES = [(0, 0x250), (0x300, 0x500), (0x600, 0x620), (0x900, 0x950), (0x1100, 0x1120)]
RANGES += [(0x2000, 0x2070), (0x3000, 0x3060), (0xAC00, 0xAC10), (0x1F600, 0x1F620)]
WHOLE = ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", " ", "  ", "\n", "aaaa", "İ", "Σ", "ﬁ", "ǅ"]


def texts(seed=1, n=400):
    rng = random.Random(seed)
    pool = [chr(c) for low, high in RANGES for c in range(low, high)] + WHOLE * 12
    made = ["".join(rng.choices(pool, k=rng.randrange(50))) for _ in range(n)]
    return made + ["a" * 700, "ab" * 600, "!" * 999, " " * 500 + "x", "\x1c\x1d a\x85b\u180ec\ufeffd"]


def library(path, rows):
    encoded = Tokenizer.from_file(path).encode_batch([t or "" for t in rows], add_special_tokens=False)
    return [e.ids for e in encoded]


def test_counts_equal_the_library(spark):
    rows = texts() + ODD_TEXTS
    docs = docs_frame(spark, rows, CLASHING)
    got = docs.select("doc_id", token_counts.token_count(docs, BYTES).alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {i: len(x) for i, x in enumerate(library(BYTES, rows))}


def test_counts_do_not_depend_on_what_is_remembered():
    counter = token_counts.Counter(read_file(BYTES), remembered=5, batch_bytes=64)
    rows = texts(2, 60)
    assert counter.count(rows) == [len(x) for x in library(BYTES, rows)]


def test_ids_and_texts_equal_the_library(spark):
    rows = texts() + ODD_TEXTS
    docs = docs_frame(spark, rows, CLASHING)
    ids = docs.select("doc_id", bpe.encoded(docs, WORDS).alias("ids"))
    both = ids.select("*", bpe.decoded(ids, WORDS).alias("back"), bpe.n_tokens(F.col("ids")).alias("n"))
    got = {r.doc_id: r for r in both.collect()}
    at_once = docs.select("doc_id", bpe.coded(docs, WORDS).alias("c")).select("doc_id", "c.*")
    for r in at_once.collect():
        assert (r.ids, r.decoded) == (got[r.doc_id].ids, got[r.doc_id].back)
    decode = Tokenizer.from_file(WORDS).decode
    for i, want in enumerate(library(WORDS, rows)):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want
        assert (got[i].n, got[i].back) == (len(want), decode(want, skip_special_tokens=False))


def test_short_and_long_words_merge_alike():
    coder, rng = bpe.WordBPE(read_file(WORDS)), random.Random(4)
    for n in (1, 2, 3, 9, 40, 200):
        ids = coder._first_ids("".join(rng.choices("ains", k=n)))
        assert coder.merge_long(list(ids)) == coder.merge_short(list(ids))


@pytest.mark.parametrize("rows", [[], [None], [""]])
def test_nothing_to_encode(spark, rows):
    docs = docs_frame(spark, rows)
    ids = docs.select(bpe.encoded(docs, WORDS).alias("ids"))
    back = ids.select("ids", bpe.decoded(ids, WORDS).alias("back")).collect()
    assert [(bytes(r.ids), r.back) for r in back] == [(b"", "")] * len(rows)
    assert docs.select(token_counts.token_count(docs, BYTES)).collect() == [(0,)] * len(rows)


def test_long_words_merge_as_short_ones():
    counter, rng = token_counts.Counter(read_file(BYTES)), random.Random(7)
    for alphabet in ("ab", "aab c", "etaoin", "é😀x"):
        for n in (1, 2, 3, 50, 300):
            word = "".join(rng.choices(alphabet, k=n)).encode()
            assert counter.merger.count_long(word) == counter.merger.count([word])[0]


def test_one_very_long_word(spark):
    rng = random.Random(8)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300_000))
    rows = [word, "a" * 100_000, "short " + word[:3000] + " 12"]
    docs = docs_frame(spark, rows)
    began = time.monotonic()
    got = docs.select("doc_id", token_counts.token_count(docs, BYTES).alias("n")).collect()
    assert time.monotonic() - began < 60
    assert {r.doc_id: r.n for r in got} == {i: len(x) for i, x in enumerate(library(BYTES, rows))}


def test_query_of_token_counts(spark, sf_check):
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_check, "documents").collect()}
    want = dict(zip(docs, map(len, library(BYTES, docs.values()))))
    rows = queries.op2_token_counts(spark, sf_check).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = want[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_query_of_codes_and_digests(spark, sf_check):
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_check, "documents").collect()}
    want = dict(zip(docs, library(WORDS, docs.values())))
    decode = Tokenizer.from_file(WORDS).decode
    rows = queries.op3_bpe(spark, sf_check).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = want[r.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(np.array(ids, "<u4").tobytes())
        assert r.decoded_sha256 == sha(decode(ids, skip_special_tokens=False))
