import bisect
import random
import re
import string
import time

from pyspark.sql import functions as F

from holdfast.llm import secret_scan
from holdfast.llm.secret_scan import KINDS, MarkovSpec, joined, scan

from .helpers import CLASHING, ODD_TEXTS, docs_frame, prose

ASSIGN = re.compile(secret_scan.ASSIGN.replace("(?i:", "(?:"), re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["password", "PassWD", "token", "api_key", "apikey", "SECRET", "=", ":", " ", '"', "'", "=" * 3]
    pool += ["AKIA", "0123456789abcdef", "A1B2C3D4E5", "short", "abc", "é", "😀", "\n", "longvalue99", "ſecret", "toKen"]
    return ["".join(rng.choices(pool, k=rng.randrange(14))) for _ in range(n)]


def spans_of(row, kinds):
    return sorted((s.start, s.order, s.end, s.kind) for k in kinds for s in row[k])


def test_base_spans_equal_brute_force(spark):
    rows = texts(1, 400) + ODD_TEXTS + ["secret=token : abcdef", "token=" + "f" * 70_000]
    found = scan(docs_frame(spark, rows, CLASHING))
    for r in found.collect():
        assert spans_of(r, KINDS[:3]) == brute(rows[r.row.doc_id])
    assert found.select("row.*").columns == docs_frame(spark, [], CLASHING).columns


def random_string(rng, n=32, alphabet="0123456789abcdef"):
    return "".join(rng.choices(alphabet, k=n))


def test_random_strings_are_added_and_identifiers_left(spark):
    rng = random.Random(5)
    names = ["".join(rng.choices(["tion", "er", "the", "con", "in", "al", "ing", "ment"], k=6)) for _ in range(300)]
    rows = [f"token = {random_string(rng)} {names[i]} {names[-i]}" for i in range(150)]
    odd = [random_string(rng).upper() for _ in range(30)]
    plain = ["".join(rng.choices(["tion", "er", "the", "in", "ment"], k=7)) for _ in range(30)]
    rows += [f"see {s} there" for s in odd] + [f"see {s} there" for s in plain]
    found = {r.row.doc_id: r for r in scan(docs_frame(spark, rows)).collect()}
    hits = [i for i in range(150, 180) if [(s.start, s.end) for s in found[i]["random"]] == [(4, 36)]]
    assert len(hits) >= 27
    assert not [i for i in range(180, 210) if found[i]["random"]]
    # What a base span covers is not reported twice.
    assert not [i for i in range(150) if found[i]["random"]]


def test_model_equals_counts(spark):
    samples = spark.createDataFrame([(1, "a1b2a1"), (0, "abab")], "label int, s string")
    ratios = secret_scan.train(samples, MarkovSpec(smoothing=1.0))
    a, one, b = ord("a"), ord("1"), ord("b")
    # After a: twice 1 in random strings; twice b in identifiers.
    assert abs(ratios[a * 128 + one] - secret_scan.math.log(3 / 130 / (1 / 130))) < 1e-12
    assert abs(ratios[a * 128 + b] - secret_scan.math.log(1 / 130 / (3 / 130))) < 1e-12


def test_without_samples_nothing_is_added(spark):
    for rows in ([], [None, ""], ["onlyordinaryidentifiershere"], [random_string(random.Random(1))]):
        found = scan(docs_frame(spark, rows)).collect()
        assert len(found) == len(rows) and not any(r["random"] for r in found)


def test_joined_order(spark):
    row = docs_frame(spark, ['token="' + "0a" * 20 + '"'])
    found = scan(row).select(joined(*[F.col(k) for k in KINDS]).alias("s")).first()
    assert found.s == "assign:0:47,hex:7:47"


def test_many_spans_in_one_text(spark):
    """Sixteen thousand matches, some of them inside candidates, in seconds."""
    rng = random.Random(6)
    parts = []
    for i in range(16_000):
        own = random_string(rng, 24)
        parts.append([own, f"x/{own}/y", f"token={own}", f"Zq9{own.upper()}Kx"][i % 4])
    text = "é ".join(parts)
    docs = docs_frame(spark, [text, " ".join(["ordinaryidentifier"] * 50)])
    began = time.monotonic()
    (row,) = [r for r in scan(docs).collect() if r.row.doc_id == 0]
    assert time.monotonic() - began < 90
    base = brute(text)
    assert spans_of(row, KINDS[:3]) == base and len(base) >= 16_000
    taken = sorted((s, e) for s, _, e, _ in base)
    starts = [s for s, _ in taken]
    for span in row["random"]:
        at = bisect.bisect_left(starts, span.end)
        assert at == 0 or max(e for _, e in taken[max(0, at - 3) : at]) <= span.start
    assert len(row["random"]) >= 3_900
