"""Secrets: fixed patterns, and character Markov models of random strings and identifiers."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.rows import whole_row

#: The three kinds of pattern, in the order of their listing.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Of access (AKIA[A-Z0-9]+, 20 characters) and hex ([0-9a-f]+, 24), shorter runs never pass,
#: so they need not be matched.
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
SHORTEST_VALUE = 6
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}"
IDENTIFIER = r"[A-Za-z]{12,}"
KINDS = ("assign", "access", "hex", "random")

_SPANS = "array<struct<start:bigint,end:bigint,found:string>>"
_SIZE = 128  # characters of candidates are ASCII


@dataclass(frozen=True)
class MarkovSpec:
    """``shortest``: candidates have as many characters. ``threshold``: log-likelihood ratio
    (nats) from which a candidate counts as random. ``smoothing``: added to every count of a
    pair of characters."""

    shortest: int = 20
    threshold: float = 10.0
    smoothing: float = 0.5


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chunks(values: Column) -> Column:
    """An array as arrays of about the square root of its length, in order."""

    def cut(x):
        n = F.size(x)
        size = F.ceil(F.sqrt(F.greatest(n, F.lit(1)))).cast("int")
        starts = F.sequence(F.lit(0), ((F.greatest(n, F.lit(1)) - 1) / size).cast("int"))
        return F.transform(starts, lambda k: F.slice(x, k * size + 1, size))

    return _bound(values, cut)


def matches(text: Column, pattern: str, accept=None) -> Column:
    """Leftmost non-overlapping matches that ``accept`` takes, with their places.

    Places count code points. Matches and the pieces between them alternate, so a running sum
    of their lengths gives the places. It runs inside chunks and over the chunks, as an array
    that grows by one entry a step is copied at each: so n matches cost n to the power 1.5.
    """
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        gaps, found, lambda gap, m: F.struct(F.length(gap).cast("bigint").alias("gap"), m.alias("m"))
    )
    none = F.from_json(F.lit("[]"), _SPANS)

    def walk(state, step):
        start = state["at"] + step["gap"]
        end = start + F.length(step["m"])
        span = F.struct(start.alias("start"), end.alias("end"), step["m"].alias("found"))
        taken = step["m"].isNotNull() if accept is None else accept(step["m"])
        spans = F.when(taken, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(F.coalesce(end, start).alias("at"), spans.alias("spans"))

    def length(step):
        return step["gap"] + F.coalesce(F.length(step["m"]), F.lit(0)).cast("bigint")

    def begins(chunks):
        """Where each chunk begins."""
        zero = F.lit(0).cast("bigint")
        sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, s: a + length(s)))
        start = F.struct(
            zero.alias("at"), F.from_json(F.lit("[]"), "array<bigint>").alias("all")
        )
        return F.aggregate(
            sums,
            start,
            lambda state, n: F.struct(
                (state["at"] + n).alias("at"),
                F.concat(state["all"], F.array(state["at"])).alias("all"),
            ),
            lambda state: state["all"],
        )

    def spans_of(chunk, at):
        start = F.struct(at.alias("at"), none.alias("spans"))
        return F.aggregate(chunk, start, walk, lambda state: state["spans"])

    walked = _bound(
        _chunks(steps), lambda chunks: F.flatten(F.zip_with(chunks, begins(chunks), spans_of))
    )
    return F.when(text.rlike(pattern), walked).otherwise(none)


def value_of(match: Column) -> Column:
    """What an assignment assigns."""
    return F.regexp_extract(match, ASSIGN, 2)


def base_spans(text: Column) -> dict[str, Column]:
    long_value = lambda m: F.length(value_of(m)) >= SHORTEST_VALUE
    return {
        kind: matches(text, pattern, long_value if kind == "assign" else None)
        for kind, pattern in PATTERNS.items()
    }


def _pairs(s: Column) -> Column:
    """Codes of the pairs of neighbouring ASCII characters, without regard to case."""
    codes = F.transform(F.split(F.lower(s), ""), lambda c: F.ascii(c))
    n = F.length(s) - 1
    return F.zip_with(
        F.slice(codes, 1, n), F.slice(codes, 2, n), lambda left, right: left * _SIZE + right
    )


def labelled_samples(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Different strings with a label: 1 for what the fixed patterns find (random strings),
    0 for long words of letters (ordinary identifiers)."""
    text = F.coalesce(text_column, F.lit(""))
    base = base_spans(text)
    random = F.concat(
        F.transform(base["assign"], lambda x: value_of(x["found"])),
        F.transform(base["access"], lambda x: x["found"]),
        F.transform(base["hex"], lambda x: x["found"]),
    )
    label = lambda y: lambda s: F.struct(F.lit(y).alias("label"), s.alias("s"))
    plain = F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0))
    both = F.concat(F.transform(random, label(1)), F.transform(plain, label(0)))
    return docs.select(F.explode(both).alias("x")).select("x.*").where("length(s) >= 12").distinct()


def train(samples: DataFrame, spec: MarkovSpec) -> list[float] | None:
    """Log-likelihood ratio of each pair of characters, random against identifier.

    One distributed count; its result has at most two rows per pair of ASCII characters.
    None, if a label has no sample.
    """
    pairs = samples.select("label", F.explode(_pairs(F.col("s"))).alias("pair"))
    counts: list[dict[int, int]] = [{}, {}]
    for row in pairs.groupBy("label", "pair").count().collect():
        counts[row.label][row.pair] = row["count"]
    if not all(counts):
        return None
    totals = [[0] * _SIZE, [0] * _SIZE]
    for label in (0, 1):
        for pair, n in counts[label].items():
            totals[label][pair // _SIZE] += n

    def log_probability(label: int, pair: int) -> float:
        seen = counts[label].get(pair, 0) + spec.smoothing
        return math.log(seen / (totals[label][pair // _SIZE] + spec.smoothing * _SIZE))

    return [log_probability(1, p) - log_probability(0, p) for p in range(_SIZE * _SIZE)]


def random_spans(text: Column, base: list[Column], ratios: list[float], spec: MarkovSpec) -> Column:
    """Candidates with a letter whose log-likelihood ratio reaches the threshold and that
    overlap no base span.

    Base spans are ordered and in chunks with bounds, so a candidate is compared with the bounds
    and with the spans of the chunk or two that it lies in.
    """
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def is_random(m):
        total = F.aggregate(
            _pairs(m), F.lit(0.0), lambda sum_, pair: sum_ + F.element_at(table, pair + 1)
        )
        return m.isNotNull() & m.rlike("[A-Za-z]") & (total >= spec.threshold)

    def bounded(chunk):
        return F.struct(
            F.array_min(F.transform(chunk, lambda b: b["start"])).alias("start"),
            F.array_max(F.transform(chunk, lambda b: b["end"])).alias("end"),
            chunk.alias("spans"),
        )

    def overlap(b, x):
        return (b["start"] < x["end"]) & (x["start"] < b["end"])

    def free(known, found):
        return F.filter(
            found,
            lambda x: ~F.exists(
                known, lambda c: overlap(c, x) & F.exists(c["spans"], lambda b: overlap(b, x))
            ),
        )

    known = F.transform(_chunks(F.array_sort(F.concat(*base))), bounded)
    found = matches(text, CANDIDATE % spec.shortest, is_random)
    return _bound(known, lambda k: free(k, found))


def _named(kind: str, spans: Column) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(order).alias("order"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def scan(docs: DataFrame, text_column: str = "text", spec: MarkovSpec | None = None) -> DataFrame:
    """``row`` (struct of the input columns), and per kind of ``KINDS`` an array of spans
    (start, order, end, kind), for each input row.

    The models are trained on all of ``docs``; without samples of both labels no span of kind
    random is added. NULL and empty texts have no span; repeated strings train once. Letters
    are compared in lower case: identifiers that train the models are mostly lower case, so
    with their case the models would take every capital for a sign of chance. A text of n spans
    costs n to the power 1.5.
    """
    spec = spec or MarkovSpec()
    ratios = train(labelled_samples(docs, text_column), spec)
    rows = docs.select(
        whole_row(docs), F.coalesce(text_column, F.lit("")).alias("body")
    )
    body = F.col("body")
    found = rows.select("row", "body", *[s.alias(k) for k, s in base_spans(body).items()])
    base = [F.col(k) for k in PATTERNS]
    extra = F.from_json(F.lit("[]"), _SPANS)
    if ratios is not None:
        extra = random_spans(body, base, ratios, spec)
    found = found.withColumn("random", extra)
    return found.select("row", *[_named(k, F.col(k)).alias(k) for k in KINDS])


def joined(*spans: Column) -> Column:
    """kind:start:end by start, then kind, with commas between."""
    in_order = F.array_sort(F.concat(*spans))
    return F.array_join(
        F.transform(in_order, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
