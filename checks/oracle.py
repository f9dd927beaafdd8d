"""SQL that each query is checked against, for another engine on the same tables.

The statements follow the definitions step by step (one grouping per feature, joined at the
end; unrolled iterations), not the plans of the library.
"""

from __future__ import annotations

import random
import re

from checks.queries import (
    BASE_URL,
    CENSOR_AFTER,
    IN_TURNS,
    KMEANS,
    LOGREG,
    MINI_BATCHES,
    ONE_COPY,
    SNAPSHOT,
    THREE_EPOCHS,
    TWO_COPIES,
    UNTRAINED,
    WIKI,
    WINDOW,
)
from checks.raw import PLAIN_MODEL
from holdfast.config import KMeansSpec, LogRegSpec, MLPSpec
from holdfast.operators.mlp import initial_weights
from holdfast.schema import CLEAN, FEATURE_COLS
from holdfast.schema import RAW as RAW_LAYOUT
from holdfast.streaming.feed import REVERT_TAG

F = FEATURE_COLS


def r6(expr: str, name: str | None = None) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + CAST(0 AS DOUBLE) AS {name or expr}"


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def seconds(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000)"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


# Tables in the clean layout, as far as features need it.

ORDERS = """
edits AS (
  SELECT CAST(o_custkey AS VARCHAR) AS u, CAST(o_orderdate AS TIMESTAMP) AS ts,
         CAST(o_orderkey AS VARCHAR) AS rev,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 1 ELSE 0 END AS ns,
         CAST(round(o_totalprice) AS BIGINT) AS bytes,
         CAST(round(o_totalprice) AS BIGINT) - 200000 AS diff,
         o_orderstatus = 'F' AS reverted, o_orderkey % 3 = 0 AS minor,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN ''
              ELSE 'order ' || o_orderkey END AS comment
  FROM orders)
"""

_K = """CAST(regexp_extract(props, '"k": ?([0-9]+)', 1) AS BIGINT)"""

EVENTS = f"""
edits AS (
  SELECT CAST(user_id AS VARCHAR) AS u, CAST(ts AS TIMESTAMP) AS ts,
         CAST(event_id AS VARCHAR) AS rev,
         CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END AS ns,
         CAST(round(value * 100) AS BIGINT) AS bytes, {_K} - 50 AS diff,
         event_type = 'error' AS reverted, {_K} % 2 = 1 AS minor,
         CASE WHEN {_K} % 4 = 0 THEN '' ELSE event_type END AS comment
  FROM events)
"""

RANKED = """
ranked AS (
  SELECT *, row_number() OVER w AS rk, lag(ts) OVER w AS prev_ts
  FROM edits WHERE u IS NOT NULL AND ts IS NOT NULL
  WINDOW w AS (PARTITION BY u ORDER BY ts, length(rev), rev))
"""


def feature_ctes(
    edits: str = ORDERS,
    window: int = WINDOW,
    days: int = 180,
    full: bool = False,
    censor_after: str | None = None,
) -> list[str]:
    """One grouping per feature over the first edits, stitched with left joins."""
    needed = window if full else 3
    observed = ""
    if censor_after:
        observed = f"""WHERE coalesce(kept, 0) = 1 OR
          {seconds(f"TIMESTAMP '{censor_after}'")} - {seconds('last_ts')} >= {days} * 86400"""
    return [
        edits,
        RANKED,
        f"win AS (SELECT * FROM ranked WHERE rk <= {window})",
        f"""
bounds AS (
  SELECT u, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n
  FROM win GROUP BY u HAVING count(*) >= {needed})""",
        """
means AS (
  SELECT u, avg(CAST(reverted AS DOUBLE)) AS revert_rate,
         avg(CASE WHEN diff > 0 THEN diff ELSE 0 END) AS avg_bytes_added,
         avg(CASE WHEN diff < 0 THEN -diff ELSE 0 END) AS avg_bytes_removed,
         avg(CAST(ns = 1 AS DOUBLE)) AS talk_page_ratio,
         avg(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1.0 ELSE 0.0 END) AS weekend_ratio,
         avg(CASE WHEN comment IS NOT NULL AND comment <> '' THEN 1.0 ELSE 0.0 END)
           AS edit_summary_rate,
         avg(CAST(minor AS DOUBLE)) AS minor_edit_ratio
  FROM win GROUP BY u)""",
        """
entropy AS (
  SELECT u, sum(-(c / n) * log2(c / n)) AS namespace_diversity
  FROM (SELECT u, ns, CAST(count(*) AS DOUBLE) AS c FROM win GROUP BY u, ns)
  JOIN bounds USING (u) GROUP BY u)""",
        """
hours AS (
  SELECT u, h AS peak_hour, sin(2 * pi() * h / 24.0) AS peak_hour_sin,
         cos(2 * pi() * h / 24.0) AS peak_hour_cos
  FROM (SELECT u, h, row_number() OVER (PARTITION BY u ORDER BY c DESC, h) AS r
        FROM (SELECT u, hour(ts) AS h, count(*) AS c FROM win GROUP BY u, hour(ts)))
  WHERE r = 1)""",
        f"""
sessions AS (
  SELECT u, sum(CASE WHEN prev_ts IS NULL
                       OR {seconds('ts')} - {seconds('prev_ts')} > 1800 THEN 1 ELSE 0 END)
           AS session_count
  FROM win GROUP BY u)""",
        "firsts AS (SELECT u, coalesce(bytes, 0) AS first_edit_size FROM win WHERE rk = 1)",
        f"""
label AS (
  SELECT u, max(CASE WHEN {seconds('ts')} - {seconds('last_ts')} <= {days} * 86400
                     THEN 1 ELSE 0 END) AS kept
  FROM ranked JOIN bounds USING (u) WHERE rk > {window} GROUP BY u)""",
        f"""
feats AS (
  SELECT u, first_ts, last_ts, n, peak_hour,
         CASE WHEN kept = 1 THEN 0 ELSE 1 END AS dropout,
         n / greatest(1.0, ({seconds('last_ts')} - {seconds('first_ts')}) / 86400.0)
           AS velocity,
         coalesce(revert_rate, 0) AS revert_rate, namespace_diversity,
         avg_bytes_added, avg_bytes_removed, talk_page_ratio, peak_hour_sin, peak_hour_cos,
         weekend_ratio, edit_summary_rate, coalesce(minor_edit_ratio, 0) AS minor_edit_ratio,
         CAST(session_count AS DOUBLE) AS session_count,
         CAST(first_edit_size AS DOUBLE) AS first_edit_size
  FROM bounds LEFT JOIN means USING (u) LEFT JOIN entropy USING (u)
  LEFT JOIN hours USING (u) LEFT JOIN sessions USING (u) LEFT JOIN firsts USING (u)
  LEFT JOIN label USING (u) {observed})""",
    ]


USER = "u AS event_user_id"
FEATURE_LIST = ", ".join(r6(f) for f in F)


def features(**kw) -> str:
    return with_(
        *feature_ctes(**kw), select=f"SELECT {USER}, {big('dropout')}, {FEATURE_LIST} FROM feats"
    )


def profile(*columns: str, **kw) -> str:
    return with_(*feature_ctes(**kw), select=f"SELECT {USER}, {', '.join(columns)} FROM feats")


def edits_query(columns: str, where: str = "TRUE", edits: str = ORDERS) -> str:
    return with_(edits, RANKED, select=f"SELECT {columns} FROM ranked WHERE {where}")


# Raw layout.

_RAW_COLUMNS = """
         CASE WHEN o_orderkey % 11 = 0 THEN 'user' ELSE 'revision' END AS event_entity,
         CASE WHEN o_orderkey % 97 = 0 THEN 'junk'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.0' END AS event_timestamp,
         CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS ts,
         CASE WHEN o_orderkey % 5 > 1 THEN 'said "order" ' || o_orderkey END AS event_comment,
         CAST(o_custkey AS VARCHAR) AS event_user_id,
         'customer ' || o_custkey AS event_user_text,
         CASE WHEN o_orderkey % 13 = 0 THEN 'name,group' END AS event_user_is_bot_by,
         CASE WHEN o_orderkey % 17 = 0 THEN TRUE WHEN o_orderkey % 17 > 1 THEN FALSE END
           AS event_user_is_anonymous,
         o_orderkey % 50 AS event_user_revision_count,
         CAST(o_orderkey % 1000 AS VARCHAR) AS page_id,
         CASE WHEN o_orderkey % 19 <> 0
              THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 END AS page_namespace,
         CAST(o_orderkey AS VARCHAR) AS revision_id,
         o_orderkey % 3 = 0 AS revision_minor_edit,
         CAST(round(o_totalprice) AS BIGINT) AS revision_text_bytes,
         CASE WHEN o_orderkey % 7 > 0 THEN CAST(round(o_totalprice) AS BIGINT) - 200000 END
           AS revision_text_bytes_diff,
         o_orderstatus = 'F' AS revision_is_identity_reverted,
         FALSE AS revision_is_identity_revert
"""
RAW = f"raw AS (SELECT 'orders' AS wiki_db, {_RAW_COLUMNS} FROM orders)"


def _raw_column(name: str, kind: str) -> str:
    if name == "event_type":
        return "'create' AS event_type"
    sql_type = {"string": "VARCHAR", "boolean": "BOOLEAN"}.get(kind, "BIGINT")
    known = re.search(rf"\bAS {name}\b", RAW)
    return f"CAST({name if known else 'NULL'} AS {sql_type}) AS {name}"


RAW_COLUMNS = ", ".join(_raw_column(f.name, f.dataType.simpleString()) for f in RAW_LAYOUT)
CLEANED = """
cleaned AS (
  SELECT *, year(ts) AS year, month(ts) AS month,
         CAST(NULL AS VARCHAR) AS event_user_registration_timestamp,
         CAST(NULL AS VARCHAR) AS event_user_first_edit_timestamp
  FROM raw
  WHERE event_entity = 'revision'
    AND (event_user_is_bot_by IS NULL OR event_user_is_bot_by = '')
    AND event_user_is_anonymous = FALSE AND page_namespace IN (0, 1))
"""


def _clean_column(name: str) -> str:
    if name == "ts":
        return "epoch_us(ts) AS ts"
    if name in ("year", "month", "page_namespace"):
        return big(name)
    return name


def raw_ids(where: str) -> str:
    return with_(RAW, select=f"SELECT revision_id FROM raw WHERE {where}")


def months_cte(source: str) -> str:
    return f"""
months AS (
  SELECT unnest(generate_series(date_trunc('month', min(t)), date_trunc('month', max(t)),
                                INTERVAL 1 MONTH)) AS m
  FROM ({source}))
"""


_URL = (
    f"'{BASE_URL}/{SNAPSHOT}/{WIKI}/{WIKI}.{SNAPSHOT}.' || strftime(m, '%Y-%m')"
    " || '.tsv.bz2' AS url"
)
_ORDER_TIMES = "SELECT CAST(o_orderdate AS TIMESTAMP) AS t FROM orders"
_ALL_TIMES = _ORDER_TIMES + " UNION ALL SELECT CAST(ts AS TIMESTAMP) AS t FROM events"


# Standardising and logistic regression.


def hash32(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS UBIGINT)"


IN_TRAIN = f"{hash32("u || ':split 0'")} % 1000 < 800"


def scaler_cte(rows: str) -> str:
    cols = []
    for f in F:
        std = f"stddev_pop({f})"
        cols.append(f"avg({f}) AS m_{f}")
        cols.append(f"CASE WHEN {std} > 0 THEN {std} ELSE 1.0 END AS s_{f}")
    return f"scaler AS MATERIALIZED (SELECT count(*) AS n, {', '.join(cols)} FROM {rows})"


def scaled_cte(name: str, rows: str) -> str:
    cols = ", ".join(f"({f} - m_{f}) / s_{f} AS {f}" for f in F)
    return (
        f"{name} AS MATERIALIZED (SELECT u, CAST(dropout AS DOUBLE) AS y, {cols} "
        f"FROM {rows}, scaler)"
    )


SPLIT = [
    "feats_m AS MATERIALIZED (SELECT * FROM feats)",
    f"train_rows AS (SELECT * FROM feats_m WHERE {IN_TRAIN})",
    f"test_rows AS (SELECT * FROM feats_m WHERE NOT ({IN_TRAIN}))",
    scaler_cte("train_rows"),
    scaled_cte("train", "train_rows"),
    scaled_cte("test", "test_rows"),
]


def _z(weights: str) -> str:
    return f"{weights}.b + " + " + ".join(f"{weights}.w_{f} * x.{f}" for f in F)


def _sigmoid(z: str) -> str:
    return (
        f"CASE WHEN {z} >= 0 THEN 1.0 / (1.0 + exp(-abs({z})))"
        f" ELSE exp(-abs({z})) / (1.0 + exp(-abs({z}))) END"
    )


def _turn(epoch: int, spec: LogRegSpec) -> str:
    """Whether a row belongs to the stretch of the hash order that an epoch takes."""
    slot = f"CAST({hash32(f"x.u || ':{spec.seed}'")} AS BIGINT)"
    n = "(SELECT n FROM scaler)"
    rows = f"({spec.batches} * CAST(ceil({n} / {spec.batches * (spec.epochs - 1)}.0) AS BIGINT))"
    size = f"CAST(floor(CAST({rows} AS DOUBLE) / {n} * 4294967296.0) AS BIGINT)"
    low = f"({epoch} * {size} % 4294967296)"
    high = f"({low} + {size})"
    return (
        f"CASE WHEN {n} <= {rows} THEN TRUE"
        f" WHEN {high} <= 4294967296 THEN {slot} >= {low} AND {slot} < {high}"
        f" ELSE {slot} >= {low} OR {slot} < {high} - 4294967296 END"
    )


def logreg_ctes(spec: LogRegSpec = LOGREG) -> list[str]:
    rng = random.Random(spec.seed)
    start = ", ".join(f"CAST({rng.gauss(0.0, 0.01)!r} AS DOUBLE) AS w_{f}" for f in F)
    ctes = [f"w0 AS MATERIALIZED (SELECT CAST(0 AS DOUBLE) AS b, {start})"]
    for e in range(spec.epochs):
        sums = ", ".join(f"sum(err * {f}) / count(*) AS g_{f}" for f in F)
        where = f"WHERE {_turn(e, spec)}" if spec == IN_TURNS else ""
        ctes.append(
            f"""
g{e} AS MATERIALIZED (
  SELECT count(*) AS n, sum(err) / count(*) AS g_b, {sums},
         sum(greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))) / count(*) AS loss
  FROM (SELECT *, {_sigmoid('z')} - y AS err
        FROM (SELECT x.*, {_z(f'w{e}')} AS z FROM train x, w{e} {where})))"""
        )
        moved = ", ".join(f"w_{f} - {spec.lr} * g_{f} AS w_{f}" for f in F)
        ctes.append(
            f"w{e + 1} AS MATERIALIZED (SELECT b - {spec.lr} * g_b AS b, {moved} FROM w{e}, g{e})"
        )
    return ctes


END = f"w{LOGREG.epochs}"
SCORED = f"""
scored AS MATERIALIZED (
  SELECT u, CAST(y AS BIGINT) AS dropout, {_sigmoid('z')} AS score
  FROM (SELECT x.u, x.y, {_z(END)} AS z FROM test x, {END}))
"""
FEATS = [*feature_ctes(), *SPLIT]
FITTED = [*FEATS, *logreg_ctes(), SCORED]

CONFUSION = """
confusion AS (
  SELECT CAST(count(*) FILTER (dropout = 1 AND score >= 0.5) AS BIGINT) AS tp,
         CAST(count(*) FILTER (dropout = 0 AND score >= 0.5) AS BIGINT) AS fp,
         CAST(count(*) FILTER (dropout = 0 AND score < 0.5) AS BIGINT) AS tn,
         CAST(count(*) FILTER (dropout = 1 AND score < 0.5) AS BIGINT) AS fn
  FROM scored)
"""
# Every pair of a positive and a negative.
AUC = """
auc AS (
  SELECT avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0.0 END)
           AS auc_roc
  FROM (SELECT score FROM scored WHERE dropout = 1) p,
       (SELECT score FROM scored WHERE dropout = 0) q)
"""
RATES = """
rates AS (
  SELECT *, 2 * precision * recall / greatest(1e-9, precision + recall) AS f1
  FROM (SELECT *, tp / greatest(1, tp + fp) AS precision, tp / greatest(1, tp + fn) AS recall,
               (tp + tn) / greatest(1, tp + fp + tn + fn) AS accuracy
        FROM confusion))
"""
METRICS = [*FITTED, CONFUSION, AUC, RATES]

def weight_rows(w: str) -> str:
    return " UNION ALL ".join(
        [f"SELECT 'intercept' AS feature, {r6('b', 'weight')} FROM {w}"]
        + [f"SELECT '{f}' AS feature, {r6('w_' + f, 'weight')} FROM {w}" for f in F]
    )


def logreg_weights(spec: LogRegSpec) -> str:
    return with_(*FEATS, *logreg_ctes(spec), select=weight_rows(f"w{spec.epochs}"))


def logreg_loss(spec: LogRegSpec) -> str:
    return with_(
        *FEATS,
        *logreg_ctes(spec),
        select=" UNION ALL ".join(
            f"SELECT {big(str(e), 'epoch')}, {big('n')}, {r6('loss', 'log_loss')} FROM g{e}"
            for e in range(spec.epochs)
        ),
    )


# Scores that are missing count as the lowest of all.
MISSING = """
scored_known AS (
  SELECT u, dropout, CASE WHEN CAST(right(u, 1) AS INTEGER) % 3 = 0 THEN -1
                          WHEN right(u, 1) = '1' THEN -1 ELSE score END AS score
  FROM scored)
"""


# The network: three layers, and the state of each copy as lists of numbers.


def _net(weights: list[str], n: int, hidden: tuple[int, int]):
    """Texts of the parameters by layer, from their flat order."""
    at, layers = 0, []
    for a, b in zip((n, *hidden), (*hidden, 1)):
        w = [[weights[at + i * b + j] for j in range(b)] for i in range(a)]
        layers.append((w, weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return layers


def _layers(name: str, source: str, weights: list[str], hidden: tuple[int, int]) -> list[str]:
    """Statements that add the inputs of each layer, the last of them (``name``) adds z. They
    are materialised, because one inside the other they make very large expressions."""
    (w1, b1), (w2, b2), (w3, b3) = _net(weights, len(F), hidden)
    a1 = [" + ".join([b1[j], *[f"x.{f} * {w1[i][j]}" for i, f in enumerate(F)]]) for j in range(hidden[0])]
    first = ", ".join(f"{text} AS a1_{j}" for j, text in enumerate(a1))
    a2 = [
        " + ".join([b2[k], *[f"greatest(x.a1_{j}, 0) * {w2[j][k]}" for j in range(hidden[0])]])
        for k in range(hidden[1])
    ]
    second = ", ".join(f"{text} AS a2_{k}" for k, text in enumerate(a2))
    z = " + ".join([b3[0], *[f"greatest(x.a2_{k}, 0) * {w3[k][0]}" for k in range(hidden[1])]])
    return [
        f"{name}_1 AS MATERIALIZED (SELECT x.*, {first} FROM (SELECT * FROM {source}) x)",
        f"{name}_2 AS MATERIALIZED (SELECT x.*, {second} FROM {name}_1 x)",
        f"{name} AS MATERIALIZED (SELECT x.*, {z} AS z FROM {name}_2 x)",
    ]


def _start(spec: MLPSpec) -> list[str]:
    return [f"CAST({float(w)!r} AS DOUBLE)" for w in initial_weights(len(F), spec)]


def _unpacked(source: str, size: int, keep: str) -> str:
    """The weights as columns p0, p1, ..."""
    return f"SELECT {keep}{', '.join(f'p[{i + 1}] AS p{i}' for i in range(size))} FROM {source}"


def _zipped(text: str, *lists: str) -> str:
    """A list from ``text`` over x[1], x[2], ... of some lists."""
    return f"list_transform(list_zip({', '.join(lists)}), lambda x: {text})"


def _step(e: int, s: int, spec: MLPSpec, size: int) -> list[str]:
    """Step s of an epoch: each copy's gradient over its next rows, and its state after Adam."""
    h1, h2 = spec.hidden
    at = f"e{e}s{s}"
    weights = [f"x.p{i}" for i in range(size)]
    _, (w2, _), (w3, _) = _net(weights, len(F), spec.hidden)
    rows = f"(SELECT * FROM dealt WHERE step = {s}) d JOIN {at}p USING (worker)"
    d2 = ", ".join(f"dz * {w3[k][0]} * CAST(a2_{k} > 0 AS INTEGER) AS d2_{k}" for k in range(h2))
    d1 = ", ".join(
        "(" + " + ".join(f"d2_{k} * {w2[j][k]}" for k in range(h2)) + ")"
        f" * CAST(a1_{j} > 0 AS INTEGER) AS d1_{j}"
        for j in range(h1)
    )
    grads = [f"{f} * d1_{j}" for f in F for j in range(h1)]
    grads += [f"d1_{j}" for j in range(h1)]
    grads += [f"greatest(a1_{j}, 0) * d2_{k}" for j in range(h1) for k in range(h2)]
    grads += [f"d2_{k}" for k in range(h2)]
    grads += [f"greatest(a2_{k}, 0) * dz" for k in range(h2)] + ["dz"]
    means = ", ".join(f"avg({g})" for g in grads)
    moved = _zipped(
        f"x[1] - {spec.learning_rate} * (x[2] / (1 - pow(0.9, t)))"
        " / (sqrt(x[3] / (1 - pow(0.999, t))) + 1e-7)",
        "p",
        "m",
        "v",
    )
    return [
        f"{at}p AS MATERIALIZED ({_unpacked(at, size, 'worker, ')})",
        *_layers(f"{at}z", rows, weights, spec.hidden),
        f"{at}dz AS MATERIALIZED (SELECT x.*, {_sigmoid('z')} - y AS dz FROM {at}z x)",
        f"{at}d2 AS MATERIALIZED (SELECT x.*, {d2} FROM {at}dz x)",
        f"{at}d1 AS MATERIALIZED (SELECT x.*, {d1} FROM {at}d2 x)",
        f"{at}g AS MATERIALIZED (SELECT worker, [{means}] AS g FROM {at}d1 GROUP BY worker)",
        f"""
{at}m AS MATERIALIZED (
  SELECT worker, p, {_zipped('0.9 * x[1] + 0.1 * x[2]', 'm', 'g')} AS m,
         {_zipped('0.999 * x[1] + 0.001 * x[2] * x[2]', 'v', 'g')} AS v, t + 1 AS t
  FROM {at} JOIN {at}g USING (worker))""",
        f"""
e{e}s{s + 1} AS MATERIALIZED (
  SELECT worker, {moved} AS p, m, v, t FROM {at}m
  UNION ALL SELECT * FROM {at} WHERE worker NOT IN (SELECT worker FROM {at}g))""",
    ]


def mlp_ctes(spec: MLPSpec, steps: int = 1, batch: str | None = None) -> list[str]:
    """Copies that take up to ``steps`` steps an epoch, each over ``batch`` rows (all, if there
    is one step), and are averaged by their rows, as is the state of their optimiser."""
    size = len(_start(spec))
    zeros = f"list_transform(range({size}), lambda i: CAST(0 AS DOUBLE))"
    of_worker = f"{hash32("u || ':worker'")} % {spec.workers}"
    step = f"(place // {batch})" if batch else "0"
    averaged = ", ".join(
        f"(SELECT list(x ORDER BY i) FROM (SELECT i, sum(n * {c}[i]) / sum(n) AS x"
        f" FROM last, unnest(range(1, {size + 1})) AS u(i) GROUP BY i)) AS {c}"
        for c in "pmv"
    )
    ctes = [
        f"""
dealt AS MATERIALIZED (
  SELECT *, {step} AS step FROM (
    SELECT *, {of_worker} AS worker, row_number() OVER (
      PARTITION BY {of_worker} ORDER BY {hash32("u || ':order'")}, u) - 1 AS place
    FROM train WHERE NOT {hash32("u || ':held out'")} / 4294967296.0 < {spec.validation_split}))""",
        "sizes AS (SELECT worker, count(*) AS n FROM dealt GROUP BY worker)",
        f"""
net0 AS MATERIALIZED (
  SELECT [{", ".join(_start(spec))}] AS p, {zeros} AS m, {zeros} AS v, CAST(0 AS DOUBLE) AS t)""",
    ]
    for e in range(spec.epochs):
        ctes.append(f"e{e}s0 AS MATERIALIZED (SELECT worker, p, m, v, t FROM sizes, net{e})")
        for s in range(steps):
            ctes += _step(e, s, spec, size)
        last = f"last AS (SELECT * FROM e{e}s{steps} JOIN sizes USING (worker))"
        ctes.append(
            f"""
net{e + 1} AS MATERIALIZED (
  WITH {last} SELECT {averaged}, (SELECT sum(n * t) / sum(n) FROM last) AS t)"""
        )
    return ctes


def mlp_weights(spec: MLPSpec, **steps) -> str:
    size = len(_start(spec))
    return with_(
        *FEATS,
        *mlp_ctes(spec, **steps),
        select=f"""SELECT {big('i', 'id')}, {r6('p[i + 1]', 'weight')}
                   FROM net{spec.epochs}, unnest(range({size})) AS u(i)""",
    )


NET_SCORED = [
    "net_end AS MATERIALIZED "
    f"({_unpacked(f'net{TWO_COPIES.epochs}', len(_start(TWO_COPIES)), '')})",
    *_layers(
        "net_z",
        "test, net_end",
        [f"x.p{i}" for i in range(len(_start(TWO_COPIES)))],
        TWO_COPIES.hidden,
    ),
    "net_scored AS MATERIALIZED (SELECT u, CAST(y AS BIGINT) AS dropout, "
    f"{_sigmoid('z')} AS score FROM net_z)",
]


def renamed(ctes: list[str], prefix: str) -> list[str]:
    """The metrics of another table of scores under names of their own."""
    out = []
    for cte in ctes:
        for name in ("confusion", "auc", "rates"):
            cte = re.sub(rf"\b{name}\b", prefix + name, cte)
        out.append(re.sub(r"\bscored\b", prefix + "scored", cte))
    return out


NETWORK = [*mlp_ctes(TWO_COPIES), *NET_SCORED, *renamed([CONFUSION, AUC, RATES], "net_")]


# K-Means.


def kmeans_ctes(spec: KMeansSpec = KMEANS) -> list[str]:
    """Iterations up to the most there can be; once the rule says stop, nothing moves."""
    cols = ", ".join(F)
    ctes = [
        "feats_m AS MATERIALIZED (SELECT * FROM feats)",
        scaler_cte("feats_m"),
        scaled_cte("points", "feats_m"),
        f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY md5(u || ':{spec.seed}'), u) - 1 AS i, {cols}
  FROM points QUALIFY i < {spec.k})""",
        "s0 AS (SELECT FALSE AS stopped, CAST('infinity' AS DOUBLE) AS last, 0 AS done)",
    ]
    dist = " + ".join(f"pow(x.{f} - c.{f}, 2)" for f in F)
    for it in range(spec.iters):
        means = ", ".join(f"avg({f}) AS {f}" for f in F)
        moved = ", ".join(
            f"CASE WHEN s.stopped THEN c.{f} ELSE coalesce(a.{f}, c.{f}) END AS {f}" for f in F
        )
        shift = " + ".join(f"pow(a.{f} - b.{f}, 2)" for f in F)
        ctes += [
            f"""
near{it} AS MATERIALIZED (
  SELECT x.*, c.i, {dist} AS d,
         row_number() OVER (PARTITION BY x.u ORDER BY {dist}, c.i) AS r
  FROM points x, c{it} c WHERE NOT (SELECT stopped FROM s{it}))""",
            f"""
c{it + 1} AS MATERIALIZED (
  SELECT c.i, {moved} FROM s{it} s, c{it} c
  LEFT JOIN (SELECT i, {means} FROM near{it} WHERE r = 1 GROUP BY i) a ON a.i = c.i)""",
            f"""
t{it} AS MATERIALIZED (
  SELECT (SELECT sum(d) FROM near{it} WHERE r = 1) AS cost,
         (SELECT sum(sqrt({shift})) FROM c{it} a JOIN c{it + 1} b USING (i)) AS shift)""",
            f"""
s{it + 1} AS MATERIALIZED (
  SELECT stopped OR stops AS stopped, CASE WHEN stopped OR stops THEN last ELSE cost END AS last,
         done + CASE WHEN stopped THEN 0 ELSE 1 END AS done
  FROM (SELECT *, shift < {spec.shift_tol}
                  OR isfinite(last)
                     AND abs(last - cost) < {spec.cost_tol} * greatest(1, last) AS stops
        FROM s{it}, t{it}))""",
        ]
    ctes.append(
        f"""
near_end AS MATERIALIZED (
  SELECT x.*, c.i, {dist} AS d, row_number() OVER (PARTITION BY x.u ORDER BY {dist}, c.i) AS r
  FROM points x, c{spec.iters} c)"""
    )
    return [*feature_ctes(), *ctes]


def kmeans_centers(spec: KMeansSpec) -> str:
    return with_(
        *kmeans_ctes(spec),
        select=" UNION ALL ".join(
            f"SELECT {big('i', 'cluster')}, '{f}' AS feature, {r6(f, 'value')} FROM c{spec.iters}"
            for f in F
        ),
    )


CLUSTERED = kmeans_ctes()
ASSIGNED = """
assigned AS MATERIALIZED (
  SELECT a.u, a.i AS cluster, a.d AS nearest, b.d AS second
  FROM near_end a JOIN near_end b ON a.u = b.u AND a.r = 1 AND b.r = 2)
"""
_SILHOUETTE = """avg(CASE WHEN greatest(nearest, second) = 0 THEN 0.0
                     ELSE (second - nearest) / greatest(nearest, second) END)"""
PROFILE = (
    "profile AS (SELECT cluster AS cluster_id, count(*) AS cluster_size, "
    + ", ".join(f"avg({f}) AS mean_{f}" for f in F)
    + " FROM assigned JOIN feats_m USING (u) GROUP BY cluster)"
)


# The live feed.

FEED = f"""
feed AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user, 'page ' || event_id AS title,
         CASE WHEN event_id % 9 > 0 THEN event_id % 3 ELSE 0 END AS namespace,
         {seconds('CAST(ts AS TIMESTAMP)')} AS ts,
         CASE WHEN event_id % 13 > 0 THEN {_K} - 50 ELSE 0 END AS bytes_diff,
         CASE WHEN event_id % 4 > 0 THEN event_type ELSE '' END AS comment,
         CASE WHEN {_K} % 2 = 1 THEN 1 ELSE 0 END AS minor,
         CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END AS is_revert  -- the {REVERT_TAG} tag
  FROM events
  WHERE event_id % 101 <> 0 AND event_id % 7 <> 0 AND event_id % 5 <> 0
    AND event_id % 11 <> 0)
"""
_HOUR = "hour(make_timestamp(ts * 1000000))"
PROXIES = f"""
proxies AS (
  SELECT "user", title, ts, 0.0 AS velocity, is_revert AS revert_rate,
         0.0 AS namespace_diversity,
         greatest(bytes_diff, 0) AS avg_bytes_added, greatest(-bytes_diff, 0) AS avg_bytes_removed,
         CASE WHEN namespace = 1 THEN 1 ELSE 0 END AS talk_page_ratio,
         sin(2 * pi() * {_HOUR} / 24.0) AS peak_hour_sin,
         cos(2 * pi() * {_HOUR} / 24.0) AS peak_hour_cos,
         0.0 AS weekend_ratio, CASE WHEN comment <> '' THEN 1 ELSE 0 END AS edit_summary_rate,
         minor AS minor_edit_ratio, 1.0 AS session_count,
         greatest(bytes_diff, 0) AS first_edit_size
  FROM feed)
"""


SCALED_FEED = (
    'scaled_feed AS (SELECT "user", title, ts, '
    + ", ".join(f"(p.{f} - m_{f}) / s_{f} AS {f}" for f in F)
    + " FROM proxies p, scaler)"
)


# Whole envelopes, envelopes with two fields, and broken ones; unknown features count as 0.
BAD_ENVELOPES = f"""
bad AS (
  SELECT CASE WHEN event_id % 5 > 0 THEN CAST(user_id AS VARCHAR) END AS "user",
         CASE WHEN event_id % 5 > 0 THEN 'page ' || event_id END AS title,
         CASE WHEN whole THEN t END AS ts, 0.0 AS velocity, 0.0 AS revert_rate,
         0.0 AS namespace_diversity,
         CASE WHEN whole THEN greatest(diff, 0) ELSE 0 END AS avg_bytes_added,
         CASE WHEN whole THEN greatest(-diff, 0) ELSE 0 END AS avg_bytes_removed,
         CASE WHEN whole AND event_id % 3 = 1 THEN 1 ELSE 0 END AS talk_page_ratio,
         CASE WHEN whole THEN sin(2 * pi() * h / 24.0) ELSE 0 END AS peak_hour_sin,
         CASE WHEN whole THEN cos(2 * pi() * h / 24.0) ELSE 0 END AS peak_hour_cos,
         0.0 AS weekend_ratio,
         CASE WHEN whole AND event_type <> '' THEN 1 ELSE 0 END AS edit_summary_rate,
         CASE WHEN whole THEN event_id % 2 ELSE 0 END AS minor_edit_ratio, 1.0 AS session_count,
         CASE WHEN whole THEN greatest(diff, 0) ELSE 0 END AS first_edit_size
  FROM (SELECT *, event_id % 5 > 1 AS whole, {_K} - 50 AS diff, t // 3600 % 24 AS h
        FROM (SELECT *, {seconds('CAST(ts AS TIMESTAMP)')} AS t FROM events)))
"""


def _plain_z() -> str:
    m = PLAIN_MODEL
    terms = [f"{m['weights'][f]} * ({f} - {m['means'][f]}) / {m['stds'][f]}" for f in F]
    return " + ".join([str(m["intercept"]), *terms])


# Both models in one statement; the clustering has its own scaler, over all rows.
BOTH = [
    *METRICS,
    *[c.replace("scaler", "scaler_all") for c in CLUSTERED[len(feature_ctes()) + 1 :]],
    ASSIGNED,
    PROFILE,
    f"quality AS (SELECT {_SILHOUETTE} AS silhouette FROM assigned)",
]


def results_table(network_auc: str, more: list[str] = (), source: str = "") -> str:
    return with_(
        *BOTH,
        *more,
        select=f"""SELECT {big('cluster_id')}, {big('cluster_size')},
                   {r6('auc.auc_roc', 'model_auc_logreg')}, {r6(network_auc, 'model_auc_dnn')},
                   {r6('silhouette', 'kmeans_silhouette')}, """
        + ", ".join(r6(f"mean_{f}") for f in F)
        + f" FROM profile, auc, quality{source}",
    )


def summary(columns: str = "", more: list[str] = (), source: str = "") -> str:
    return with_(
        *BOTH,
        *more,
        select=f"""SELECT (SELECT {big('count(*)', 'n')} FROM feats_m) AS n_editors,
                   (SELECT {r6('avg(dropout)', 'd')} FROM feats_m) AS dropout_rate,
                   (SELECT {big('n')} FROM scaler) AS n_train, {r6('auc.auc_roc', 'auc_roc')},
                   confusion.tp AS tp, {big('4', 'k')}, {r6('silhouette')}{columns}
                   FROM auc, confusion, quality{source}""",
    )


_FRAMED = FEED.replace(
    "FROM events",
    "FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 20 = 9)",
).replace("WHERE event_id", "WHERE event_id % 6 <> 5 AND event_id")
_CLEAN_FIELDS = ", ".join(map(_clean_column, CLEAN.fieldNames()))
# Every pair of points.
_PAIRS = f"""
pairs AS (
  SELECT a.u, x.cluster AS own, y.cluster AS other, count(*) AS n,
         sum({" + ".join(f"pow(a.{f} - b.{f}, 2)" for f in F)}) AS total
  FROM points a JOIN assigned x ON x.u = a.u, points b JOIN assigned y ON y.u = b.u
  GROUP BY ALL),
sides AS (
  SELECT u, max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS a,
         min(CASE WHEN own <> other THEN total / n END) AS b,
         max(CASE WHEN own = other THEN n END) AS size
  FROM pairs GROUP BY u)
"""
_OF_PAIRS = """avg(CASE WHEN size = 1 OR greatest(a, b) = 0 THEN 0.0
                    ELSE (b - a) / greatest(a, b) END)"""

ORACLE: dict[str, str] = {
    "quarantine_counts": with_(
        RAW,
        CLEANED,
        select="""
          SELECT 'accepted' AS status, count(ts) AS n FROM cleaned UNION ALL
          SELECT 'malformed_time', count(*) FROM cleaned WHERE ts IS NULL UNION ALL
          SELECT 'rejected', count(*) FROM orders WHERE o_orderkey % 50 = 0""",
    ),
    "quarantine_accepted": with_(
        RAW, CLEANED, select=f"SELECT {_CLEAN_FIELDS} FROM cleaned WHERE ts IS NOT NULL"
    ),
    "quarantined": with_(
        RAW,
        CLEANED,
        select="""
          SELECT revision_id, 'junk' AS time, CAST(NULL AS BIGINT) AS cells
          FROM cleaned WHERE ts IS NULL UNION ALL
          SELECT CAST(o_orderkey AS VARCHAR), NULL, 71 FROM orders WHERE o_orderkey % 50 = 0""",
    ),
    "landing_faults": with_(
        """
landed AS (
  SELECT CASE WHEN o_orderkey % 97 > 0 THEN date_trunc('month', o_orderdate) END AS m,
         length('order number ' || o_orderkey) + 1 AS bytes
  FROM orders),
sized AS (
  SELECT m, CASE WHEN month(m) = 7 THEN 1 ELSE sum(bytes) END AS bytes
  FROM landed WHERE m IS NULL OR month(m) NOT IN (5, 10) GROUP BY m)""",
        months_cte(
            "SELECT least(CAST(o_orderdate AS TIMESTAMP), TIMESTAMP '1997-12-01') AS t FROM orders"
        ),
        select=f"""
          SELECT CASE WHEN s.bytes IS NULL THEN 'missing' WHEN s.bytes < 15 THEN 'empty'
                      ELSE 'size' END AS fault,
                 {big('year(x.m)', 'year')}, {big('month(x.m)', 'month')},
                 {big('coalesce(s.bytes, 0)', 'bytes')}
          FROM months x LEFT JOIN sized s ON s.m = x.m
          WHERE s.bytes IS NULL OR s.bytes < 15 OR month(x.m) = 3
          UNION ALL
          SELECT 'unexpected', year(m), month(m), CAST(bytes AS BIGINT) FROM sized s
          WHERE NOT EXISTS (SELECT 1 FROM months x WHERE x.m = s.m)""",
    ),
    "silhouette": with_(
        *CLUSTERED,
        ASSIGNED,
        _PAIRS,
        select=f"""SELECT {r6(_OF_PAIRS, 'silhouette')},
                   (SELECT {r6(_SILHOUETTE, 's')} FROM assigned) AS simplified FROM sides""",
    ),
    "feed_framed": with_(
        _FRAMED,
        select=f"""SELECT "user", title, {big('namespace')}, {big('ts')}, {big('bytes_diff')},
                   comment, {big('minor')}, {big('is_revert')}, FALSE AS corrupt FROM feed""",
    ),
    "feed_events": """
      SELECT CASE WHEN event_id % 10 < 9 THEN CAST(event_id AS VARCHAR) END AS id,
             CASE WHEN event_id % 6 = 5 THEN 'canary' ELSE 'message' END AS event,
             CASE WHEN event_id % 101 <> 0 THEN 'page ' || event_id END AS title
      FROM (SELECT * FROM events UNION ALL
            SELECT * FROM events WHERE event_id % 20 IN (3, 9))""",
    "feed_resume_point": """
      SELECT CAST(max(event_id) AS VARCHAR) AS id FROM events WHERE event_id % 20 = 3""",
    "top_risk_by_archetype": with_(
        *BOTH,
        f"""
everyone AS (
  SELECT u, round({_sigmoid('z')}, 6) AS score
  FROM (SELECT x.u, {_z(END)} AS z
        FROM (SELECT * FROM train UNION ALL SELECT * FROM test) x, {END})),
placed AS (
  SELECT cluster, u, score,
         row_number() OVER (PARTITION BY cluster ORDER BY score DESC, u) AS place
  FROM everyone JOIN assigned USING (u))""",
        select=f"""SELECT {big('cluster')}, {big('place')}, {USER}, {r6('score')} FROM placed
                   WHERE place <= 5""",
    ),
    "read_revision_tsv": with_(RAW, select=f"SELECT {RAW_COLUMNS} FROM raw"),
    "raw_accepted": with_(RAW, select=f"SELECT {RAW_COLUMNS} FROM raw"),
    "raw_rejects": f"""SELECT 'orders' AS first_cell, {big('71', 'cells')},
                       CAST(o_orderkey AS VARCHAR) AS revision_id
                       FROM orders WHERE o_orderkey % 50 = 0""",
    "raw_line_counts": """SELECT count(*) + count(*) FILTER (o_orderkey % 50 = 0) AS lines,
                          count(*) FILTER (o_orderkey % 50 = 0) AS rejected FROM orders""",
    "only_revisions": raw_ids("event_entity = 'revision'"),
    "drop_bots": raw_ids("event_user_is_bot_by IS NULL OR event_user_is_bot_by = ''"),
    "drop_anonymous": raw_ids("event_user_is_anonymous = FALSE"),
    "keep_namespaces": raw_ids("page_namespace IN (0, 1)"),
    "parse_ts_year_month": with_(
        RAW,
        select=f"""SELECT revision_id, epoch_us(ts) AS ts, {big('year(ts)', 'year')},
                   {big('month(ts)', 'month')} FROM raw""",
    ),
    "clean_orders": with_(
        RAW,
        CLEANED,
        select="SELECT " + ", ".join(map(_clean_column, CLEAN.fieldNames())) + " FROM cleaned",
    ),
    "clean_orders_as_landed": with_(
        RAW,
        CLEANED,
        select="SELECT " + ", ".join(map(_clean_column, CLEAN.fieldNames())) + " FROM cleaned",
    ),
    "clean_month_range": with_(
        RAW,
        CLEANED,
        select=f"""SELECT {big('year')}, {big('month')}, {big('count(*)', 'n')} FROM cleaned
                   WHERE ts >= '1996-03-01' AND ts < '1998-03-01' GROUP BY year, month""",
    ),
    "month_manifest": with_(
        months_cte(_ORDER_TIMES),
        select=f"""SELECT {big('year(m)', 'year')}, {big('month(m)', 'month')}, {_URL},
                   {big('-1', 'size')}, '' AS md5 FROM months""",
    ),
    "month_missing": with_(
        months_cte(_ALL_TIMES),
        select=f"""SELECT {big('year(m)', 'year')}, {big('month(m)', 'month')}, {_URL} FROM months
                   WHERE m NOT IN (SELECT date_trunc('month', t) FROM ({_ALL_TIMES}))""",
    ),
    "edit_rank": edits_query(f"{USER}, rev AS revision_id, {big('rk', 'edit_rank')}"),
    "edit_rank_events": edits_query(
        f"{USER}, rev AS revision_id, {big('rk', 'edit_rank')}", edits=EVENTS
    ),
    "first_window": edits_query(
        f"{USER}, rev AS revision_id, epoch_us(ts) AS ts, {big('rk', 'edit_rank')}",
        f"rk <= {WINDOW}",
    ),
    "post_window": edits_query(
        f"{USER}, rev AS revision_id, epoch_us(ts) AS ts", f"rk > {WINDOW}"
    ),
    "session_gaps": edits_query(
        f"""{USER}, rev AS revision_id,
            {r6(f"({seconds('ts')} - {seconds('prev_ts')}) / 60.0", 'gap_minutes')},
            prev_ts IS NULL OR {seconds('ts')} - {seconds('prev_ts')} > 1800 AS new_session""",
        f"rk <= {WINDOW}",
        edits=EVENTS,
    ),
    "window_bounds": profile(
        "epoch_us(first_ts) AS first_ts",
        "epoch_us(last_ts) AS last_window_ts",
        big("n", "window_edits"),
    ),
    "velocity": profile(r6("velocity")),
    "revert_rate": profile(r6("revert_rate")),
    "namespace_diversity": profile(r6("namespace_diversity")),
    "bytes_added_removed": profile(r6("avg_bytes_added"), r6("avg_bytes_removed")),
    "talk_page_ratio": profile(r6("talk_page_ratio")),
    "peak_hour": profile(
        big("peak_hour"), r6("peak_hour_sin"), r6("peak_hour_cos"), edits=EVENTS
    ),
    "weekend_ratio": profile(r6("weekend_ratio")),
    "edit_summary_rate": profile(r6("edit_summary_rate")),
    "minor_edit_ratio": profile(r6("minor_edit_ratio")),
    "session_count": profile(big("session_count"), edits=EVENTS),
    "first_edit_size": profile(big("first_edit_size")),
    "dropout_label": profile(big("dropout")),
    "editor_features": features(),
    "editor_features_window_5": features(window=5),
    "editor_features_full_window": features(full=True),
    "editor_features_censored": features(censor_after=CENSOR_AFTER),
    "event_user_features": features(edits=EVENTS, days=1),
    "stored_feature_table": features(),
    "feature_vector": with_(
        *feature_ctes(),
        select=" UNION ALL ".join(
            f"SELECT {USER}, {big(str(i), 'position')}, {r6(f, 'value')} FROM feats"
            for i, f in enumerate(F)
        ),
    ),
    "standardize_stats": with_(
        *feature_ctes(),
        *SPLIT[:4],
        select=" UNION ALL ".join(
            f"SELECT '{f}' AS feature, {r6('m_' + f, 'mean')}, {r6('s_' + f, 'std')}, "
            f"{big('n')} FROM scaler"
            for f in F
        ),
    ),
    "train_test_split": profile(f"{IN_TRAIN} AS in_train"),
    "sample_fraction": with_(
        *feature_ctes(),
        select=f"SELECT {USER} FROM feats "
        f"WHERE {hash32("u || ':7'")} / 4294967296.0 < 0.25",
    ),
    "scaled_features": with_(
        *feature_ctes(),
        *SPLIT,
        select=f"SELECT {USER}, {big('y', 'dropout')}, {FEATURE_LIST} FROM test",
    ),
    "logreg_weights_3ep": logreg_weights(THREE_EPOCHS),
    "logreg_weights": logreg_weights(LOGREG),
    "logreg_loss": logreg_loss(LOGREG),
    "logreg_weights_in_turns": logreg_weights(IN_TURNS),
    "logreg_loss_in_turns": logreg_loss(IN_TURNS),
    "logreg_loss_3ep": logreg_loss(THREE_EPOCHS),
    "model_json": logreg_weights(LOGREG),
    "logreg_scores": with_(*FITTED, select=f"SELECT {USER}, dropout, {r6('score')} FROM scored"),
    "predictions": with_(
        *FITTED,
        select=f"""SELECT {USER}, dropout,
                   {big('CASE WHEN score >= 0.5 THEN 1 ELSE 0 END', 'predicted')} FROM scored""",
    ),
    "class_split": with_(
        *FITTED,
        select=f"""SELECT round(score, 6) AS score, {big('sum(dropout)', 'pos')},
                   {big('sum(1 - dropout)', 'neg')} FROM scored GROUP BY round(score, 6)""",
    ),
    "confusion_matrix": with_(*METRICS, select="SELECT * FROM confusion"),
    "auc_roc": with_(*METRICS, select=f"SELECT {r6('auc_roc')} FROM auc"),
    "auc_roc_many_slices": with_(*METRICS, select=f"SELECT {r6('auc_roc')} FROM auc"),
    "missing_scores": with_(
        *FITTED,
        MISSING,
        *[c.replace("FROM scored", "FROM scored_known") for c in (CONFUSION, AUC, RATES)],
        select=f"""SELECT tp, fp, tn, fn, {r6('precision')}, {r6('recall')}, {r6('accuracy')},
                   {r6('f1')}, {r6('auc_roc')} FROM rates, auc""",
    ),
    "mlp_scores": with_(
        *feature_ctes(),
        "feats_m AS MATERIALIZED (SELECT * FROM feats)",
        scaler_cte("feats_m"),
        scaled_cte("points", "feats_m"),
        *_layers("net_z", "points", _start(UNTRAINED), UNTRAINED.hidden),
        select=f"SELECT {USER}, {r6(_sigmoid('z'), 'score')} FROM net_z",
    ),
    "mlp_weights": mlp_weights(ONE_COPY),
    "mlp_weights_two_copies": mlp_weights(TWO_COPIES),
    "mlp_weights_mini_batches": mlp_weights(
        MINI_BATCHES, steps=4, batch="(SELECT CAST(ceil(count(*) / 6) AS BIGINT) FROM train)"
    ),
    "mlp_metrics": with_(
        *FEATS,
        *NETWORK,
        select=f"""SELECT tp, fp, tn, fn, {r6('precision')}, {r6('recall')}, {r6('accuracy')},
                   {r6('f1')}, {r6('auc_roc')} FROM net_rates, net_auc""",
    ),
    "binary_metrics": with_(
        *METRICS,
        select=f"""SELECT tp, fp, tn, fn, {r6('precision')}, {r6('recall')}, {r6('accuracy')},
                   {r6('f1')}, {r6('auc_roc')} FROM rates, auc""",
    ),
    "kmeans_init": with_(*CLUSTERED[: len(feature_ctes()) + 3], select="""
        SELECT u AS event_user_id FROM points ORDER BY md5(u || ':7'), u LIMIT 4"""),
    "kmeans_centers_3it": kmeans_centers(KMeansSpec(iters=3, shift_tol=0.0, cost_tol=0.0)),
    "kmeans_centers": kmeans_centers(KMEANS),
    "kmeans_iterations": with_(
        *CLUSTERED, select=f"SELECT {big('done', 'iterations')} FROM s{KMEANS.iters}"
    ),
    "kmeans_assign": with_(
        *CLUSTERED,
        ASSIGNED,
        select=f"""SELECT {USER}, {big('cluster')}, {r6('nearest')}, {r6('second')}
                   FROM assigned""",
    ),
    "wcss": with_(
        *CLUSTERED,
        ASSIGNED,
        select="""SELECT (SELECT round(sum(nearest), 3) FROM assigned) AS wcss,
                         (SELECT round(last, 3) FROM s30) AS wcss_lagged""",
    ),
    "simplified_silhouette": with_(
        *CLUSTERED, ASSIGNED, select=f"SELECT {r6(_SILHOUETTE, 'silhouette')} FROM assigned"
    ),
    "cluster_profile": with_(
        *CLUSTERED,
        ASSIGNED,
        PROFILE,
        select=f"SELECT {big('cluster_id')}, {big('cluster_size')}, "
        + ", ".join(r6(f"mean_{f}") for f in F)
        + " FROM profile",
    ),
    "feed_filter": with_(
        FEED, select="SELECT title, 'mainwiki' AS wiki, 'edit' AS type FROM feed"
    ),
    "feed_envelope": with_(
        FEED,
        select=f"""SELECT "user", title, {big('namespace')}, {big('ts')}, {big('bytes_diff')},
                   comment, {big('minor')}, {big('is_revert')}, FALSE AS corrupt FROM feed""",
    ),
    "feed_coerced": f"""
SELECT CAST(user_id AS VARCHAR) AS "user", 'page ' || event_id AS title,
  {big('CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 2 END', 'namespace')},
  {seconds('CAST(ts AS TIMESTAMP)')} AS ts,
  {big(f"CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 7 WHEN 3 THEN 50 - {_K} ELSE 0 END",
       'bytes_diff')},
  event_type AS comment, {big('CASE WHEN event_id % 6 IN (0, 2, 5) THEN 1 ELSE 0 END', 'minor')},
  {big('CASE WHEN event_id % 4 < 2 THEN 1 ELSE 0 END', 'is_revert')}, FALSE AS corrupt
FROM events WHERE event_id % 7 NOT IN (0, 1)""",
    "feed_counts": """SELECT count(*) AS lines,
                      count(*) FILTER (event_id % 101 = 0) AS unreadable FROM events""",
    "stream_malformed": with_(
        BAD_ENVELOPES,
        select=f"""SELECT "user", title, ts, {r6(_sigmoid('z'), 'dropout_risk')}
                   FROM (SELECT *, {_plain_z()} AS z FROM bad)""",
    ),
    "stream_partial_features": with_(
        FEED,
        PROXIES,
        select=f"""SELECT "user", title, {big('ts')}, {FEATURE_LIST} FROM proxies""",
    ),
    "stream_scores": with_(
        *FITTED,
        FEED,
        PROXIES,
        SCALED_FEED,
        select=f"""SELECT "user", title, {big('ts')}, {r6(_sigmoid('z'), 'dropout_risk')}
                   FROM (SELECT x."user", x.title, x.ts, {_z(END)} AS z
                         FROM scaled_feed x, {END})""",
    ),
    "stream_scores_table": with_(
        *FITTED,
        FEED,
        PROXIES,
        SCALED_FEED,
        select=f"""SELECT "user", title, {big('ts')}, {r6(_sigmoid('z'), 'dropout_risk')}
                   FROM (SELECT x."user", x.title, x.ts, {_z(END)} AS z
                         FROM scaled_feed x, {END})""",
    ),
    "stream_first_features": features(edits=EVENTS, days=1),
    "cohort_summary": with_(
        *feature_ctes(),
        select=f"""SELECT {big('count(*)', 'n_editors')}, {r6('avg(dropout)', 'dropout_rate')}
                   FROM feats""",
    ),
    "model_compare": with_(
        *METRICS,
        select=f"""SELECT 'logreg' AS model, {r6('auc_roc')}, {r6('f1')}, {r6('precision')},
                   {r6('recall')}, {r6('accuracy')} FROM rates, auc""",
    ),
    "model_compare_both": with_(
        *METRICS,
        *NETWORK,
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS model, {r6('auc_roc')}, {r6('f1')}, {r6('precision')}, "
            f"{r6('recall')}, {r6('accuracy')} FROM {p}rates, {p}auc"
            for name, p in (("logreg", ""), ("mlp", "net_"))
        ),
    ),
    "panel_auc_both": with_(
        *METRICS,
        *NETWORK,
        select=f"""SELECT 'logreg' AS model, {r6('auc_roc')} FROM auc UNION ALL
                   SELECT 'mlp' AS model, {r6('auc_roc')} FROM net_auc""",
    ),
    "optional_metrics": with_(
        *FEATS,
        select=f"""SELECT 'saved' AS name, TRUE AS found, {big('n', 'n_train')} FROM scaler
                   UNION ALL SELECT 'absent', FALSE, NULL""",
    ),
    "panel_auc": with_(*METRICS, select=f"SELECT 'logreg' AS model, {r6('auc_roc')} FROM auc"),
    "panel_confusion": with_(
        *METRICS,
        select=" UNION ALL ".join(
            f"SELECT {big(str(a), 'actual')}, {big(str(p), 'predicted')}, {big(c, 'n')} "
            "FROM confusion"
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ),
    ),
    "panel_cluster_sizes": with_(
        *CLUSTERED,
        ASSIGNED,
        PROFILE,
        select=f"SELECT {big('cluster_id')}, {big('cluster_size')} FROM profile",
    ),
    "panel_revert_vs_velocity": with_(
        *CLUSTERED,
        ASSIGNED,
        PROFILE,
        select=f"""SELECT {big('cluster_id')}, {big('cluster_size')}, {r6('mean_revert_rate')},
                   {r6('mean_velocity')} FROM profile""",
    ),
    "results_table": results_table("CAST(NULL AS DOUBLE)"),
    "results_table_with_network": results_table("net_auc.auc_roc", NETWORK, ", net_auc"),
    "summary": summary(),
    "summary_with_network": summary(
        f", {r6('net_auc.auc_roc', 'dnn_auc_roc')}", NETWORK, ", net_auc"
    ),
    "survival_curve": with_(
        ORDERS,
        f"""
lives AS (
  SELECT u, CAST(floor(({seconds('max(ts)')} - {seconds('min(ts)')}) / 86400) AS BIGINT) AS days,
         CASE WHEN (SELECT {seconds('max(ts)')} FROM edits) - {seconds('max(ts)')} > 180 * 86400
              THEN 1 ELSE 0 END AS gone
  FROM edits GROUP BY u)""",
        """
curve AS (
  SELECT d.days, d.events, (SELECT count(*) FROM lives l WHERE l.days >= d.days) AS at_risk
  FROM (SELECT days, sum(gone) AS events FROM lives GROUP BY days HAVING sum(gone) > 0) d)""",
        select=f"""SELECT {big('days')}, {big('events')}, {big('at_risk')},
                   {r6('product(1 - events / at_risk) OVER (ORDER BY days)', 'survival')}
                   FROM curve""",
    ),
    "top_risk": with_(
        *FITTED,
        select=f"""SELECT {USER}, {r6('score')} FROM scored
                   ORDER BY round(scored.score, 6) DESC, u LIMIT 20""",
    ),
}
