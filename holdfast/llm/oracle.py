"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_KEYWORDS = _either_case("password|passwd|secret|token|api_?key")
_ASSIGN = rf"""({_KEYWORDS})["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""".replace("\\'", "''")
_KINDS = {"assign": _ASSIGN, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
_LEAST = {"assign": 6, "access": 20, "hex": 24}
_CANDIDATE = "[A-Za-z0-9+/_=-]+"


def _places(name: str, pattern: str) -> str:
    """Matches with their places: the lengths of all matches and gaps before them."""
    return f"""
{name}_cut AS (
  SELECT r, i, gaps[i] AS gap, found[i] AS m
  FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps,
               regexp_extract_all(t, '{pattern}') AS found FROM docs),
       unnest(range(1, len(found) + 1)) AS u(i)),
{name} AS (
  SELECT r, m, CAST(sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m) AS BIGINT) AS s
  FROM {name}_cut WINDOW w AS (PARTITION BY r ORDER BY i))"""


def _base(order: int, kind: str) -> str:
    value = f"regexp_extract(m, '{_ASSIGN}', 2)" if kind == "assign" else "m"
    return (
        f"SELECT r, s, {order} AS k, s + length(m) AS e, '{kind}' AS kind, {value} AS value "
        f"FROM {kind} WHERE length({value}) >= {_LEAST[kind]}"
    )


OP1 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{",".join(_places(kind, pattern) for kind, pattern in _KINDS.items())},
{_places("candidate", _CANDIDATE)},
base AS ({" UNION ALL ".join(_base(i, kind) for i, kind in enumerate(_KINDS))}),
samples AS (
  SELECT DISTINCT label, lower(v) AS v, v AS v0 FROM (
    SELECT 1 AS label, value AS v FROM base UNION ALL
    SELECT 0, unnest(regexp_extract_all(t, '[A-Za-z]{{12,}}')) FROM docs)
  WHERE length(v) >= 12),
pairs AS (
  SELECT label, substr(v, i, 2) AS p, count(*) AS n
  FROM samples, unnest(range(1, length(v))) AS u(i) GROUP BY ALL),
totals AS (SELECT label, p[1] AS a, sum(n) AS n FROM pairs GROUP BY ALL),
tried AS (
  SELECT c.*, lower(m) AS v FROM candidate c
  WHERE length(m) >= 20 AND regexp_matches(m, '[A-Za-z]')
    AND (SELECT count(DISTINCT label) FROM samples) = 2),
scored AS (
  SELECT r, s, s + length(m) AS e,
    sum(ln((coalesce(p1.n, 0) + 0.5) / (coalesce(t1.n, 0) + 64)) -
        ln((coalesce(p0.n, 0) + 0.5) / (coalesce(t0.n, 0) + 64))) AS ratio
  FROM (SELECT *, substr(v, i, 2) AS p FROM tried, unnest(range(1, length(v))) AS u(i)) x
  LEFT JOIN pairs p1 ON p1.label = 1 AND p1.p = x.p
  LEFT JOIN pairs p0 ON p0.label = 0 AND p0.p = x.p
  LEFT JOIN totals t1 ON t1.label = 1 AND t1.a = x.p[1]
  LEFT JOIN totals t0 ON t0.label = 0 AND t0.a = x.p[1]
  GROUP BY r, s, m, v),
spans AS (
  SELECT r, s, k, e, kind FROM base UNION ALL
  SELECT r, s, 3, e, 'random' FROM scored WHERE ratio >= 10 AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.r = scored.r AND b.s < scored.e AND scored.s < b.e)),
told AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
    count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base_text,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_text, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (r)
"""

OP5 = f"""
WITH cut AS (
  SELECT page_id, url, row_number() OVER () AS r,
    CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
         ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
hosts AS (
  SELECT page_id, r, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM cut),
parts AS (
  SELECT page_id, r, translate(raw_host, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM hosts),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (r)
"""

OP6 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
runs AS (
  SELECT r, p, array_to_string(list_slice(words, p, p + 34), ' ') AS run
  FROM docs, unnest(range(1, len(words) - 33)) AS u(p)),
starts AS (
  SELECT r, p FROM runs WHERE run IN (SELECT run FROM runs GROUP BY run HAVING count(*) > 1)),
placed AS (SELECT r, i, words[i] AS word FROM docs, unnest(range(1, len(words) + 1)) AS u(i)),
marked AS (
  SELECT r, i, word, max(p) OVER (
    PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS removed
  FROM (SELECT x.*, y.p FROM placed x LEFT JOIN starts y ON x.r = y.r AND x.i = y.p)),
done AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
  FROM marked GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN done USING (r)
"""

OP9 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
cut AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (
  SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS k FROM cut),
frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
told AS (
  SELECT r, i, line, k IN (SELECT k FROM frequent) AS dropped FROM keyed),
done AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS kept
  FROM told GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN done USING (r)
"""

OP10 = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM docs WINDOW same AS (PARTITION BY body)
"""



def _told(column: str) -> str:
    value = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    columns = ["doc_id", "source", "lang", "n_chars", text]
    return f"sha256({' || '.join(map(_told, columns))})"


def _tree(name: str, leaves: str) -> str:
    """Nodes of trees by level, from leaves (tree, pos, h); and the runs of nodes with a parent."""
    return f"""
{name}(tree, level, pos, h) AS (
  SELECT tree, 0, pos, h FROM ({leaves})
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1
  GROUP BY tree, level, pos // 3),
{name}_top AS (SELECT tree, max(level) AS top, arg_max(h, level) AS root FROM {name} GROUP BY tree),
{name}_runs AS (
  SELECT tree, level, pos // 3 AS run, list(h ORDER BY pos) AS hs
  FROM {name} JOIN {name}_top USING (tree) WHERE level < top GROUP BY ALL)"""


def _climb(name: str, tree: str, start: str) -> str:
    """From rows (r, tree, pos, cur, path) to the roots: the digest folded and the siblings met."""
    return f"""
{name}(r, tree, level, pos, cur, path) AS (
  SELECT r, tree, 0, pos, cur, path FROM ({start})
  UNION ALL
  SELECT r, c.tree, c.level + 1, pos // 3,
    sha256(array_to_string(hs[:pos % 3], '') || cur || array_to_string(hs[pos % 3 + 2:], '')),
    path || array_to_string(hs[:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], '')
  FROM {name} c JOIN {tree}_runs x ON x.tree = c.tree AND x.level = c.level AND run = pos // 3)"""


OP11 = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
docs AS (
  SELECT row_number() OVER () AS r, *, coalesce('=' || source, '') AS tree,
    CASE WHEN xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
          lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1])), 4294967295) % 2 = 0
      THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents, crc_table),
hashed AS (SELECT r, doc_id, tree, {_leaf("text")} AS leaf, {_leaf("changed")} AS other FROM docs),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, other) - 1 AS pos FROM hashed),
{_tree("nodes", "SELECT tree, pos, leaf AS h FROM placed")},
sources AS (SELECT tree, root, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes_top),
{_tree("above", "SELECT 0 AS tree, pos, root AS h FROM sources")},
{_climb("inside", "nodes", "SELECT r, tree, pos, other AS cur, '' AS path FROM placed")},
done AS (SELECT r, tree, cur, path FROM inside JOIN nodes_top USING (tree) WHERE level = top),
{_climb("outside", "above",
        "SELECT r, 0 AS tree, pos, cur, path FROM done JOIN sources USING (tree)")},
folded AS (SELECT r, cur, path FROM outside WHERE level = (SELECT top FROM above_top))
SELECT doc_id, leaf, n.root AS subroot, a.root, sha256(path) AS proof_sha256,
  cur AS folded_root, cur = a.root AS verified
FROM placed p JOIN nodes_top n USING (tree) JOIN folded USING (r), above_top a
"""


def _vectors(scale: int) -> str:
    """Usable rows, numbered, and their floored components."""
    return f"""
used AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
    embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)"""


_INNER = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))"

OP12 = f"""
WITH {_vectors(256)},
rows AS (
  SELECT r, vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM used WHERE label IS NOT NULL),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
    CAST({_INNER} AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT r, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.other ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.r = p.r AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
  negative_score
FROM negatives WHERE rank <= 10
"""

OP13 = f"""
WITH {_vectors(1024)}
SELECT a.vec_id AS query_id, CAST(row_number() OVER best AS INTEGER) AS rank, b.vec_id,
  CAST({_INNER} AS BIGINT) AS score
FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
WINDOW best AS (PARTITION BY a.r ORDER BY {_INNER} DESC, b.vec_id)
QUALIFY row_number() OVER best <= 10
"""

ORACLE: dict[str, str] = {
    "op1_secret_scan": OP1,
    "op5_url_filters": OP5,
    "op6_substring_dedup": OP6,
    "op9_line_dedup": OP9,
    "op10_exact_dedup": OP10,
    "op11_merkle_manifest": OP11,
    "op12_hard_negatives": OP12,
    "op13_exact_topk": OP13,
}
