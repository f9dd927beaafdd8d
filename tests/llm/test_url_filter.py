import random

import pytest

from holdfast.llm import queries, url_filter

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = min((rest.split(c, 1)[0] for c in "/?#"), key=len)
    path = min((rest[len(host) :].split(c, 1)[0] for c in "?#"), key=len)
    return host.translate(UPPER), path


def brute(url, rules):
    host, path = parts(url)
    fits = [
        r
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block"))
    return host, path, best.host + best.path, best.verdict


def urls():
    rng = random.Random(3)
    hosts = ["example.org", "a.EXAMPLE.org", "org", "notexample.org", "x.com", "com", "", "é.com", "a..org"]
    tails = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/de/", "/fr/a#b", "/de/", "?q", "#/de/", "/de/😀"]
    made = [f"{rng.choice(['http', '', 'a://b'])}://{rng.choice(hosts)}{rng.choice(tails)}" for _ in range(300)]
    return [*made, None, "", "://", "example.org/es/", "x" * 20_000 + "://org/", "http://org/" + "y" * 20_000]


@pytest.mark.parametrize(
    "rules",
    [
        queries.URL_RULES,
        [],
        [*queries.URL_RULES, *queries.URL_RULES],
        [
            url_filter.Rule("org", "/es", "block"),
            url_filter.Rule("com", "", "block"),
            url_filter.Rule("x.com", "/", "allow"),
            url_filter.Rule("com", "/", "block"),
        ],
    ],
)
def test_equals_brute_force(spark, rules):
    rows = [(i % 250, u, i, i) for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, best bigint, ROW bigint")
    judged = url_filter.judge(pages, url_filter.rule_table(spark, rules))
    got = {r.best: tuple(r)[1:] for r in judged.select("row.best", "host", "path", "rule", "verdict").collect()}
    assert got == {i: brute(u, rules) for i, (_, u, _, _) in enumerate(rows)}


def test_full_digests_decide(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "short_prefix", lambda digest: url_filter.F.lit("same"))
    pages = spark.createDataFrame([(1, "http://org/es/")], "page_id bigint, url string")
    row = url_filter.judge(pages, url_filter.rule_table(spark, queries.URL_RULES)).first()
    assert (row.rule, row.verdict) == ("org/", "allow")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(pages, url_filter.rule_table(spark, queries.URL_RULES)).count() == 0
