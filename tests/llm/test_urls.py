"""URL filters against brute force."""

import random

import pytest

from auditlark.llm import queries, urlfilter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def brute(url, rules, otherwise="allow"):
    host, path = parts(url)
    best = None
    for verdict, rule in rules:
        h, p = rule.split("/", 1) if "/" in rule else (rule, None)
        h, p = "".join(c.lower() if "A" <= c <= "Z" else c for c in h), "" if p is None else "/" + p
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h), len(p), verdict == "block", h + p, verdict))
    return (host, path, best[3], best[4]) if best else (host, path, None, otherwise)


URLS = [None, "", "no scheme/at all", "http://", "http://example.org", "http://EXAMPLE.org/", "https://a.b.example.org/en/1", "https://example.org/en/12/x?y#z",
        "https://example.org/en", "https://notexample.org/es/", "https://example.org/es/", "ftp://x.com/fr/1://y.org/", "http://com/de/?q", "http://com#/de/",
        "http://example.org:8080/es/", "http://.org/", "http://org./", "http://example.org//es/", "http://xn--é.org/ü", "https://m.example.com/fr/" + "a/" * 3000,
        "http://a\nb.org/c\nd?e", "mailto:x@example.org", "http://" + "s." * 2000 + "org/"]


def test_judge_equals_brute_force(spark):
    rng = random.Random(6)
    rules = list(queries.URL_RULES) + [("block", "org"), ("allow", "b.example.org/en"), ("block", "EXAMPLE.org/En"), ("allow", "x.com/"), ("block", "x.com/")]
    hosts = ["org", "example.org", "b.example.org", "com", "x.com", "y.x.com"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/1", "/en/1/", "/en/12", "/es", "/es/", "/es/a/b"]
    rules += [(rng.choice(["allow", "block"]), rng.choice(hosts) + rng.choice(paths)) for _ in range(40)]
    urls = URLS + [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'www.', 'a.b.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'x', '/1', '?a=/es/', '#f'])}" for _ in range(300)]
    rows = [(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, urls[5])]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS host", "1 AS verdict", "'r' AS `rule`", "2 AS q")
    expected = sorted(((i, u, 2, *brute(u, rules, "block")) for i, u in rows), key=repr)

    def result(given, **options):
        return sorted(((r.page_id, r.url, r.q, r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, given, otherwise="block", **options).collect()), key=repr)

    assert result(rules) == expected
    assert result(rules, rules_per_pass=7) == expected
    assert result(spark.createDataFrame([*rules, rules[0], (None, "a"), ("block", None)], "verdict string, rule string"), rules_per_pass=12) == expected


def test_deep_rules_and_no_rules(spark):
    deep = ("block", "a." * 3000 + "org/" + "p/" * 3000)
    df = spark.createDataFrame([("http://z." + deep[1],), ("http://org/",)], "url string")
    assert [r.verdict for r in urlfilter.judge(df, [deep]).collect()] == ["block", "allow"]
    assert [(r.rule, r.verdict) for r in urlfilter.judge(df, []).collect()] == [(None, "allow")] * 2
    assert urlfilter.judge(df.limit(0), [deep]).count() == 0
    with pytest.raises(ValueError):
        urlfilter.judge(df, [("maybe", "org/")])


def test_query_of_urls(spark, tmp_path):
    spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(URLS)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op12_url_filter(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(((i, *brute(u, queries.URL_RULES)) for i, u in enumerate(URLS)), key=repr)
