import pytest

from shelf.llm import urlfilter as u

URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.com", "http://example.com/", "https://a.EXAMPLE.com/en/x", "http://www.example.com/en/1", "http://x.www.example.com/en/1", "http://notexample.com/en/",
        "http://a.net/es/x", "http://net/fr/", "http://net/de/", "x://h.org/p?q=http://b.com/", "http://com/", "http://c.com?x", "http://c.com#/en/", "ftp://example.com/en", "http://ÄB.com/é", "http://" + "a." * 3000 + "net/fr/" + "z" * 50_000,
        "://example.com/en/", "http://.com/", "http://example.com:80/en/"] * 2


def plain(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for r in rules:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.key) > len(best.key)):
            best = r
    return host, path, best.key if best else None, best.verdict if best else "allow"


def frame(spark, urls):
    return spark.createDataFrame([(i, x, "h", "p", "r") for i, x in enumerate(urls)], "page_id long, url string, host string, path string, rule string")


def test_rules_match_brute_force(spark):
    got = {r.page_id: tuple(r)[1:] for r in u.judge_urls(frame(spark, URLS)).collect()}
    assert got == {i: plain(x, u.RULES) for i, x in enumerate(URLS)}


def test_many_rules(spark):
    rules = tuple(u.Rule("block", f"h{i}.org", f"/{'x' * (i % 5)}") for i in range(200))
    urls = [f"http://s.h{i}.org/{'x' * (i % 7)}" for i in range(300)]
    got = {r.page_id: tuple(r)[1:] for r in u.judge_urls(frame(spark, urls), rules).collect()}
    assert got == {i: plain(x, rules) for i, x in enumerate(urls)}


def test_ties_have_an_order(spark):
    rules = (u.Rule("allow", "a.org", "/x"), u.Rule("block", "a.org", "/x"), u.Rule("allow", "b.c.org", "/"), u.Rule("block", "c.org", "/xy"))
    got = {r.page_id: (r.rule, r.verdict) for r in u.judge_urls(frame(spark, ["http://a.org/x", "http://b.c.org/xyz"]), rules).collect()}
    assert got == {0: ("a.org/x", "block"), 1: ("b.c.org/", "allow")}


def test_the_query_blocks_by_its_list(spark):
    """Fails if the list of URLs, its filter or its join is bypassed."""
    sf = "/root/testdata/sf0.1"
    got = u.op3_urlfilter(spark, sf).where("rule is null and verdict = 'block'").collect()
    assert len(got) > 5 and all(set(r.host.split(".")) & set(u.UNWANTED) for r in got)
    plan = u.op3_urlfilter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "MapInArrow" not in plan and "Python" not in plan


def test_listed_urls_are_exact(spark):
    listed = spark.createDataFrame([(f"http://site{i}.org/p{i}",) for i in range(500)] + [(None,), ("HTTPS://Site7.org/p7#x",)], "url string")
    urls = [f"https://SITE{i}.org/p{i}?utm_source=a#f" for i in range(1500)] + [None, "http://site1.org/p1?x=1"]
    got = {r.page_id: r.verdict for r in u.judge_urls(frame(spark, urls), (), listed).collect()}
    assert got == {i: "block" if i < 500 else "allow" for i in range(len(urls))}


def test_the_filter_lets_few_others_pass(spark):
    from pyspark.sql import functions as F

    keys = spark.range(2400).selectExpr("concat('k', id) as key")
    filled = u.bloom_blocks(keys, 100)
    probes = spark.range(20_000).selectExpr("concat(if(id < 2400, 'k', 'other'), id) as key", "id").withColumn("block", u._block(F.col("key"), 100))
    hits = probes.join(filled, "block").where(u._maybe(F.col("key"), [F.col(f"w{i}") for i in range(8)]))
    assert hits.where("id < 2400").count() == 2400
    assert hits.where("id >= 2400").count() < 60


def test_empty_table(spark):
    assert u.judge_urls(frame(spark, URLS).where("false")).count() == 0


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError):
        u.judge_urls(frame(spark, URLS), tuple(u.Rule("block", f"{i}.org", "/") for i in range(30_000)))
