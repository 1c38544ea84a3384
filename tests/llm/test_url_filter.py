import random

from tabml.llm.queries import URL_RULES
from tabml.llm.url_filter import filter_urls

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    rest = (url or "").partition("://")
    host = path = ""
    if rest[1]:
        cut = min([rest[2].find(c) for c in "/?#" if c in rest[2]], default=len(rest[2]))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[2][:cut])
        tail = rest[2][cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    return host, path, max(fits)[2], max(fits)[3]


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").repartition(3)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, spark.createDataFrame(rules, RULES)).collect()}


def test_contract_rules_and_edge_urls(spark):
    urls = ["http://WWW.Example.com/en/1", "https://blog.example.com/en/x?q=1#t", "http://example.com/en", "x://com/", "http://com", "http://notexample.com/en/", "http://a.net/es/", "http://net/fr/1",
            "http://a.net/de/", "http://a.org/en/", None, "", "no scheme", "http://", "://com/a", "http://example.com?x=/en/", "a://b://c.net/es/", "http://É.com/en/", "http://x.com/" + "a" * 50_000,
            "http://com./en/", "http://.com/", "http://user@example.com:80/en/"] * 2
    got = judged(spark, urls, URL_RULES)
    assert got == {i: brute(u, URL_RULES) for i, u in enumerate(urls)}


def test_random_nested_rules_match_brute_force(spark):
    rng = random.Random(5)
    hosts = [".".join(rng.choices(["a", "b", "a-b", "c"], k=rng.randint(1, 4))) for _ in range(40)] + [""]
    paths = ["/" + "".join(rng.choices("ab/", k=rng.randint(0, 4))) for _ in range(20)] + [""]
    rules = list({(h, p): (h, p, v) for h, p, v in ((rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(80))}.values())
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'b', '?x'])}" for _ in range(300)]
    got = judged(spark, urls, rules)
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_empty_tables_clashing_columns_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "own", "own")], "page_id bigint, url string, rule string, rkey string")
    none = spark.createDataFrame([], RULES)
    row = filter_urls(pages, none).collect()[0]
    assert (row.rule, row.verdict, row.rkey) == (None, "allow", "own")
    odd = spark.createDataFrame([(None, None, "block"), ("com", "/", None), ("com", "/", "allow"), ("com", "/", "block")], RULES)
    assert filter_urls(pages, odd).collect()[0].rule == "com/"
    assert filter_urls(pages, odd).collect()[0].verdict == "block"
    assert filter_urls(pages.limit(0), odd).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id bigint, url string")
    plan = filter_urls(pages, spark.createDataFrame(URL_RULES, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
