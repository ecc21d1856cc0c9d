import random

from tidemark.llm import url_filter as u

ODD = [None, "", "no scheme/es/", "http://", "http://EXAMPLE.org", "http://Example.ORG/es/", "ftp://a.b.example.org/en/1?q=/es/",
       "x://example.org/en/12#f", "http://notexample.org/es/", "http://org/", "http://a.com/de/x://y/", "http://com/fr",
       "http://É.com/fr/é", "http://a.com?x=/fr/", "http://a.com:80/de/", "http://..org/", "http://example.org./es/",
       "http://a.com/" + "fr/" * 40000, "http://" + "a." * 20000 + "com/de/"]


def brute(url, rules, default="allow"):
    rest = "" if url is None or "://" not in url else url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    fits = [(len(h) + len(p or ""), len(h), a, h + (p or "")) for h, p, a in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


def test_judges_like_brute_force(spark):
    from tidemark.llm.catalog import URL_RULES
    rng = random.Random(1)
    urls = ODD + ["http://" + ".".join(rng.choices(["a", "b", "example"], k=rng.randint(0, 3)) + [rng.choice(["org", "com", "net"])])
                  + rng.choice(["/es/", "/en/1", "/fr/", "/de/", "/", ""]) + str(rng.randint(0, 9)) for _ in range(200)]
    pages = spark.createDataFrame([(i // 2, x, "h", 1, "k") for i, x in enumerate(urls)],
                                  "page_id bigint, url string, host string, rule int, other string")
    for rules in (URL_RULES, URL_RULES + [("a.com", "/fr/", "block"), ("com", "/fr/", "block"), (None, "/", "block"), ("net", None, "block")],
                  [("b.org", "/es/%d" % i, "block") for i in range(3000)], []):
        table = spark.createDataFrame(rules, u.RULES_SCHEMA)
        got = u.judge_urls(pages, table)
        assert got.columns == ["page_id", "url", "other", "host", "path", "rule", "verdict"]
        rows = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=repr)
        assert rows == sorted(((i // 2, x, *brute(x, rules)) for i, x in enumerate(urls)), key=repr)
    assert u.judge_urls(pages.where("page_id < 0"), table).count() == 0


def test_filter_never_loses_a_listed_key(spark):
    rules = spark.createDataFrame([(f"h{i}.org", f"/{i}") for i in range(2000)], "host string, path string")
    other = spark.createDataFrame([(f"h{i}.org", f"/{i + 1}") for i in range(2000)], "host string, path string")
    bloom = u.bloom_filter(rules, 256)
    assert u.might_be_listed(rules, bloom, 256).count() == 2000
    assert u.might_be_listed(other, bloom, 256).count() < 200
    assert u.might_be_listed(rules, u.bloom_filter(rules, 1), 1).count() == 2000


def test_plan_is_native(spark):
    from tidemark.llm.catalog import op5_url_filter
    plan = op5_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
