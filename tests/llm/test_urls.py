from recado.llm import urls
from recado.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host int, verdict string, rule int"


def brute(rows, rules):
    out = []
    for i, url, *_ in rows:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
            path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((i, host, path, best and best[3], best[4] if best else "allow"))
    return sorted(out, key=repr)


URLS = ["http://a.net/x", "https://net/", "http://net", "http://EXAMPLE.net/en/1?q#f", "http://m.example.net/en/2", "http://notexample.net/en/",
        "http://example.com/de/", "http://example.com/de", "http://b.example.com/de/9#x", "ftp://x.org/fr/a/b", "http://org/fr/", "http://x.org?/fr/",
        "no scheme", "", None, "://", "://net/", "http://a..net/", "http://net:80/", "x://y://net/", "http://.net/", "http://a.net//x", "HTTP://É.NET/",
        "http://a.b.c.d.e.f.net/" + "long/" * 20_000, "http://net\n/x", "http://a.example.net/en/"]


def rows(spark):
    made = [(i, u, "h", 1, "x", 1) for i, u in enumerate(URLS)] + [(0, URLS[0], "h", 1, "x", 1), (None, URLS[1], "h", 1, "x", 1)]
    return made, spark.createDataFrame(made, PAGES)


def test_contract_rules(spark):
    made, pages = rows(spark)
    got = urls.judge(pages, spark.createDataFrame(URL_RULES, urls.RULE_SCHEMA))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(made, URL_RULES)


def test_other_rules(spark):
    """Paths that end inside a segment, empty ones, equal lengths, one rule with both verdicts."""
    rules = [("net", "", "block"), ("example.net", "/e", "allow"), ("a.net", "/x", "allow"), ("net", "/x//", "block"), ("org", "/fr", "block"),
             ("org", "/fr", "allow"), ("x.org", "/", "allow"), ("c.d.e.f.net", "/long/long", "allow")]
    made, pages = rows(spark)
    got = urls.judge(pages, spark.createDataFrame(rules, urls.RULE_SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(made, rules)


def test_empty(spark):
    made, pages = rows(spark)
    rules = spark.createDataFrame(URL_RULES, urls.RULE_SCHEMA)
    assert urls.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}
