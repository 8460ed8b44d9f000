import re

from quillpair.llm import url_filters as U

URLS = [None, "", "no scheme", "http://", "http://NET", "https://a.example.net/en/1", "https://a.example.net/fr/",
        "http://example.net/en", "http://notexample.net/en/x", "http://example.com/de/9?q=/x#y", "http://x.org/fr/",
        "http://x.org:80/fr/", "http://org/fr/x", "HTTP://U@WWW.Example.COM/de/", "http://x.net?u=/a", "x://y.net/#z",
        "http://a.b.deep.example.net/en/x/y", "://net/", "http://example.net/\nz", "http://a.example.net./en/"]


def _brute(url, rules, default="allow"):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


def _run(spark, rules, urls):
    df = spark.createDataFrame([(i, u, "k", 1) for i, u in enumerate(urls)], "page_id long, url string, key string, row int")
    out = U.url_verdicts(df, U.rules_table(spark, rules)).collect()
    assert sorted(r.page_id for r in out) == list(range(len(urls)))
    return [tuple(r)[1:] for r in sorted(out)]


def test_given_rules(spark):
    assert _run(spark, U.RULES, URLS) == [_brute(u, U.RULES) for u in URLS]


def test_nested_rules_and_hot_host(spark):
    rules = [("net", "", "allow"), ("example.net", "", "block"), ("a.example.net", "", "allow"),
             ("example.net", "/p", "allow"), ("a.example.net", "/p/q/", "block"), ("com", "/", "block")]
    urls = [f"http://{h}example.{t}/{p}{i}" for i, (h, t, p) in enumerate(
        (h, t, p) for h in ("", "a.", "b.a.", "zz.", "a-") for t in ("net", "com", "nets") for p in ("", "p/", "p/q/"))]
    urls += [f"http://a.example.net/p/{i}" for i in range(300)]
    assert _run(spark, rules, urls) == [_brute(u, rules) for u in urls]


def test_no_rules_and_empty(spark):
    assert _run(spark, [("zz", "/", "block")], ["http://a.b/c"]) == [("a.b", "/c", None, "allow")]
    none = U.rules_table(spark).limit(0)
    df = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert [tuple(r) for r in U.url_verdicts(df, none).collect()] == [(1, "net", "/", None, "allow")]
    assert U.url_verdicts(df.limit(0), U.rules_table(spark)).collect() == []


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    plan = U.url_verdicts(df, U.rules_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
