import random

import pytest

from feedwright.llm.url_filter import Rule, filter_urls

RULES = [Rule.parse(v, k) for v, k in (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))]


def brute_force(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.key), len(r.host)), default=None)
    return host, path, best and best.key, best.verdict if best else "allow"


def urls(seed):
    r = random.Random(seed)
    out = [None, "", "no scheme", "://", "http://", "a://b://c/d", "HTTP://WWW.EXAMPLE.COM/en/7?x", "http://example.com/en/70", "x\n://com/en/",
           "http://com/en/", "http://.com/en/", "http://example.com:80/en/7", "http://notexample.com/en/7", "http://É.Example.net/de/8/x", "http://a/en/#://com/en/"]
    for _ in range(300):
        host = r.choice(["", "www.", "a.b.", "x"]) + r.choice(["example", "other", "ex"]) + "." + r.choice(["com", "net", "org", "dev"])
        out.append(r.choice(["http", "https"]) + "://" + host + r.choice(["", "/"]) + r.choice(["en", "de", "es", "EN"]) + r.choice(["", "/", "/7", "/8", "/81", "?a=/en/"]))
    return out


@pytest.mark.parametrize("bits_per_key,max_bits", [(12, 1 << 27), (1, 1)])
def test_equals_brute_force(spark, bits_per_key, max_bits):
    found = urls(1)
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(found)], "page_id long, url string, host string, path string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in filter_urls(df, RULES, max_bits=max_bits, bits_per_key=bits_per_key).collect()}
    assert got == {i: brute_force(u, RULES) for i, u in enumerate(found)}


def test_many_rules_need_several_levels(spark, monkeypatch):
    import feedwright.llm.url_filter as uf

    monkeypatch.setattr(uf, "HASHES", 1)
    r = random.Random(2)
    rules = [Rule(r.choice(["allow", "block"]), f"h{i}.com", "/") for i in range(6000)]
    found = [f"http://h{i}.com/x" for i in range(0, 30000)]
    df = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in filter_urls(df, rules, bits_per_key=1).collect()}
    assert got == {i: (f"h{i}.com", "/x", rules[i].key if i < 6000 else None, rules[i].verdict if i < 6000 else "allow") for i in range(30000)}


def test_repeated_rows_empty_tables_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://x.org/es/"), (1, "http://x.org/es/"), (None, None)], "page_id long, url string")
    assert sorted(x.verdict for x in filter_urls(df, RULES).collect()) == ["allow", "block", "block"]
    assert filter_urls(df, []).where("verdict = 'allow' AND rule IS NULL").count() == 3
    assert filter_urls(df.limit(0), RULES).count() == 0
