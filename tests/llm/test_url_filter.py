import random

import pytest

from locusweave.llm import url_filter
from locusweave.llm.url_filter import ALLOW, BLOCK


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(url, rules, sites=(), words=url_filter.WORDS):
    host, path = parts(url)
    fits = lambda t: (host == t.partition("/")[0] or host.endswith("." + t.partition("/")[0])) and path.startswith("/" + t.partition("/")[2])
    best = max(((len(t), len(t.partition("/")[0]), t, v) for v, t in rules if fits(t)), default=None)
    if best:
        return host, path, best[2], best[3]
    bare = "".join(c if c.isascii() and (c.islower() or c.isdigit()) else " " for c in host).split()
    return host, path, None, BLOCK if any(map(fits, sites)) or set(bare) & set(words) else ALLOW


URLS = [
    None, "", "no scheme", "http://", "http:///x", "http://com", "http://com/", "HTTP://Example.COM/en/x", "https://www.example.com/en/", "https://a.www.example.com/en/7?x=/en/", "https://example.com/EN/",
    "http://b.example.net/es/1", "http://example.net?q=/es/", "http://example.net/es#top", "http://xcom/", "http://x.com.org/", "http://free-bets.example.org/", "http://alphabets.example.org/", "a://b://c.net/fr/",
    "http://casino.example.net/fr/", "http://casino.example.net/de/", "http://É.net/fr/é", "http://x.net/fr/\n?a", "http://shop.bad.org/list/4", "http://bad.org/lis", "http://h.net/" + "x" * 300_000, "http://" + "a." * 5000 + "net/es/z",
]


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_against_every_rule(spark, bits):
    rng = random.Random(bits)
    hosts = [".".join(rng.choice(["a", "b", "com", "net", "bad", "casino", "x-ads"]) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    urls = URLS + [f"http://{h}{rng.choice(['', '/', '/en', '/en/', '/en/a/b', '/es/', '?/en/'])}" for h in hosts]
    rules = (*url_filter.RULES, (BLOCK, "a.b/"), (ALLOW, "b/en"), (BLOCK, "b.com/en/a"), (ALLOW, "a.b.com/"), (ALLOW, "bad/en/a/"))
    sites = ("bad.org/list/", "b.net/", "casino/en/")
    rows = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls)] + [(0, None, "r", "v"), (None, "http://q.net/es/", "r", "v")], "page_id long, url string, rule string, verdict string")
    got = url_filter.judge(rows, url_filter.build(spark, rules, sites, bits=bits)).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        url = "http://q.net/es/" if r["page_id"] is None else urls[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(url, rules, sites), str(url)[:80]


def test_empty_and_wrong_lists(spark):
    rows = spark.createDataFrame([(1, "http://ads.com/")], "page_id long, url string")
    assert url_filter.judge(rows, url_filter.build(spark, (), (), ())).first()["verdict"] == ALLOW
    assert url_filter.judge(rows.limit(0), url_filter.build(spark)).collect() == []
    with pytest.raises(ValueError):
        url_filter.build(spark, [(ALLOW, "a/"), (BLOCK, "a/")])
    with pytest.raises(ValueError):
        url_filter.build(spark, [(ALLOW, "no-path")])
