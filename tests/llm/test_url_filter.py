import math
import re
from collections import Counter

import pytest

from recordflow.llm import url_filter
from recordflow.llm.queries import URL_RULES

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    found = None
    for text in sorted(RULES, key=len):
        at = text.index("/")
        if (host == text[:at] or host.endswith("." + text[:at])) and path.startswith(text[at:]):
            found = text
    return found


def test_rules_and_edges(spark):
    urls = [
        None, "", "no scheme/de/", "http://", "http://x.net", "http://X.NET/a", "ftp://net/", "http://notnet/", "http://a.example.net/en/1",
        "http://example.net/EN/1", "http://example.com/de/7?q=1", "http://myexample.com/de/7", "http://a.org/fr/#x", "http://a.org?x=/fr/",
        "http://b.org#/fr/", "http://u://v.net/x", "http://x.com/fr/1", "http://ÄB.net/ü", "http://x.net\n/a",
    ]
    rows = [(i % 7, u, "h", "t", 1) for i, u in enumerate(urls * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, text string, score int")
    got = url_filter.judge(df, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = parts(r["row"].url)
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        assert r.verdict in ("allow", "block") and (r.rule is None or r.verdict == RULES[r.rule])
        assert host or path or r.verdict == "allow"
    assert url_filter.judge(df.limit(0), URL_RULES).collect() == []


def test_the_models_tell_hosts_apart(spark):
    good = [f"http://garden{i}.flowers.org/fr/rose/{i}" for i in range(60)]
    bad = [f"http://win{i}.casino.net/slots/{i}" for i in range(60)]
    new = [f"http://park{i}.flowers.com/rose/{i}" for i in range(5)] + [f"http://top{i}.casino.com/slots/{i}" for i in range(5)]
    df = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    got = {r["row"].url: (r.rule, r.verdict) for r in url_filter.judge(df, URL_RULES).collect()}
    assert [got[u] for u in new] == [(None, "allow")] * 5 + [(None, "block")] * 5


def test_gram_scores_equal_plain_code(spark):
    texts = {"abcab": (3, 0), "abd": (0, 2), "bcd": (1, 1)}
    grams = Counter(), Counter()
    for text, n in texts.items():
        padded = "^^^^" + text
        for i in range(len(text)):
            for c in (0, 1):
                grams[c][padded[i : i + 5]] += n[c]
    every = set(grams[0]) | set(grams[1])

    def p(c, gram, k):
        if k == 0:
            return 1 / 128
        tail, low = gram[5 - k :], p(c, gram, k - 1)
        seen = Counter()
        for g, n in grams[c].items():
            if g[5 - k : 4] == tail[:-1]:
                seen[g[4]] += n
        n, types = sum(seen.values()), sum(v > 0 for v in seen.values())
        return (seen[tail[-1]] + types * low) / (n + types) if n + types else low

    df = spark.createDataFrame([(g, grams[0][g], grams[1][g]) for g in every], "gram string, accepted long, rejected long")
    got = {r.gram: r.score for r in url_filter.gram_scores(df).collect()}
    assert set(got) == every
    for g in every:
        assert got[g] == pytest.approx(1e6 * math.log(p(0, g, 5) / p(1, g, 5)), abs=1)
