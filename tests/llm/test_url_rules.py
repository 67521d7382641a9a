import pickle
import random
import time

import pytest

from helixframe.llm import queries, url_rules as u


def brute(rules, host, path):
    fits = [(len(h.split(".")), len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def test_split():
    assert u.split_url("HTTPS://WWW.Éx.Com/A/b?c#d") == ("www.Éx.com", "/A/b")
    assert u.split_url("x://a.com#/en/") == ("a.com", "") and u.split_url("a://b://c/d") == ("b:", "//c/d")
    assert u.split_url(None) == u.split_url("") == u.split_url("a.com/en") == ("", "") and u.split_url("://") == ("", "")


def test_longest_match_against_brute_force():
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "", "a..com"]
    paths = ["/", "/en/", "/en/x", "/e", "", "/en/x/", "/en//"]
    for _ in range(60):
        rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(6))}.values())
        trie = u.build_trie(rules)
        for host in [*hosts, "www.b.a.com", "xcom", "y.x.net", ".com"]:
            for path in [*paths, "/en/xy", "/en", "/english/", "/en/x/y/z"]:
                assert u.judge(trie, host, path) == brute(rules, host, path), (rules, host, path)


def test_many_rules_on_one_host():
    """A million rules build in a minute, and a url costs the same among a thousand and a million."""
    cost = {}
    for n in (1000, 1_000_000):
        began = time.time()
        trie = u.build_trie([("block" if k % 2 else "allow", "big.com", f"/news/{k * 7919 % 10_000_019:08d}") for k in range(n)])
        assert time.time() - began < 60
        urls = [f"/news/{k * 7919 % 10_000_019:08d}/more" for k in range(0, n, n // 1000)]
        began = time.time()
        for k, path in zip(range(0, n, n // 1000), urls, strict=True):
            assert u.judge(trie, "www.big.com", path) == ("big.com" + path[:-5], "block" if k % 2 else "allow")
        cost[n] = time.time() - began
    assert cost[1_000_000] < 10 * cost[1000] + 0.05
    assert u.judge(trie, "big.com", "/news/") == (None, None)


def test_deep_and_nested_rules_can_be_sent():
    rules = [("block", "x.y", "/" + "a" * k) for k in range(1, 3000)] + [("allow", "d.e", "/b" * 3000), ("allow", ".".join("c" * 3000), "/")]
    trie = pickle.loads(pickle.dumps(u.build_trie(rules)))
    assert u.judge(trie, "x.y", "/" + "a" * 1500 + "b") == ("x.y/" + "a" * 1500, "block")
    assert u.judge(trie, "d.e", "/b" * 3001)[1] == "allow" and u.judge(trie, "d.e", "/b" * 2999) == (None, None)
    with pytest.raises(ValueError, match="at most"):
        u.build_trie([("allow", "a", "/")] * (u.MAX_RULES + 1))


def test_tails_against_brute_force():
    rng = random.Random(9)
    tails = ["".join(rng.choices("ab", k=rng.randrange(0, 7))) for _ in range(40)]
    rules = list({t: (rng.choice(["allow", "block"]), "h.com", "/s/" + t) for t in tails}.values())
    trie = u.build_trie(rules)
    for _ in range(500):
        path = "/s/" + "".join(rng.choices("ab/", k=rng.randrange(0, 9)))
        assert u.judge(trie, "h.com", path) == brute(rules, "h.com", path)


def test_rows(spark):
    rows = [(1, "http://www.example.com/en/1"), (1, "http://www.example.com/en/1"), (2, "http://x.example.com/en/"), (3, None), (None, "http://a.net/es/?q"), (4, "http://example.com"), (5, "http://q.org/")]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, host string")
    got = sorted(map(tuple, u.filter_urls(pages, queries.URL_RULES).collect()), key=str)
    assert got == sorted(
        [(1, "www.example.com", "/en/1", "www.example.com/en/", "allow")] * 2
        + [(2, "x.example.com", "/en/", "example.com/en/", "block"), (3, "", "", None, "allow"), (None, "a.net", "/es/", "net/es/", "block"), (4, "example.com", "", None, "allow"), (5, "q.org", "/", None, "allow")],
        key=str,
    )
    assert u.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0
