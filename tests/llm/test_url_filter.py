"""Mined url rules: whole tokens, support, and matching against plain Python."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from turnstile.llm import url_filter


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, tokens string")


SIGNALS = {
    "third directory": lambda x: f"http://h.test/a/b/{x}/i",
    "second query key": lambda x: f"http://h.test/p?a=1&{x}=2",
    "inner subdomain": lambda x: f"http://www.{x}.h.test/p",
    "behind forty characters": lambda x: f"http://h.test/{'d' * 40}{x}/i",
    "tenth directory": lambda x: f"http://h.test/{'/'.join('abcdefghi')}/{x}/i",
    "long extension": lambda x: f"http://h.test/p.longextension{x}",
}


@pytest.mark.parametrize("name", SIGNALS)
def test_signals_anywhere_in_a_url_are_mined(spark, name):
    urls = [SIGNALS[name]("spam" if i % 2 else "fine") for i in range(40)]
    labels = spark.createDataFrame([(i, "block" if i % 2 else "allow") for i in range(0, 30)], "page_id long, verdict string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages_of(spark, urls), labels, rules=()).collect()}
    assert got == {i: "block" if i % 2 else "allow" for i in range(40)}


def test_few_pages_make_no_rule(spark):
    urls = [f"http://h.test/{'x' if i < 4 else 'y'}/{i}" for i in range(50)]
    labels = spark.createDataFrame([(i, "block" if i < 4 else "allow") for i in range(50)], "page_id long, verdict string")
    judged = url_filter.judge(pages_of(spark, urls), labels, rules=())
    assert judged.filter("verdict = 'block'").count() == 0
    assert url_filter.judge(pages_of(spark, urls), labels, rules=(), least_pages=4).filter("verdict = 'block'").count() == 4


def plain_tokens(url):
    host, path, tail = "", "", ""
    scheme, found, rest = (url or "").partition("://")
    if found:
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut].lower(), rest[cut:]
        cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        path, tail = rest[:cut], rest[cut:]
    out, labels = set(), host.split(".")
    out |= {"host=" + ".".join(labels[i:]) for i in range(len(labels)) if ".".join(labels[i:])}
    import re

    out |= {"dir=" + re.sub("[0-9]+", "0", d) for d in path.split("/")[:-1] if d}
    if tail.startswith("?"):
        out |= {"query=" + re.split("=", q)[0] for q in re.split("[&;]", tail[1:].split("#")[0]) if re.split("=", q)[0]}
    if found and re.fullmatch("[A-Za-z0-9+.-]+", scheme):
        out.add("scheme=" + scheme.lower())
    if m := re.search(r"(\.[A-Za-z0-9]+|/)$", path):
        out.add("file=" + m[1])
    if "#" in tail:
        out.add("fragment=yes")
    return sorted(out)


def test_tokens_and_rules_equal_plain_python(spark):
    rng = random.Random(4)
    pick = lambda *x: rng.choice(x)
    urls = [None, "", "x", "a://", "HTTP://B.C:80/x/?a&b=;c#", "http://a..b//c//d.e?=1&=", "http://é.org/ü/9/9.html#x"]
    urls += [f"{pick('http', 'https')}://{pick('a', 'b.a', 'c.b.a', 'd')}.{pick('com', 'net', 'org')}/{pick('', 'x/', 'x/y/', 'z9/')}"
             f"{pick('i.html', '', '7')}{pick('', '?p=1', '?q=1&p=2')}{pick('', '#f')}" for _ in range(300)]
    pages = pages_of(spark, urls)
    host, path, tail = url_filter.parts(F.col("_url"))
    rows = pages.select("page_id", F.col("url").alias("_url")).withColumns({"host": host, "path": path, "tail": tail})
    assert {r[0]: r[1] for r in rows.select("page_id", url_filter.tokens()).collect()} == {i: plain_tokens(u) for i, u in enumerate(urls)}
    marks = [(i, pick("block", "allow") if rng.random() < .2 else ("block" if "/x/" in (urls[i] or "") else "allow")) for i in range(0, 300, 2)]
    labels = spark.createDataFrame(marks, "page_id long, verdict string")
    got = url_filter.judge(pages, labels, rules=(), min_support=0.03, min_confidence=0.7).collect()
    # every subset of a labelled page's tokens that is frequent and confident enough is a rule
    from itertools import combinations

    least = max(5, -(-3 * len(marks) // 100))
    total = {}
    for i, v in marks:
        t = plain_tokens(urls[i])
        for k in range(1, len(t) + 1):
            for c in combinations(t, k):
                total.setdefault(c, []).append(v)
    rules = {c: (v.count("block"), len(v)) for c, v in total.items()}
    confident = {}
    for c, (block, n) in rules.items():
        for verdict, with_it in (("block", block), ("allow", n - block)):
            if with_it >= least and with_it / n >= 0.7:
                confident.setdefault(frozenset(c), []).append((with_it / n, with_it, verdict))
    for r in got:
        t = set(plain_tokens(urls[r["page_id"]]))
        fit = [x for c, xs in confident.items() if c <= t for x in xs]
        if not fit:
            assert r["mined"] is None and r["verdict"] == "allow"
            continue
        top = max(x[:2] for x in fit)
        assert r["verdict"] in {x[2] for x in fit if x[:2] == top}, r


def test_rule_list_equals_plain_python(spark):
    rng = random.Random(6)
    urls = [f"http://{''.join(rng.choice(['a.', 'b.', '', 'my']) for _ in range(2))}{rng.choice(['example.net', 'net', 'example.com', 'org', 'fr.org', 'xnet'])}"
            f"{rng.choice(['', '/', '/en', '/en/', '/de/1', '/fr', '/fr/x?y', '?/en/'])}" for _ in range(300)]
    labels = spark.createDataFrame([], "page_id long, verdict string")
    for r in url_filter.judge(pages_of(spark, urls), labels).collect():
        fit = [(len(rule), rule, verdict) for verdict, rule in url_filter.RULES
               if (r["host"] == rule.split("/")[0] or r["host"].endswith("." + rule.split("/")[0])) and r["path"].startswith("/" + rule.partition("/")[2])]
        best = max(fit, default=(0, None, "allow"))
        assert (r["rule"], r["verdict"]) == best[1:]
