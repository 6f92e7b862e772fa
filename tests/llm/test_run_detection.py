"""Periodic runs against brute force."""
from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from turnstile.llm import run_detection

SCHEMA = "doc_id long, text string, runs string, start long, _id int"


def brute_runs(words, min_length=24, times=3):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, times * q) and not any(s <= i and j + q <= e and q % p == 0 for s, e, p in out):
                out.append((i, j + q, q))
            i = j + 1
    return sorted((s, e, q) for s, e, q in out)


def some_texts(rng):
    def block(k, letters):
        return [rng.choice(letters) for _ in range(k)]

    texts = []
    for _ in range(300):
        out = []
        for _ in range(rng.randint(0, 4)):
            kind, letters = rng.random(), [chr(97 + i) for i in range(rng.choice([1, 2, 3, 30]))]
            if kind < .4:
                out += block(rng.randint(0, 40), letters)
            elif kind < .8:
                b = block(rng.randint(1, 12), letters)
                out += (b * 40)[:rng.randint(1, 120)]
            else:
                b = block(rng.randint(1, 4), letters)
                out += ((b * 20)[:rng.randint(8, 60)] + block(2, letters)) * rng.randint(1, 5)
        texts.append(out)
    a, b = "a", "b"
    fib = [b, a]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    tm = "a"
    for _ in range(10):
        tm += "".join(b if x == a else a for x in tm)
    return texts + [list(fib[-1]), list(tm), list(tm + tm + tm), ["x"] * 700, (["x"] * 30 + ["y"]) * 12]


@pytest.mark.parametrize("min_length,times", [(24, 3), (6, 2), (2, 2), (10, 4)])
def test_all_runs(min_length, times):
    texts = some_texts(random.Random(min_length))
    ids = {}
    flat = np.array([ids.setdefault((r, w), len(ids)) for r, t in enumerate(texts) for w in t], np.int64)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    s, e, q = run_detection.all_runs(flat, first, min_length, times)
    want = [(first[r] + i, first[r] + j, p) for r, t in enumerate(texts) for i, j, p in brute_runs(t, min_length, times)]
    assert list(zip(s.tolist(), e.tolist(), q.tolist())) == want


def test_grammar_leaves_no_repeated_pair_and_derives_the_text():
    texts = some_texts(random.Random(9))
    for t in [x for x in texts if len(x) > 1]:
        ids = np.unique(t, return_inverse=True)[1]
        g = run_detection.Grammar(ids, np.array([0, len(t)]))
        by = {}
        for k, at, left, size in zip(g.symbol.tolist(), g.at.tolist(), g.left.tolist(), g.size.tolist()):
            by.setdefault(k, set()).add((tuple(t[at:at + size]), left))
        assert all(len(v) == 1 for v in by.values())  # one expansion and boundary for all positions
        assert max(g.size) == len(t)
        spans = sorted(zip(g.at.tolist(), (g.at + g.size).tolist()))
        assert len(spans) == len(t) - 1  # a binary derivation


def digest_of(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if i is None else zlib.crc32(str(i).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
    runs = brute_runs(words)
    gone = {k for s, e, q in runs for k in range(s + q, e)}
    best = max(runs, key=lambda r: ((r[1] - r[0]) / r[2], -r[0], -r[2]), default=None)
    first = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, len(runs), *first, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))),
            sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_digest(spark):
    rng = random.Random(2)
    texts = [None, "", " \n", "one", "a " * 100, "é x\x1cy " * 30] + [" ".join(t) for t in some_texts(rng)] + [
        " ".join(f"w{rng.randint(0, 400)}" for _ in range(600)) for _ in range(60)]
    rows = [(i, t, "clash", 1, 1) for i, t in enumerate(texts)] + [(None, "b " * 50, "", 1, 1), (None, None, "", 1, 1), (4, texts[4], "", 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = run_detection.digest(docs)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([digest_of(r[0], r[1]) for r in rows], key=str)
    assert run_detection.digest(docs.limit(0)).count() == 0
    got = {r["doc_id"]: r for r in run_detection.detect(docs.filter("doc_id < 6")).collect()}
    assert got[4]["collapsed"] == "a" and got[4]["strongest"]["length"] == 100 and got[0]["runs"] == []


def test_long_text_of_one_word(spark):
    docs = spark.createDataFrame([(1, "w " * 200_000), (3, " ".join(f"w{i % 5000}" for i in range(100_000)))], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in run_detection.detect(docs).collect()}
    assert got == {1: [(0, 200_000, 1)], 3: [(0, 100_000, 5000)]}
