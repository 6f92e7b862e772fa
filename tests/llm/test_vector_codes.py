"""Vector codes against plain Python integers."""
from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from turnstile.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _id int"


def brute(rows):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    width = len(kept[0][1]) // 16
    piece = lambda v, p: v[p * width:(p + 1) * width]
    books = [[piece(v, p) for _, v, _ in kept[:64]] for p in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((far(piece(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(2):
        new = []
        for p in range(16):
            held = [[] for _ in books[p]]
            for _, v, _ in kept:
                held[near(v, p)[1]].append(piece(v, p))
            new.append([[sum(c) // len(h) for c in zip(*h)] if h else old for h, old in zip(held, books[p])])
        books = new
    seal = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, lab in kept:
        best = [near(v, p) for p in range(16)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return [(i, code, error, total[lab], seal) for i, code, error, lab in out]


def test_codes_equal_plain_integers(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([-2, 0, 5]) for _ in range(64)], rng.choice([1, 2, None])) for i in range(150)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (None, rows[4][1], 2)]  # repeated ids and vectors, no id
    odd = [(200, None, 1), (201, [None] * 64, 1), (202, [float("nan")] * 64, 1), (203, [float("inf")] + [0.0] * 63, None)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows + odd], SCHEMA)
    got = sorted(map(tuple, vector_codes.digest(frame).collect()), key=str)
    assert got == sorted(brute(rows + odd), key=str)
    # lengths that the parts don't divide, other lengths and integers out of range are dropped
    more = spark.createDataFrame([(300, [1.0] * 16, 1, "", 1), (301, [1.0] * 63, 1, "", 1), (302, [], 1, "", 1), (303, [1e30] * 64, 1, "", 1)], SCHEMA)
    assert sorted(map(tuple, vector_codes.digest(frame.unionByName(more)).collect()), key=str) == got
    assert vector_codes.digest(frame.limit(0)).count() == 0
    assert vector_codes.digest(frame.filter("vec_id >= 200")).count() == 0


def test_limb_products_are_exact():
    rng = np.random.default_rng(1)
    for size in (1 << 8, 1 << 26, 1 << 29):
        v, c = (rng.integers(-size, size, (3, n, 4)) for n in (50, 7))
        want = [[[sum(int(x) * int(y) for x, y in zip(r, e)) for e in c[p]] for r in v[p]] for p in range(3)]
        assert vector_codes.dots(v, c).tolist() == want
    wide = np.full((1, 1, 1), (1 << 26) - 1)
    assert vector_codes.nearest(np.concatenate([wide, -wide], 1), np.concatenate([wide, wide - 1], 1))[0].tolist() == [[0, 1]]


def test_ties_go_to_the_lower_entry():
    v = np.array([[[0, 0]]])
    books = np.array([[[1, 0], [0, 1], [-1, 0]]])
    best, far = vector_codes.nearest(v, books)
    assert best.tolist() == [[0]] and far.tolist() == [[1]]
