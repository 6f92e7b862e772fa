"""Near-dedup by sketches against brute force over all pairs."""
from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from turnstile.llm import families, flat, minhash_dedup
from turnstile.llm.families import Sets

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n long, comp string, kept int"


def brute(rows, k=2, num=4, den=5):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").encode().translate(low))
        sets.setdefault(i, set()).update({tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set())
    least = {i: i for i in sets}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                a1, b1 = top(a), top(b)
                least[max(a1, b1)] = min(a1, b1)
    return [(i, len(sets[i]), top(i), top(i) == i) for i in ids]


def edited(rng, words, share, vocabulary):
    return [rng.choice(vocabulary) if rng.random() < share else w for w in words]


def some_rows(rng):
    vocabulary = [f"w{i}" for i in range(300)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [say(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 20, 60, 200, 500])) for _ in range(120)]
    for base in list(texts):  # near copies around the bound, short and long
        for _ in range(3):
            texts.append(edited(rng, base, rng.choice([0, .02, .05, .08, .1]), vocabulary))
        texts.append(base[1:])
        texts.append(base + say(1))
    base, passage = say(150), say(60)
    texts += [edited(rng, base, rng.choice([.04, .06, .09]), vocabulary) for _ in range(150)]  # a group whose pairs link by half
    texts += [passage + say(rng.randint(5, 90)) for _ in range(60)] + [base] * 40
    rng.shuffle(texts)
    return [(i, rng.choice([" ", "\n", "  "]).join(t)) for i, t in enumerate(texts)]


def test_components(spark, monkeypatch):
    monkeypatch.setattr(families, "BLOCK", 20)  # long lists fall into several blocks
    rows = some_rows(random.Random(7))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "A b"), (5004, "a B"), (5005, "é é é")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in [(i, t, 1) for i, t in rows]], SCHEMA)
    out = minhash_dedup.digest(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted(map(tuple, out.collect()))
    want = brute(rows)
    assert got == want and len({r[2] for r in want}) < len(rows)
    again = docs.union(docs.limit(30)).union(spark.createDataFrame([(None, "a b", 1, "", 1), (None, "a b", 1, "", 1)], SCHEMA))
    found = minhash_dedup.digest(again).collect()
    assert len(found) == len(rows) + 32 and sorted({tuple(r) for r in found if r[0] is not None}) == want
    assert [tuple(r) for r in found if r[0] is None] == [(None, 1, None, True)] * 2
    assert minhash_dedup.digest(docs.limit(0)).count() == 0


def test_another_bound(spark):
    rows = some_rows(random.Random(3))[:250]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spec = minhash_dedup.Spec(shingle=3, num=1, den=2)
    got = sorted((r["doc"], r["n"], r["comp"], r["doc"] == r["comp"]) for r in minhash_dedup.groups(docs, spec=spec).collect())
    assert got == brute(rows, 3, 1, 2)


def test_links_share_a_list():
    """Sets that just reach the similarity share the key of a run of retained values."""
    rng, spec = np.random.default_rng(3), minhash_dedup.Spec()
    wanted = minhash_dedup.key_widths(spec)
    for n in [*range(1, 40), 100, 300, 1000]:
        for _ in range(20):
            union = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            other = n - -(-4 * n // 5)
            cut = int(rng.integers(0, other + 1))
            keys = []
            for own in (np.concatenate([union[:cut], union[other:]]), union[cut:]):
                values = np.sort(own)[:spec.size]
                keys.append(set(minhash_dedup.list_keys(values, np.array([0, len(values)]), np.array([len(own)]), spec, wanted)[0].tolist()))
            assert keys[0] & keys[1]


def test_estimates_let_links_through():
    rng, spec = np.random.default_rng(5), minhash_dedup.Spec()
    rows, n = [], []
    for size in (10, 128, 200, 900, 5000):
        for _ in range(40):
            union = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            other = size // 5
            for own in (union[:size - other], np.concatenate([union[:size - 2 * other], union[size - other:], union[size - 2 * other:size - other]])[:]):
                kept = np.sort(own)[:spec.size]
                rows.append(np.concatenate([kept, np.full(spec.size - len(kept), minhash_dedup._END)]))
                n.append(len(own))
    i = np.arange(0, len(rows), 2)
    ok, estimate = minhash_dedup.may_link(np.stack(rows), np.array(n), i, i + 1, spec)
    assert ok.all() and abs(estimate.mean() - .8) < .02
    far, _ = minhash_dedup.may_link(np.stack(rows), np.array(n), i, np.roll(i, 1), spec)
    assert not far.any()


def test_rows_sorted_by_key_keep_those_that_share_one():
    rng = random.Random(1)
    rows = sorted({(rng.randint(0, 60), rng.randint(0, 9), 1) for _ in range(120)})
    table = pa.table([pa.array(list(c), pa.int64()) for c in zip(*rows)], names=["key", "doc", "n"])
    docs = {k: [r[1] for r in rows if r[0] == k] for k, _, _ in rows}
    want = [(k, d, n, docs[k][0]) for k, d, n in rows if len(docs[k]) > 1]
    for size in (1, 2, 7, 1000):
        out = [tuple(r.values()) for b in families._shared(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert [r[:4] for r in out if r[1] is not None] == want
        ends = {r[0]: r for r in out if r[1] is None}
        assert {k: r[2] for k, r in ends.items()} == {k: len(d) for k, d in docs.items() if len(d) > 1}
        first = first if size > 1 else {k: r[4:] for k, r in ends.items()}
        assert {k: r[4:] for k, r in ends.items()} == first and len(set(first.values())) == len({tuple(docs[k]) for k in ends})


def test_words_of_one_polynomial_hash_differ():
    """Thue-Morse strings meet in any polynomial hash modulo 2**64."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    w = flat.Words(pa.array([a + " " + b]), flat.byte_class(flat.SPACES))
    assert len(set(w.hashes().tolist())) == 2
    s = Sets(pa.array([" ".join([a, "x"] * 3), " ".join([b, "x"] * 3)]), 2)
    assert not set(s.h[:s.first[1]].tolist()) & set(s.h[s.first[1]:].tolist())


def test_stored_sketches_keep_order_and_high_bytes():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64))
    off = np.array([0, 100, 100, 300])
    col = flat.strings(minhash_dedup._packed(values), minhash_dedup.KEPT * off, pa.binary())
    got, first = minhash_dedup._values(col)
    assert got.tolist() == (values >> np.uint64(24) << np.uint64(24)).tolist() and first.tolist() == off.tolist()
    assert (minhash_dedup._padded(col, 256)[1] == minhash_dedup._END).all()
