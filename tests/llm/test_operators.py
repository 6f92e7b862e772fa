"""Each operator against a brute-force version, on rows with nulls, ties, repeats, long texts and clashing columns."""
from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from turnstile.llm import (decontaminate, flat, jaccard_join, pii, quality_classifier, quality_rules, sentencepiece_codec,
                           substring_dedup, suffix_dedup, url_filter, warc)
from turnstile.llm.queries import model_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words long, spans string, _id int"


def texts() -> list[str | None]:
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["über", "x"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, base = say(60), say(90)
    near = base.split()
    near[45] = "changed"
    return [None, "", " \n ", "one", "a b c", base, base, " ".join(near), base.upper(), say(30) + " " + shared + "\n" + say(20),
            say(10) + " " + shared + " " + say(33), "same " * 400, "same " * 300, "z" * 3000, "z" * 1000, say(5000), shared]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "clash", i) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows + [(None, "lost w1 w2", None, None, None), (5, rows[5][1], 7, "clash", 5)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def encoded(docs):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]


def spread(n, starts, size):
    hit = [False] * n
    for s in starts:
        hit[s:s + size] = [True] * len(hit[s:s + size])
    return hit


def windows(units, size):
    where = {}
    for r, u in enumerate(units):
        for i in range(len(u) - size + 1):
            where.setdefault(tuple(u[i:i + size]), []).append((r, i))
    return where


def test_substring_dedup(docs, none):
    rows = encoded(docs)
    units = [WORD.findall(b) for _, b in rows]
    where = windows(units, 35)
    want = []
    for r, (i, _) in enumerate(rows):
        hit = spread(len(units[r]), [s for at in where.values() if len(at) > 1 for q, s in at if q == r], 35)
        kept = b" ".join(w for w, h in zip(units[r], hit) if not h)
        want.append((i, len(hit), sum(hit), hashlib.sha256(kept).hexdigest()))
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(map(tuple, substring_dedup.digest(docs).collect()), key=key) == sorted(want, key=key)
    assert substring_dedup.digest(none).count() == 0


@pytest.mark.parametrize("keep", ["none", "first"])
def test_suffix_dedup(docs, none, keep):
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(encoded(named))
    where = windows([b for _, b in rows], 200)
    for r, (i, b) in enumerate(rows):
        rows[r] = i, spread(len(b), [s for at in where.values() if len(at) > 1
                                     for q, s in (at if keep == "none" else at[1:]) if q == r], 200), b
    want = [(i, len(h), sum(h), bytes(c for c, x in zip(b, h) if not x)) for i, h, b in rows]
    got = suffix_dedup.remove_repeated_bytes(named, keep=keep).select("doc_id", "n_bytes", "n_removed", "kept_bytes").collect()
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in got) == want
    assert suffix_dedup.digest(none).count() == 0


def test_longest_factors():
    import numpy as np

    data = np.frombuffer(b"abracadabraabracadabra", np.uint8)
    levels = suffix_dedup.suffix_ranks(data, np.array([0, len(data)]), 22)
    sa = np.argsort(levels[-1][1])
    text = data.tobytes()
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    lcp = np.zeros(len(sa), np.int64)
    for i in range(1, len(sa)):
        a, b = text[sa[i - 1]:], text[sa[i]:]
        lcp[i] = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    earlier, _ = suffix_dedup.longest_factors(sa, lcp)
    for i, got in zip(sa.tolist(), earlier.tolist()):
        assert got == max([next((k for k in range(len(text) - i) if text[j + k] != text[i + k]), len(text) - i) for j in range(i)] or [0])


def test_quality(spark, docs, none):
    rng = random.Random(1)
    vocabulary = [a + b for a in ("the", "of", "ing", "and", "hou", "tre") for b in ("", "a", "en", "ly", "er", "st", "ou", "ti")]
    good = [" ".join(rng.choice(vocabulary) for _ in range(80)) + "." for _ in range(60)]
    bad = [t.replace(" ", " ### ") for t in good[:30]]
    rows = spark.createDataFrame([(100 + i, t) for i, t in enumerate(good + bad)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    labels = spark.createDataFrame([(100 + i, int(i < 60), 0) for i in range(90)] + [(None, 1, 0), (100, None, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_classifier.digest(rows, labels).collect()}
    held = [i for i in range(90) if got[100 + i]["held_out"]]
    assert len(got) == 108 and len(held) > 15
    assert sum(got[100 + i]["predicted"] == int(i < 60) for i in held) >= 0.9 * len(held)
    judged = {r["doc_id"]: r for r in quality_rules.digest(rows, labels).collect()}
    assert judged[0]["base_failed"] and not judged[0]["kept"] and judged[11]["n_repeat_words"] == 400
    assert sum(judged[100 + i]["kept"] for i in range(60)) >= 54 and sum(judged[160 + i]["kept"] for i in range(30)) <= 3
    few = labels.filter("quality = 1")
    for f in (quality_classifier.digest, quality_rules.digest):
        assert f(none, labels).count() == 0 and f(rows, few).count() == 109 and f(rows, labels.limit(0)).count() == 109


def test_classifier_counts_repeated_labels_and_ids_once(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["house", "tree", "of"] if i % 2 else ["###", "|||", "of"]) for _ in range(30))) for i in range(40)]
    marks = [(i, i % 2) for i in range(40)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int")
    repeated = spark.createDataFrame(rows + [r for r in rows[:3] for _ in range(20)], docs.schema)
    often = spark.createDataFrame(marks + [m for m in marks[:20] for _ in range(9)], labels.schema)
    want = quality_classifier.fit(docs, labels, sample=30)
    assert any(want[0]) and quality_classifier.fit(docs, often, sample=30) == want
    assert quality_classifier.fit(repeated, labels, sample=30) == want


def test_quality_threshold_counts_all_labelled_rows(spark):
    rng = random.Random(4)
    say = lambda n, odd: " ".join(rng.choice(["house", "tree", "of", "running"]) + str(i) + rng.choice(["", "", ",", ". #"][:odd]) for i in range(n))
    good = [(i, say(rng.randint(60, 300), 3 if i % 9 else 4)) for i in range(300)] + [(300, say(200 + 5 * i, 4)) for i in range(60)]
    docs = spark.createDataFrame(good + [(1000 + i, "# " * 90) for i in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(301)] + [(300, 1)] * 40 + [(1000 + i, 0) for i in range(5)], "doc_id long, quality int")
    for loss in (0.0, 0.02, 1.0):
        got = quality_rules.judge(docs, labels, sample=20, max_loss=loss, max_repeated=1.1).filter("doc_id < 1000").collect()
        score = sorted((r["anomaly"] for r in got), reverse=True)
        limit = score[min(int(loss * len(got)), len(got) - 1)]
        assert len(got) == 360 and score[0] > score[-1]
        assert sorted(r["anomaly"] for r in got if r["kept"]) == [x for x in score[::-1] if x <= limit]


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTPS://Example.NET/en/1?q=1#x", "http://a.example.net/de/2", "ftp://shop.example.com/de/",
            "http://x.org/fr", "http://y.org/fr/1", "http://net", "http://net/", "http://badexample.net2/en/"] + [
            f"http://{'spam' if i % 2 else 'fine'}.test/p/{i}" for i in range(40)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(i, "block" if i % 2 == 0 else "allow") for i in range(11, 51)], "page_id long, verdict string")
    got = {r["page_id"]: r for r in url_filter.judge(pages, labels, min_support=0.1).collect()}
    rules = [got[i]["rule"] for i in range(11)]
    assert rules == [None, None, None, "example.net/en/", "net/", "example.com/de/", None, "org/fr/", None, "net/", None]
    assert (got[3]["host"], got[3]["path"], got[0]["host"]) == ("example.net", "/en/1", "")
    assert all(got[i]["verdict"] == ("block" if i % 2 == 0 else "allow") for i in range(11, 51))
    assert url_filter.judge(pages.limit(0), labels, min_support=0.1).count() == 0
    assert url_filter.judge(pages, labels.limit(0)).filter("mined is not null").count() == 0


def test_warc_with_magic_in_payloads(spark, scratch):
    import duckdb

    fake = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "u", "a" * 300), (2, "u", fake * 3), (3, None, None), (4, "u", warc.MAGIC), (5, "a\r\nB: c", "a" * 300),
            (6, "u", fake + "q" * 150 + warc.MAGIC + "WARC-Type: x\r\nContent-Length: 99999\r\n\r\n"), (7, "u", fake * 3), (8, "u", "é" * 60 + fake)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    got = sorted(map(tuple, warc.digest(pages, f"{scratch}/w").collect()))
    assert got == sorted(con.sql(warc.ORACLE).fetchall())
    uris = {r["rid"]: r["uri"] for r in warc.read(spark, f"{scratch}/w").collect()}
    assert uris["5"] == "a\r\nB: c" and uris["3"] is None
    assert warc.digest(pages.limit(0), f"{scratch}/e").count() == 0


def test_decontaminate(spark, docs, none):
    shared = texts()[-1]
    tests = spark.createDataFrame([(1, shared), (2, "one"), (3, None), (None, "W1  w2"), (2, "A-b c")], "item_id long, text string")
    got = {(r["doc_id"], r["n_words"]): r for r in decontaminate.find(docs, tests).collect()}
    assert got[(16, 60)]["n_hit"] == 60 and got[(16, 60)]["items"][-1] == "1" and got[(16, 60)]["contaminated"]
    assert got[(3, 1)]["items"] == ["2"] and got[(4, 3)]["items"] == ["2"] and got[(0, 0)]["n_hit"] == 0
    assert got[(None, 3)]["items"] == [""] and got[(9, 110)]["n_hit"] >= 60
    blocks = decontaminate.find(docs, tests, block_bytes=30).select("doc_id", "n_hit", "spans", "items")
    whole = decontaminate.find(docs, tests).select("doc_id", "n_hit", "spans", "items")
    assert sorted(map(str, blocks.distinct().collect())) == sorted(map(str, whole.distinct().collect()))
    assert decontaminate.digest(none, tests).count() == 0 and decontaminate.digest(docs, tests.limit(0)).filter("n_hit > 0").count() == 0


def test_decontaminate_in_blocks_keeps_every_row(spark, docs):
    tests = spark.createDataFrame([(1, texts()[-1]), (2, "one"), (None, "w1  w2"), (4, "a b c"), (5, texts()[5])], "item_id long, text string")
    again = [(None, "one"), (None, "one"), (None, None), (None, ""), (None, None), (7, "one"), (7, "one")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(again, "doc_id long, text string")).unionByName(docs.select("doc_id", "text"))
    bag = lambda size: sorted(map(str, decontaminate.find(rows, tests, block_bytes=size, extra=("text",)).collect()))
    blocks = bag(30)
    assert len(blocks) == rows.count() == 45 and blocks == bag(8 << 20)


def test_sentencepiece(docs, none):
    import pyarrow as pa
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    got = sentencepiece_codec.encode(docs, model_path(), extra=("text",)).collect()
    assert len(got) == 19 and all(list(r["ids"]) == lib.encode(r["text"] or "", add_bos=True, add_eos=True) for r in got)
    assert all(r["decoded"] == (r["text"] or "") for r in got) and sentencepiece_codec.digest(none, model_path()).count() == 0
    rng = random.Random(2)
    parts = ["a", "th", "ing", " ", "   ", "\n", "é", "漢", "😀", "▁", "\0", "<s>", "zz", "ab" * 40, " " * 33]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    ids, first = sentencepiece_codec.Model(model_path()).encode(pa.array(odd))
    assert all(ids[a:b].tolist() == lib.encode(t) for t, a, b in zip(odd, first, first[1:]))


def test_jaccard_join(docs, none):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, b in encoded(docs.filter("doc_id is not null")):
        w = WORD.findall(b.translate(low))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.digest(docs).collect()}
    assert got == {(i, len(s), least[i]) for i, s in sets.items()} | {(None, 1, None)}
    left = [r["doc_id"] for r in jaccard_join.one_of_each(docs).select("doc_id").collect()]
    assert sorted(x for x in left if x is not None) == sorted(i for i in sets if least[i] == i) and left.count(None) == 1
    assert jaccard_join.digest(none).count() == 0


def test_blocks_find_every_pair_that_may_link():
    import numpy as np

    from turnstile.llm import families

    rng = np.random.default_rng(11)
    rows, sets = [], []
    for key, size in enumerate([1, 2, 5, 40, 200, 3]):  # 200 fill more than a leaf
        base = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
        for _ in range(size):
            sets.append(np.unique(np.concatenate([base[:rng.integers(1, 61)], rng.integers(0, 1 << 62, rng.integers(0, 30), dtype=np.uint64)])))
            rows.append((key, 0, int(rng.choice([0, 1, 2])), bool(rng.integers(0, 2)), len(rows), int(rng.integers(0, 3)), int(rng.integers(0, 4)), len(sets[-1])))
    r = dict(zip(("key", "block", "side", "cross", "doc", "fam", "comp", "n"), map(np.array, zip(*rows))))
    for key in range(6):  # sides and crossing are a block's own
        at = r["key"] == key
        r["cross"][at] = r["cross"][at][0]
        r["side"][at] = 2 if key % 2 else r["side"][at] % 2
    n = np.array([len(x) for x in sets])
    s = flat.revive(families.Sets, {"h": np.concatenate(sets), "first": np.concatenate([[0], np.cumsum(n)]), "n": n})
    x, y, _, row = jaccard_join._candidates(3, 4)(r, s, np.arange(len(n)))
    assert (r["key"][row] == r["key"][x]).all()
    points = [jaccard_join._read(jaccard_join.point(v), len(v)) for v in sets]
    two = lambda i, j: r["side"][i] != r["side"][j] or r["side"][i] == 2
    want = {(i, j) for i in range(len(n)) for j in range(i + 1, len(n)) if r["key"][i] == r["key"][j] and r["comp"][i] != r["comp"][j]
            and two(i, j) and (not r["cross"][i] or r["fam"][i] != r["fam"][j]) and jaccard_join.may_link(n[i], points[i], n[j], points[j], 3, 4)}
    assert set(zip(x.tolist(), y.tolist())) == want and len(want) > 50


def test_ids_that_are_no_integers_are_an_error(spark):
    with pytest.raises(TypeError, match="integers"):
        jaccard_join.digest(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_rtree_finds_what_reaches_the_bound():
    import numpy as np

    rng = np.random.default_rng(4)
    n = rng.integers(1, 400, 300)
    points = [np.bincount(rng.integers(0, jaccard_join.dimensions(k), k), minlength=jaccard_join.dimensions(k)) for k in n]
    tree = jaccard_join.RTree(n, points)
    for q in range(0, 300, 7):
        want = [i for i in range(300) if jaccard_join.may_link(int(n[q]), points[q], int(n[i]), points[i], 3, 4)]
        assert sorted(tree.search(int(n[q]), points[q], 3, 4)) == want and q in want


def test_pii(spark, none):
    rows = ["a@b.co x.y+z@a-b.c-d", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111-1111 1111 5 41111111111111112",
            "+1 (503) 555-4887 +4 +12345678", None, "", "é😀 a@b.c_d@e.f", "password=9e5d262097869d7f87 tel: (503) 555-4887",
            "a" * 5000, "1" * 5000, "1 " * 5000, "1.1." * 500]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(docs, extra=("text",)).withColumn("masked", pii.masked(F.coalesce("text", F.lit("")), F.col("spans"))).collect()}
    spans = lambda i: [(s["kind"], s["from"], s["to"]) for s in got[i]["base"]]
    assert spans(0) == [("email", 0, 6), ("email", 7, 20)] and spans(1) == [("ip", 0, 7), ("ip", 8, 15), ("ip", 16, 23), ("ip", 34, 44)]
    assert spans(2) == []  # one run of more than 19 digits
    assert spans(3)[0] == ("phone", 0, 17) and spans(6) == [("email", 3, 8), ("email", 8, 14)] and not spans(4) and not spans(8)
    assert got[0]["masked"] == "<email> <email>" and got[11]["masked"].startswith("<ip>.")
    assert pii.digest(none.withColumnRenamed("_id", "base")).count() == 0


def test_pii_masks_long_secrets(spark):
    rng = random.Random(6)
    some = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    long = [some(257), some(4000), "abcdef" * 20 + some(8), "abcdef" * 50 + "7"]
    rows = [f"token = {t} end" for t in [*("a1" + some(38) for _ in range(30)), *long]] + ["plain " + "x" * 20 + "1 here"] * 5 + ["x" * 5000]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = pii.find(docs, extra=("text",)).select("doc_id", pii.masked(F.col("text"), F.col("spans")).alias("masked")).orderBy("doc_id").collect()
    assert [r["masked"] for r in got[:34]] == ["token = <secret> end"] * 34 and got[-1]["masked"] == "x" * 5000


def test_reliabilities_rank_labelers():
    counts = {(1, 1, 1): 60, (0, 0, 0): 200, (1, 1, 0): 20, (0, 0, 1): 70, (1, 0, 0): 6, (0, 1, 0): 8}
    share, rate = pii.reliabilities(counts)
    assert 0.1 < share < 0.4 and rate[0][0] > 0.8 and rate[0][1] < 0.1 and rate[2][1] > rate[0][1]


def test_pipeline(spark, docs):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    rows = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for part in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, part, sf)
            assert out.columns == columns or name == corpus_pipeline.STAGES[-1][0]
            assert out.count() <= part.count()
    out = corpus_pipeline.run(spark, sf)
    assert out.filter("not round_trip").isEmpty() and out.count() > 100
