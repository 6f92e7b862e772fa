"""Cases that once gave wrong rows or ended a job."""
from __future__ import annotations

import hashlib
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from turnstile.llm import jaccard_join, quality_rules, substring_dedup, suffix_dedup, warc

ROOT = Path(__file__).resolve().parents[2]


def same_hash_texts(spark):
    """Two texts of 41 words with one 32-bit hash."""
    rows = spark.range(200_000).select(F.concat(F.lit("w "), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: F.hash("id", i)), " ")).alias("t"))
    pair = rows.groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).filter("size(ts) > 1").first()
    return pair["ts"][:2]


def test_rows_without_id_are_told_apart(spark):
    a, b = same_hash_texts(spark)
    rows = [(None, a), (None, b), (7, " ".join(a.split()[:40]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["kept_text"]: r["n_removed"] for r in substring_dedup.remove_repeated_windows(docs).collect()}
    assert got == {a.split()[40]: 40, b: 0, "": 40}
    gone = {bytes(r["kept_bytes"]): r["n_removed"] for r in suffix_dedup.remove_repeated_bytes(docs, keep="none").collect()}
    assert gone[b.encode()] == 0 and len(gone) == 3
    one_id = spark.createDataFrame([(1, a), (1, b), (7, rows[2][1])], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substring_dedup.remove_repeated_windows(one_id).collect()) == [0, 40, 40]


def thue_morse():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    return a, b


def test_unequal_words_and_lines_of_one_polynomial_hash(spark):
    a, b = thue_morse()
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}\n{a}")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.digest(docs).collect()} == {1: 1, 2: 2, 3: 3}
    got = {r["doc_id"]: r["n_dup_lines"] for r in quality_rules.judge(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert got == {1: 0, 2: 0, 3: 1}


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_broken_headers_inside_payloads(spark, scratch, compression):
    import duckdb

    fakes = [warc.MAGIC + "WARC-Type: revisit\r\nWARC-Payload-Length: abc\r\nContent-Length: 0\r\n\r\n" + "x" * 200,
             warc.MAGIC + "WARC-Type: revisit\r\nWARC-Payload-Length: " + "9" * 40 + "\r\nContent-Length: 0\r\n\r\n",
             warc.MAGIC + "WARC-Type: revisit\r\nContent-Length: 0\r\nWARC-Payload-Digest: sha256:�\r\n\r\n" + warc.END,
             warc.MAGIC + "WARC-Type: response\r\nContent-Length: 99999999999999999999\r\n\r\n"]
    rows = [(i, "u", fakes[i % 4] + "q" * (i * 37)) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    warc.write(pages, f"{scratch}/w", compression=compression)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # uncompressed files are read in splits
    try:
        got = sorted((int(r["rid"]), r["length"], r["digest"], r["kind"], r["refers"] and int(r["refers"])) for r in warc.read(spark, f"{scratch}/w").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(con.sql(warc.ORACLE).fetchall())


def test_foreign_archive_with_invalid_bytes(spark, scratch):
    os.makedirs(f"{scratch}/f")
    record = b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:page:\xff1>\r\nWARC-Payload-Digest: sha256:\xfe\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    Path(f"{scratch}/f/a.warc").write_bytes(record * 3)
    assert warc.read(spark, f"{scratch}/f").count() == 3


CLASHES = ("score", "doc", "spans", "contaminated", "n_words", "_id", "_text", "_row", "comp", "items", "base")


def test_stages_carry_clashing_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs = docs.union(spark.createDataFrame([(None, None, "en", "s", None), (10**6, "", None, None, 0)], docs.schema))
    more = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, sf), stage(spark, more, sf)
        assert out.columns == more.columns, name
        assert sorted(map(str, out.select(docs.columns).collect())) == sorted(map(str, plain.collect())), name
        assert out.select(*CLASHES).distinct().collect() == more.select(*CLASHES).distinct().collect(), name
    assert corpus_pipeline.STAGES[-1][1](spark, more, sf).count() == more.count()


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
from turnstile.llm.queries import QUERIES
for name in {names!r}:
    print("DONE", name, len(QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_workers_need_not_have_the_package(tmp_path):
    names = ["op1_substring_dedup", "op3_suffix_dedup", "op5_warc", "op6_quality_rules", "op7_decontaminate", "op8_sentencepiece",
             "op9_jaccard_join", "op11_run_detection", "op12_vector_codes", "op13_minhash_dedup"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = SCRIPT.format(root=str(ROOT), shared=str(tmp_path), names=names)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert [line.split()[1] for line in out.stdout.splitlines() if line.startswith("DONE")] == names, out.stderr[-3000:]


def test_rows_of_one_id_with_different_texts(spark):
    from turnstile.llm import minhash_dedup

    rng = random.Random(2)
    base = [f"w{rng.randint(0, 900)}" for _ in range(120)]
    rows = [(i, " ".join(base[:60 + 3 * (i % 20)])) for i in range(60)] + [(3, "a b c d e f g"), (3, " ".join(base)), (7, None), (None, "a b c d e f g"), (900, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for op in (jaccard_join, minhash_dedup):
        got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in op.digest(docs).collect()]
        assert len(got) == len(rows) and len({r[0::2] for r in got}) == 62  # one component an id
    left = [r["doc_id"] for r in jaccard_join.one_of_each(docs).collect()]
    assert left.count(None) == 1 and 0 in left


def test_decontamination_equals_plain_python(spark):
    import re

    from turnstile.llm import decontaminate

    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)] + ["Ü9", "x-y", "A"]
    say = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(40)] + [(None, "q r"), (41, None), (42, "--"), (3, "zz Z9")]
    texts = []
    for i in range(120):
        part = rng.choice([t for _, t in items if t])
        texts.append((i, f"{say(rng.randint(0, 60))} {part} {say(rng.randint(0, 30))}" if i % 2 else say(rng.randint(0, 80))))
    texts += [(200, None), (201, ""), (None, "q r"), (None, "q r"), (5, texts[5][1]), (5, "zz z9 other")]
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(low))
    want = []
    for i, t in texts:
        w, hit, names = split(t), set(), set()
        for name, item in items:
            v = split(item)
            for k in range(max(len(v) - 12, 1) if v else 0):
                phrase = v[k:k + 13]
                for at in range(len(w) - len(phrase) + 1):
                    if w[at:at + len(phrase)] == phrase:
                        hit |= set(range(at, at + len(phrase)))
                        names.add("" if name is None else str(name))
        want.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n_words", "spans", "_k1")})
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(str, map(tuple, decontaminate.digest(docs, tests).collect()))) == sorted(map(str, want))
    rows = lambda size: sorted(map(str, decontaminate.find(docs, tests, block_bytes=size).collect()))
    assert rows(100) == rows(8 << 20)


def test_classifier_sample_is_the_least_hashes(spark):
    from turnstile.llm import quality_classifier

    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["house", "tree", "of"] if i % 2 else ["###", "|||", "of"]) for _ in range(20))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1500)], "doc_id long, quality int")
    taken = [r[0] for r in labels.orderBy(F.xxhash64("doc_id")).limit(30).collect()]
    assert quality_classifier.fit(docs, labels, sample=30) == quality_classifier.fit(docs, labels.filter(F.col("doc_id").isin(taken)), sample=30)
