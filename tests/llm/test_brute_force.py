"""Base rules, base spans and the pipeline against plain Python over whole tables."""
from __future__ import annotations

import hashlib
import random
import re

import pytest

from turnstile.llm import pii, quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(12)
    parts = ["a@b.co", "x.y%z+1@q-r.st.uv", "@", "a@b", "1.2.3.4", "1.2.3.4.5", "300.1.2.3", "00012.0.0.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "4111111111111111", "+1 (503) 555-4887", "+44.20.7946.0958", "+12", "+", " ", "\n", "é", "😀", "é1.1.1.1", "5", "-", " 5 5", "0000000000000", "_", "%"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    lines = ["a b c", "a b c ", "", " ", "x", "# * $", "%&|<>", "y z", "é é é", "\x1c \x85 "]
    made += ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    return rows + [(10**6 + i, t) for i, t in enumerate([*made, None, ""])]


def test_base_rules(spark, texts):
    want = {}
    for i, t in texts:
        t = t or ""
        words = WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        where = {}
        for k in range(len(words) - 2):
            where.setdefault(tuple(words[k:k + 3]), []).append(k)
        repeated = {k + d for at in where.values() if len(at) > 1 for k in at for d in range(3)}
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        want[i] = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(repeated), failed)
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = quality_rules.digest(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in got} == want and len(got) == len(texts)
    assert not any(r["kept"] for r in got if r["base_failed"])


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for turn, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), turn, kind, m.end()))
    return sorted(out)


def test_base_spans(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digest(docs).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        spans = plain_spans(t or "")
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (i, t)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[2] == k for s in spans) for k in PLAIN]
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))


def test_pipeline_stage_by_stage(spark):
    import sentencepiece

    import corpus_pipeline
    from turnstile.llm import quality_classifier
    from turnstile.llm.queries import model_path

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}
    before = rows(docs)
    # 1: what the classifier scores 0.5 or more, rows unchanged
    model = quality_classifier.fit(docs, labels, train_on=~quality_classifier.held_out(labels["doc_id"]))
    good = {r["doc_id"] for r in quality_classifier.score(docs, model).collect() if r["score"] >= 0.5}
    now = stage[names[0]](spark, docs, SF)
    kept = rows(now)
    assert kept == {i: before[i] for i in good}
    # 2: the smallest id of each component of similar sets
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, r in kept.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", r["text"].encode().translate(low))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
    top = {i: i for i in sets}
    find = lambda i: i if top[i] == i else find(top[i])
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    now = stage[names[1]](spark, spark.createDataFrame(list(kept.values()), docs.schema), SF)
    one = rows(now)
    assert one == {i: kept[i] for i in kept if find(i) == i} and len(one) < len(kept)
    # 3: documents with less than a twentieth of benchmark words
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().translate(low))
    phrases = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r["text"] or "")
        phrases |= {tuple(w[k:k + 13]) for k in range(max(len(w) - 12, 1))} if w else set()
    sizes, clean = {len(p) for p in phrases}, {}
    for i, r in one.items():
        w, hit = words(r["text"]), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in phrases:
                    hit |= set(range(k, k + n))
        if not (hit and 20 * len(hit) >= len(w)):
            clean[i] = r
    now = stage[names[2]](spark, spark.createDataFrame(list(one.values()), docs.schema), SF)
    assert rows(now) == clean
    # 4: spans masked by their kinds; base spans are all among them
    now = stage[names[3]](spark, spark.createDataFrame(list(clean.values()), docs.schema), SF)
    masked = rows(now)
    listed = {r["doc_id"]: r["spans"] for r in pii.digest(spark.createDataFrame(list(clean.values()), docs.schema)).collect()}
    for i, r in clean.items():
        text, at, out = r["text"], 0, []
        for s in filter(None, listed[i].split(",")):
            kind, a, b = s.split(":")
            if int(a) >= at:
                out.append(text[at:int(a)] + f"<{kind}>")
            at = max(at, int(b))
        want = "".join(out) + text[at:]
        assert masked[i]["text"] == want and masked[i]["n_chars"] == (len(want) if listed[i] else r["n_chars"])
        assert (masked[i]["lang"], masked[i]["source"]) == (r["lang"], r["source"])
    assert set(masked) == set(clean)
    # 5: the library's ids
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for r in stage[names[4]](spark, spark.createDataFrame(list(masked.values()), docs.schema), SF).collect():
        assert list(r["ids"]) == lib.encode(masked[r["doc_id"]]["text"], add_bos=True, add_eos=True) and r["n_tokens"] == len(r["ids"])
