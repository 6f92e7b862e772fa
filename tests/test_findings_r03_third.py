"""Third pass of round 3's findings: no receipt totals without payments, less memory in the classifier's tasks."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as E
from tests.test_findings_r03 import SF, frames_of
from turnstile.llm import quality_classifier as Q


@pytest.mark.parametrize("name", ["working_set", "dump_working_set", "ticket_rollup", "dump_tickets"])
def test_frames_without_payments_carry_no_totals(spark, name):
    frames = frames_of(spark, lambda: E.queries()[name](spark, SF).collect())
    assert len(frames) == 1 and "_txn_min_rcb" in frames[0] and "_txn_amount" not in frames[0]


def peak(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_batch_of_texts_is_scored_in_small_rounds():
    texts = [" ".join(f"word{i * j % 977}" for j in range(4000)) for i in range(60)]  # some 30 KB each
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], ["_id", "_text"])
    weights = np.linspace(-1, 1, Q.BUCKETS).astype(np.float32).tobytes()
    score = Q._score(weights, 0.25)
    (whole,), most = peak(lambda: list(score(iter([batch]))))
    assert most < 60e6
    alone = [next(score(iter([batch.slice(i, 1)]))).column("score")[0].as_py() for i in range(60)]
    assert whole.column("score").to_pylist() == alone


def test_training_keeps_no_second_copy_of_its_documents(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [np.sort(rng.choice(Q.BUCKETS, 8000, replace=False)).astype(np.int32) for _ in range(200)]
    shares = [np.full(8000, 1 / 8000, np.float32)] * 200
    batches = [pa.RecordBatch.from_arrays([pa.array([k % 2 == 0 for k in range(at, at + 50)]), pa.array([x.tobytes() for x in ids[at:at + 50]], pa.binary()),
                                           pa.array([x.tobytes() for x in shares[at:at + 50]], pa.binary())], ["good", "ids", "shares"]) for at in range(0, 200, 50)]
    seen = []
    monkeypatch.setattr(Q, "train", lambda docs, good: (seen.append((docs, good)), (np.zeros(Q.BUCKETS, np.float32), 0.0))[1])
    _, most = peak(lambda: list(Q._train(iter(batches))))
    assert most < 4e6  # the documents take 12.8 MB
    docs, good = seen[0]
    assert good.tolist() == [k % 2 == 0 for k in range(200)]
    assert all((a == x).all() and (b == y).all() for (a, b), x, y in zip(docs, ids, shares))


def test_training_without_documents_gives_an_even_score():
    model, = Q._train(iter([]))
    assert model.column("bias")[0].as_py() == 0.0 and not any(model.column("weights")[0].as_py())
