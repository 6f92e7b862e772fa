"""Quality classifier: supervised subword embeddings trained by stochastic gradient descent.

A text is a bag of hashed features: its words, its word pairs (an immediate
repeat of any word is one feature) and the byte n-grams inside each word and
its bounding spaces.  A document is the mean of its features' embeddings; a
softmax over two outputs gives the score.  Embeddings and output weights are
learned together with plain minibatch SGD in numpy.

The classifier learns from at most ``sample`` labelled documents (those with
the least hash of the id among the rows that ``train_on`` admits), whole texts
each, one text per id and label (the first one by its features); that bound
doesn't grow with the input, however often labels and ids repeat.  Scoring
covers every text.  As the output is linear in the mean, one number per
feature bucket is enough there.

Defined cases: a null or empty text has no features and scores as the output
bias alone; null ids are scored but never learned from; labels that disagree
for one id are all learned from; without labels of both kinds the score is the
share of label 1 among the labels (0.5 without any).  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat

BUCKETS, DIM, GRAMS = 1 << 16, 8, (3, 5)
EPOCHS, BATCH, RATE = 6, 32, 4.0
ROUND = 1 << 18  # text bytes taken at once: a text has some twenty times its size in features and their work arrays
_ECHO = 0  # the bucket of an immediate repeat


def bags(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature buckets, row of each) of a text column."""
    w = flat.Words(col, flat.byte_class(flat.SPACES, lower=True))
    if len(w) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    h = w.hashes()
    parts, rows = [h], [row]
    at = np.flatnonzero(w.inside(2))
    pair = flat.mix(h[at] * np.uint64(3) + h[at + 1])
    pair[h[at] == h[at + 1]] = _ECHO
    parts.append(pair), rows.append(row[at])
    data = np.concatenate([[np.uint8(32)], w.data])  # the space before the first word
    u = data.astype(np.uint64) + np.uint64(1)
    size = w.end - w.start + 2  # a word with both its spaces
    for n in GRAMS:
        grams = flat.mix(flat.windows_hash(u, n) + np.uint64(n))
        count = np.maximum(size - n + 1, 0)
        parts.append(grams[flat.spread(w.start, count)]), rows.append(np.repeat(row, count))
    return (np.concatenate(parts) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(rows)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts as (buckets, shares), both packed."""
    for batch in flat.rounds(batches, limit=ROUND):
        f, row = bags(batch.column("_text"))
        key, count = np.unique(row * BUCKETS + f, return_counts=True)
        cut = np.searchsorted(key // BUCKETS, np.arange(1, batch.num_rows))
        ids = [k.astype(np.int32).tobytes() for k in np.split(key % BUCKETS, cut)]
        shares = [(c / max(c.sum(), 1)).astype(np.float32).tobytes() for c in np.split(count, cut)]
        yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary()),
                                          batch.column("_turn"), batch.column("_lid")], ["good", "ids", "shares", "_turn", "_lid"])


def train(docs: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, seed: int = 11) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias): what the two softmax outputs differ by."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((2, DIM), np.float32)
    bias = np.log([max((~good).mean(), 1e-3), max(good.mean(), 1e-3)]).astype(np.float32)
    steps, step = EPOCHS * -(-len(docs) // BATCH), 0
    for _ in range(EPOCHS):
        turn = rng.permutation(len(docs))
        for lo in range(0, len(docs), BATCH):
            pick = turn[lo:lo + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            ids = np.concatenate([docs[i][0] for i in pick])
            share = np.concatenate([docs[i][1] for i in pick])[:, None]
            row = np.repeat(np.arange(len(pick)), [len(docs[i][0]) for i in pick])
            mean = np.zeros((len(pick), DIM), np.float32)
            some = np.flatnonzero(np.bincount(row, minlength=len(pick)))
            if len(ids):
                mean[some] = np.add.reduceat(emb[ids] * share, np.searchsorted(row, some))
            z = mean @ out.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), good[pick].astype(int)] -= 1
            back = p @ out
            out -= rate * (p.T @ mean) / len(pick)
            bias -= 0.1 * rate * p.mean(0)
            if len(ids):  # a bucket that several documents hold gets the sum of their steps
                order = np.argsort(ids, kind="stable")
                first = np.flatnonzero(np.diff(ids[order], prepend=-1))
                emb[ids[order[first]]] -= rate * np.add.reduceat((back[row] * share)[order], first)
    return emb @ (out[1] - out[0]), float(bias[1] - bias[0])


def _packed(col: pa.Array, kind: type) -> list[np.ndarray]:
    """The arrays that a binary column holds, where they lie."""
    data, off = flat.utf8(col)
    return [data[a:b].view(kind) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = list(batches)  # held once: the documents are views of them
    good = np.array([g for part in parts for g in part.column("good").to_pylist()], bool)
    weights = np.zeros(BUCKETS, np.float32)
    share = np.clip(good.mean(), 1e-6, 1 - 1e-6) if len(good) else 0.5
    bias = float(np.log(share / (1 - share)))
    if good.any() and not good.all():
        docs = [pair for part in parts for pair in zip(_packed(part.column("ids"), np.int32), _packed(part.column("shares"), np.float32))]
        weights, bias = train(docs, good)
    yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()]), pa.array([bias])],
                                     ["weights", "bias"])


def _score(weights: bytes, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(weights, np.float32)
        for batch in batches:
            z = []
            for part in flat.rounds([batch], limit=ROUND):
                f, row = bags(part.column("_text"))
                n = np.bincount(row, minlength=part.num_rows)
                z.append(np.bincount(row, table[f], minlength=part.num_rows) / np.maximum(n, 1) + bias)
            z = np.concatenate(z) if z else np.zeros(0)
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(1 / (1 + np.exp(-z)))],
                                             [*names, "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "quality", train_on: Column | None = None,
        sample: int = 4096) -> tuple[bytes, float]:
    """(bucket weights, bias).  ``train_on`` is a condition on the label table's columns."""
    marked = labels if train_on is None else labels.filter(train_on)
    marked = (marked.select(F.col(label_id).alias("_lid"), (F.col(label_col) == 1).alias("good")).dropna().distinct()
              .withColumn("_turn", F.xxhash64("_lid")))
    # the least hashes: cut by value first, so that not every task sends as many rows as the sample has
    rows = marked.count()
    share = (sample + 8 * math.sqrt(sample) + 8) / max(rows, 1)
    cut = marked.filter(F.col("_turn") < F.lit(int(-2**63 + share * 2**64))) if share < 0.9 else marked
    if share < 0.9 and cut.count() < sample:
        cut = marked
    marked = cut.orderBy("_turn", "_lid", "good").limit(sample)
    keyed = flat.keyed(docs, id_col, text_col).select("_id", "_text")
    # the sample has a fixed bound of some bytes a row, so it is broadcast
    texts = keyed.join(F.broadcast(marked), F.col("_id") == F.col("_lid")).select("_text", "good", "_turn", "_lid")
    kind = marked.schema["_lid"].dataType.simpleString()
    rows = texts.mapInArrow(_sparse, f"good boolean, ids binary, shares binary, _turn long, _lid {kind}")
    rows = rows.groupBy("_turn", "_lid", "good").agg(F.min(F.struct("ids", "shares")).alias("x")).select("_turn", "good", "x.*")
    # at most ``sample`` rows go to the one training task, without a range sample of them on the driver
    model = rows.repartition(1).sortWithinPartitions("_turn", "ids", "good").mapInArrow(_train, "weights binary, bias double").first()
    if model is None:  # no document to learn from
        return bytes(4 * BUCKETS), 0.0
    return bytes(model["weights"]), model["bias"]


def score(docs: DataFrame, model: tuple[bytes, float], *, id_col: str = "doc_id", text_col: str = "text",
          extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, the ``extra`` columns and score."""
    keyed = flat.keyed(docs, id_col, text_col, *(F.col(c).alias(f"_x{i}") for i, c in enumerate(extra))).drop("_k1", "_k2")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields if f.name != "_text")
    out = keyed.mapInArrow(_score(*model), f"{kinds}, score double")
    return out.select(F.col("_id").alias(id_col), *(F.col(f"_x{i}").alias(c) for i, c in enumerate(extra)), "score")


def held_out(id_col: Column) -> Column:
    """Rows that the classifier of the query never learns from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op4: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, train_on=~held_out(F.col("doc_id")))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
