"""Quality rules: exact text statistics, judged by base rules and an isolation forest.

One pass over the texts makes a small row of statistics per document; all else
works on those rows.  The forest isolates documents by random splits of
statistics; short mean path lengths mean unusual documents.  It grows on
good labelled rows; the score above which a document goes is set on labelled
rows: as many bad ones as possible go, at most ``max_loss`` of the
good ones that pass the base rules.

The forest grows on at most ``sample`` good labelled ids (those with the least
hash), a bound that doesn't grow with the input; the threshold comes from the
scores of all good labelled rows.

Defined cases: a null text has no words and fails the base rule; null or
repeated ids are judged row by row; a labelled id counts each of its document
rows once, and one of them for the forest; without labels of both kinds only the
base rules decide; an empty table gives an empty result.  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat
from turnstile.session import ensure_checkpoint_dir

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_chars", "n_marks")
TREES, SUBSAMPLE, DEPTH = 100, 256, 8


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, off))


def _groups(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first of its kind) of equal (row, hash) pairs; order is stable."""
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (row[order[1:]] != row[order[:-1]]) | (h[order[1:]] != h[order[:-1]])
    return order, new


def repeated_lines(data: np.ndarray, off: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines (split at \\n) with a word that equal an earlier line, and lines with a word.

    ``words`` marks word bytes.
    """
    rows = len(off) - 1
    cut = np.flatnonzero(data == 10)
    lo = np.concatenate([off[:-1], cut + 1])
    hi = np.concatenate([cut, off[1:]])
    lo.sort(), hi.sort()
    row = np.searchsorted(off, lo, "right") - 1
    # a line that starts where a text ends belongs to that text, not to the next one
    row = np.minimum(row, np.searchsorted(off[1:], hi, "left"))
    at = np.flatnonzero(words)
    some = np.searchsorted(at, lo) < np.searchsorted(at, hi)
    lo, hi, row = lo[some], hi[some], row[some]
    order, new = _groups(row, flat.content_hash(data, lo, hi))
    return np.bincount(row[order[~new]], minlength=rows), np.bincount(row, minlength=rows)


def repeated_words(w: flat.Words, h: np.ndarray, n: int = 3) -> np.ndarray:
    """Per row: words inside n-word windows that the row holds twice or more."""
    at = np.flatnonzero(w.inside(n))
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))[at]
    order, new = _groups(row, flat.mix(flat.windows_hash(h, n)[at]))
    twice = ~new
    twice[:-1] |= ~new[1:]
    return flat.row_sums(flat.covered(w.first, at[order[twice]], n, len(w)), w.first)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cls = flat.byte_class(flat.SPACES)
    for batch in flat.rounds(batches):
        text = batch.column("_text")
        w = flat.Words(text, cls)
        h = w.hashes()
        data, off = flat.utf8(text)
        lead = (data & 0xC0) != 0x80
        is_word = cls[0][data]
        dup, lines = repeated_lines(data, off, is_word)
        values = {
            "n_words": np.diff(w.first), "word_chars": _per_row(lead & is_word, off),
            "n_symbols": _per_row(_mask(SYMBOLS)[data], off), "n_dup_lines": dup,
            "n_repeat_words": repeated_words(w, h), "n_lines": lines, "n_chars": _per_row(lead, off),
            "n_marks": _per_row(_mask(b".,;:!?")[data], off)}
        yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array(values[c].astype(np.int64)) for c in COUNTS)],
                                         ["_id", *COUNTS])


def features(x: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest splits: rates in which good texts lie close together whatever their size.

    Repeats and sizes are left to the base rules; good texts vary in them.
    """
    words = np.maximum(x["n_words"], 1).astype(float)
    return np.stack([x["n_symbols"] / words, x["n_marks"] / words, x["word_chars"] / words], 1)


def loosened(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """The points with a little noise, so that a statistic that is the same in all of them can be split."""
    noise = np.random.default_rng(seed).normal(0, 0.02, x.shape)
    return x + noise * (x.std(0) + 0.02)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(split feature or -1, split value, path length at leaves): heap-ordered trees."""
    rng = np.random.default_rng(seed)
    nodes = 2 ** (DEPTH + 1)
    feature, value, path = np.full((TREES, nodes), -1), np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    for t in range(TREES):
        todo = [(1, 0, rng.choice(len(x), min(SUBSAMPLE, len(x)), replace=False))]
        while todo:
            node, depth, rows = todo.pop()
            low, high = x[rows].min(0), x[rows].max(0)
            can = np.flatnonzero(high > low)
            if depth == DEPTH or len(can) == 0:
                path[t, node] = depth + _mean_path(len(rows))
                continue
            f = rng.choice(can)
            at = rng.uniform(low[f], high[f])
            feature[t, node], value[t, node] = f, at
            left = x[rows, f] <= at
            todo += [(2 * node, depth + 1, rows[left]), (2 * node + 1, depth + 1, rows[~left])]
    return feature, value, path


def scores(forest: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Anomaly scores from 0 to 1."""
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, value, path in zip(*forest):
        node = np.ones(len(x), np.int64)
        for _ in range(DEPTH):
            f = feature[node]
            inner = f >= 0
            node = np.where(inner, 2 * node + (x[rows, f] > value[node]), node)
        total += path[node]
    return 2.0 ** (-total / TREES / _mean_path(SUBSAMPLE))


def calibrate(good: DataFrame, max_loss: float) -> float:
    """The least threshold that at most ``max_loss`` of the rows exceed, from counts in ever finer cells.

    Scores are at least 2**-2, so the last cells hold one value each.
    """
    rows, parent = good.count(), None
    above = min(int(max_loss * rows), rows - 1)
    for bits in (15, 30, 45, 60):
        cell = F.floor(F.col("anomaly") * 2.0 ** bits).alias("cell")
        inside = good if parent is None else good.filter(F.floor(F.col("anomaly") * 2.0 ** (bits - 15)) == parent)
        for parent, n in sorted(map(tuple, inside.groupBy(cell).count().collect()), reverse=True):
            if n > above:
                break
            above -= n
    return parent / 2.0 ** 60


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if held:
        rows = pa.Table.from_batches(held).to_pandas().sort_values(list(COUNTS))
        forest = grow(loosened(features({c: rows[c].to_numpy() for c in COUNTS})))
        yield pa.RecordBatch.from_arrays([pa.array([a.astype(np.float64).tobytes() for a in forest])], ["part"])


def _verdicts(parts: list[bytes], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (TREES, 2 ** (DEPTH + 1))
        forest = [np.frombuffer(p).reshape(shape) for p in parts]
        forest = (forest[0].astype(np.int64), *forest[1:]) if forest else None
        for batch in batches:
            x = features({c: batch.column(c).to_numpy() for c in COUNTS})
            score = scores(forest, x) if forest else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(score <= threshold)],
                                             [*batch.schema.names, "anomaly", "usual"])

    return run


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality", sample: int = 8192, max_loss: float = 0.002,
          min_words: int = 50, max_repeated: float = 0.5) -> DataFrame:
    """One row per document: id, all counts, base_failed, anomaly, kept."""
    ensure_checkpoint_dir(docs.sparkSession)
    keyed = flat.keyed(docs, id_col, text_col).select("_id", "_text")
    kind = keyed.schema["_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    stats = keyed.mapInArrow(_statistics, f"_id {kind}, {counts}").checkpoint()
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    marked = (labels.select(F.col(label_id).alias("_lid"), (F.col(label_col) == 1).alias("good"))
              .dropna().groupBy("_lid").agg(F.max("good").alias("good"), F.max(~F.col("good")).alias("bad")))
    labelled = (stats.filter(~failed).join(marked, F.col("_id") == F.col("_lid"))
                .select("_id", "good", "bad", *COUNTS).checkpoint())
    good = labelled.filter("good").select("_id", *COUNTS)
    parts, threshold = [], 1.0
    if all(labelled.agg(F.max("good"), F.max("bad")).first()):
        fit_on = good.groupBy("_id").agg(F.min(F.struct(*COUNTS)).alias("x")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        parts = [bytes(r["part"]) for r in fit_on.select("x.*").mapInArrow(_fit, "part binary").collect()]
        scored = good.mapInArrow(_verdicts(parts, threshold), f"_id {kind}, {counts}, anomaly double, usual boolean")
        threshold = calibrate(scored.select("anomaly").checkpoint(), max_loss)
    out = stats.mapInArrow(_verdicts(parts, threshold), f"_id {kind}, {counts}, anomaly double, usual boolean")
    return out.select(F.col("_id").alias(id_col), *COUNTS, failed.alias("base_failed"), "anomaly",
                      (~failed & F.col("usual")).alias("kept"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op6: doc_id, n_words, the base counts, base_failed, kept, and anomaly."""
    return judge(docs, labels).select("doc_id", *COUNTS[:5], "base_failed", "kept", "anomaly")
