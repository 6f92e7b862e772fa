"""Substring dedup: repeated word windows, counted by sorting in super-k-mer buckets.

Every run of ``window`` words that starts at two or more places, in one text or
several, is removed at all of them (``keep="none"``) or at all but the first
(``keep="first"``, by integer id, then position).  Windows are judged on the
input texts, never on what is left.

Defined cases: a null text has no words; texts shorter than the window keep
everything; rows with null or repeated ids are judged one by one, and rows with
both id and text equal count as copies of each other (with ``keep="first"``
such twins, and rows without an integer id, share one place in the order).  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import flat, superkmer


def equal_groups(h: np.ndarray, x: superkmer.Units, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, group numbers) of the windows at unit positions ``at`` that share
    their hash with another one; groups are exact by content."""
    order = np.argsort(h)
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[order[1:]] == h[order[:-1]]
    some = np.flatnonzero(same[:-1] | same[1:])
    order, same = order[some], same[some]
    start = x.start[at[order]]
    size = x.end[at[order] + k - 1] - start
    pair = np.flatnonzero(same)
    equal = size[pair] == size[pair - 1]
    equal[equal] = flat.ranges_equal(x.data, start[pair[equal]], start[pair[equal] - 1], size[pair[equal]])
    if not equal.all():  # different windows with one hash: order them by their bytes
        where = np.flatnonzero(np.isin(h[order], h[order[pair[~equal]]]))
        body = [x.data[a:a + n].tobytes() for a, n in zip(start[where], size[where])]
        turn = sorted(range(len(where)), key=lambda i: (h[order[where[i]]], body[i]))
        order[where] = order[where[turn]]
        same[where] = [i > 0 and body[turn[i]] == body[turn[i - 1]] for i in range(len(turn))]
    return order, np.cumsum(~same) - 1


def _count(k: int):
    def kernel(p: superkmer.Packed, x: superkmer.Units, kept: np.ndarray):
        dup, later = np.zeros(x.first[-1], bool), np.zeros(x.first[-1], bool)
        count = np.zeros(len(x.first) - 1, np.int64)
        count[kept] = p.count[kept]
        count = np.repeat(count, np.diff(x.first))
        at = np.flatnonzero(flat.inside(x.first, k) & (count > 0))
        dup[at] = count[at] >= 2
        if len(at):
            tied, group = equal_groups(flat.windows_hash(x.u, k)[at], x, at, k)
            where = at[tied]
            total = np.bincount(group, count[where])
            earliest = np.full(len(total), x.first[-1])
            np.minimum.at(earliest, group, where)
            dup[where] |= total[group] >= 2
            later[where] = dup[where] & (where != earliest[group])
        return dup, later

    return kernel


def _apply(spec: superkmer.Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in flat.rounds(batches, "_z"):
            texts = [superkmer.unsqueeze(z) for z in batch.column("_z").to_pylist()]
            x = flat.Words(pa.array(texts, pa.binary()).cast(pa.string()), flat.byte_class(spec.spaces))
            gone = removed(batch.column("hits"), x.first)
            keep_byte = np.repeat(~gone, x.end - x.start + 1)
            off = np.concatenate([[0], np.cumsum(keep_byte)])[np.append(x.start, len(x.data))[x.first]]
            kept = flat.strings(x.data[keep_byte], off, pa.string())
            rows = [[None] * 0 for _ in range(batch.num_rows)]
            lo, hi = flat.runs(gone)
            for a, b, r in zip(lo.tolist(), hi.tolist(), (np.searchsorted(x.first, lo, "right") - 1).tolist()):
                # a run of removed words may go on in the next row
                while b > x.first[r + 1]:
                    rows[r].append((a - int(x.first[r]), int(x.first[r + 1] - x.first[r])))
                    a, r = int(x.first[r + 1]), r + 1
                    while x.first[r + 1] == a:
                        r += 1
                rows[r].append((a - int(x.first[r]), b - int(x.first[r])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(np.diff(x.first)), pa.array(flat.row_sums(gone, x.first)),
                 pa.array([[{"from": a, "to": b} for a, b in r] for r in rows], SPANS_ARROW),
                 _trim(kept)], ["_id", "n_words", "n_removed", "spans", "kept_text"])

    return run


SPANS_ARROW = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
SPANS = "array<struct<from: long, to: long>>"


def _trim(col: pa.Array) -> pa.Array:
    """Without the space after the last word."""
    import pyarrow.compute as pc

    return pc.utf8_rtrim(col, " ")


def removed(hits: pa.Array, first: np.ndarray) -> np.ndarray:
    """Mask of removed units from the hits of each row."""
    n = int(first[-1])
    if isinstance(hits, pa.ChunkedArray):
        hits = hits.combine_chunks()
    values = hits.flatten()  # null lists have none
    counts = np.diff(np.asarray(hits.offsets))
    base = np.repeat(first[:-1], np.where(hits.is_valid().to_numpy(zero_copy_only=False), counts, 0))
    start = base + values.field("start").to_numpy(zero_copy_only=False)
    pairs = values.field("spans")
    each = np.diff(np.asarray(pairs.offsets)) if len(pairs) else np.zeros(0, np.int64)
    edge = pairs.flatten().to_numpy(zero_copy_only=False) + np.repeat(start, each)
    return flat.covered(first, edge[::2], edge[1::2] - edge[::2], n)


def remove_repeated_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                            window: int = 35, gram: int = 3, spaces: bytes = flat.SPACES,
                            keep: str = "none") -> DataFrame:
    """One row per input row: id, n_words, n_removed, spans (word ranges that
    go) and kept_text (the other words, joined by one space)."""
    if keep not in ("none", "first") or not 1 <= gram <= window:
        raise ValueError("keep is none or first; gram is at most the window")
    spec = superkmer.Spec("word", window, gram, spaces)
    found = superkmer.repeated_spans(flat.keyed(docs, id_col, text_col), spec, _count(window), later=keep == "first")
    kind = found.schema["_id"].dataType.simpleString()
    out = found.mapInArrow(_apply(spec),
                           f"_id {kind}, n_words long, n_removed long, spans {SPANS}, kept_text string")
    return out.withColumnRenamed("_id", id_col)


def digest(docs: DataFrame) -> DataFrame:
    """op1: doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeated_windows(docs).select("doc_id", "n_words", "n_removed",
                                                F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH words AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, md5(array_to_string(w[i + 1:i + 35], ' ')) AS g FROM words, range(len(w) - 34) AS x(i) WHERE len(w) >= 35),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS MATERIALIZED (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM again),
kept AS (
  SELECT r, string_agg(w[k + 1], ' ' ORDER BY k) AS text FROM words, range(len(w)) AS x(k)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.r = words.r AND g.k = x.k) GROUP BY r),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
"""
