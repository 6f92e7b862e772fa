"""MinHash near-dedup: bottom-k sketches from one hash function.

A document's set holds its distinct word shingles (64-bit hashes); two
documents link if their sets' Jaccard similarity is at least ``num / den``.
Components of links are the result, and the document of the smallest id of each
is kept.

1.  Sketches.  The ``size`` least hashes of a set.  Documents of equal sets (by
    128-bit digest) are tied to the one of the smallest id; the others are left out from here on.
2.  Inverted lists.  Values of two sketches that are least in the union are
    shared with the probability of the similarity each, so links share some
    ``width`` retained values without another one between them (for small sets, by
    counting; else but for one in 10**9).  A list holds the documents of one such
    run of retained values, which unrelated documents rarely share.
3.  Leaders.  Every document is compared with the least document of most of its lists;
    those with one such leader are a family.  Documents whose lists still
    hold several components are compared with up to eight others of their family.  That joins
    large groups of near copies in few comparisons each.
4.  The rest.  Families, and lists that reach over several families, are gone
    through whole if they still hold several components: tasks estimate the pairs of different
    components and verify those that may link, best first, until they are of one.
5.  Pairs are estimated by their union's sketch (six deviations below the
    bound are let through) and verified on whole sets.

Memory: tasks stream over lists sorted by Spark, long families and lists are compared
in blocks (all pairs of two parts of about BLOCK documents or BLOCK_SHINGLES shingles), and other
pairs are verified a few MB at a time.

Defined cases: null text or no words: empty set, linked with nothing; fewer
words than a shingle: the whole sequence is the one shingle; of rows with one id
the one whose set has the least digest stands for the document; rows without id link with nothing, get no component and are kept;
an empty table gives an empty result.  Ids are integers.  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm import families, flat
from turnstile.llm.families import Sets, components, materialize, oracle

_END = np.uint64(0xFFFFFFFFFFFFFFFF)


class Spec(NamedTuple):
    """Shingle words, retained hashes, similarity bound, and retained values that lists are made from."""

    shingle: int = 2
    size: int = 128
    num: int = 4
    den: int = 5
    reach: int = 64

    def least_run(self, union: int) -> int:
        """Shared values that stand together in any union of this size that reaches the similarity."""
        other = union - -(-self.num * union // self.den)
        return -(-(union - other) // (other + 1))

    def width(self, miss: float = 1e-9) -> int:
        """Values of a list's key: the most with which ``reach`` values hold a shared run but for ``miss``."""
        p = self.num / self.den
        for width in range(8, 1, -1):
            state = np.zeros(width + 1)  # length of the run so far
            state[0] = 1
            for _ in range(self.reach):
                state = np.concatenate([[state[:-1].sum() * (1 - p)], state[:-2] * p, [state[-1] + state[-2] * p]])
            if 1 - state[-1] < miss:
                return width
        return 1

    def widths(self, n: int) -> list[int]:
        """Key widths of a set of n values; both sets of a link have one in common that they share."""
        width = self.width()
        if n > self.reach:
            return [width]
        return sorted({min(width, self.least_run(u)) for u in range(n, n * self.den // self.num + 1)})


def _sketches(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in flat.rounds(batches):
            s = Sets(batch.column("_text"), spec.shingle)
            kept = np.minimum(s.n, spec.size)
            values = s.h[flat.spread(s.first[:-1], kept)]
            off = np.concatenate([[0], np.cumsum(kept)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(s.n.astype(np.int64)), families.seals(s), flat.strings(_packed(values), KEPT * off, pa.binary())],
                ["doc", "n", "seal", "sketch"])

    return run


#: bytes of a retained value that a sketch stores: the highest ones, so that values keep their order; that two different
#: ones of two sketches meet (once in 10**8) makes a pair's estimate higher, never lower
KEPT = 5


def _packed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEPT:]).ravel()


def _values(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(retained values, offsets) of a sketch column."""
    data, off = flat.utf8(col)
    wide = np.zeros((len(data) // KEPT, 8), np.uint8)
    wide[:, 8 - KEPT:] = data.reshape(-1, KEPT)
    return wide.view("<u8").ravel().astype(np.uint64), off // KEPT


def key_widths(spec: Spec) -> list[list[int]]:
    """Key widths by set size; the last one stands for all greater sizes."""
    return [[], *(spec.widths(k) for k in range(1, spec.reach + 2))]


def list_keys(values: np.ndarray, first: np.ndarray, n: np.ndarray, spec: Spec, wanted: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of the runs of retained values whose lists hold a document; wanted: :func:`key_widths`."""
    kept = np.minimum(np.diff(first), spec.reach)
    values = values[flat.spread(first[:-1], kept)]
    first = np.concatenate([[0], np.cumsum(kept)])
    row = np.repeat(np.arange(len(kept)), kept)
    keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for width in sorted({w for ws in wanted for w in ws}):
        has = np.array([width in ws for ws in wanted])[np.minimum(n, spec.reach + 1)]
        at = np.flatnonzero(flat.inside(first, width) & has[row])
        keys.append(flat.mix(flat.windows_hash(flat.mix(values), width)[at] + np.uint64(width)))
        rows.append(row[at])
    return np.concatenate(keys), np.concatenate(rows)


def _deal(spec: Spec):
    wanted = key_widths(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, n = (batch.column(c).to_numpy() for c in ("doc", "n"))
            key, row = list_keys(*_values(batch.column("sketch")), n, spec, wanted)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc[row]), pa.array(n[row])], ["key", "doc", "n"])

    return run


def may_link(values: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
    """(whether pairs of rows may reach the similarity, estimate) from the sketch
    of their union; values: a sketch a row, filled up with the greatest value."""
    t = spec.num / spec.den
    ok, estimate = np.zeros(len(i), bool), np.zeros(len(i))
    step = max(families.STEP_BYTES // (16 * values.shape[1]), 1)
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        both = np.concatenate([values[a], values[b]], 1)
        both.sort(axis=1)
        twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _END)
        place = np.arange(1, both.shape[1]) - np.cumsum(twice, 1) + 1  # of each value among the distinct ones
        shared = (twice & (place <= spec.size)).sum(1)
        kept = np.minimum(n[a], spec.size) + np.minimum(n[b], spec.size) - twice.sum(1)
        size = np.maximum(np.minimum(kept, spec.size), 1)
        union = np.maximum((n[a] + n[b]) / (1 + t), 2)  # of sets that just reach it
        spread = np.sqrt(t * (1 - t) / size * np.maximum(union - size, 0) / (union - 1))
        estimate[at:at + step] = shared / size
        ok[at:at + step] = shared >= (t - 6 * spread) * size - 1e-6
    return ok, estimate


def _padded(col: pa.Array, size: int) -> np.ndarray:
    values, first = _values(col)
    out = np.full((len(col), size), _END)
    count = np.diff(first)
    out[np.repeat(np.arange(len(col)), count), np.arange(len(values)) - np.repeat(first[:-1], count)] = values
    return out


def _estimated(spec: Spec):
    """Pairs that may link by their union's sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                k = part.num_rows
                values = np.concatenate([_padded(part.column(c), spec.size) for c in ("s1", "s2")])
                n = np.concatenate([part.column(c).to_numpy() for c in ("n1", "n2")])
                ok, _ = may_link(values, n, np.arange(k), np.arange(k, 2 * k), spec)
                yield part.filter(pa.array(ok)).select(["a", "b"])

    return run


def _near(sketches: DataFrame, spec: Spec):
    """Sorts out pairs by their union's sketch."""
    def near(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
        some = families.among(sketches, "doc", ids).select("doc", "n", "sketch")
        left, right = (some.select(F.col("doc").alias(c), F.col("n").alias(f"n{i}"), F.col("sketch").alias(f"s{i}")) for i, c in ((1, "a"), (2, "b")))
        return materialize(pairs.join(left, "a").join(right, "b").mapInArrow(_estimated(spec), "a long, b long").distinct())

    return near


def _candidates(spec: Spec) -> families.Find:
    """All pairs of a block that may link by their union's sketch."""
    def find(r: dict[str, np.ndarray], s: Sets, number: np.ndarray) -> tuple[np.ndarray, ...]:
        kept = np.minimum(s.n, spec.size)
        values = np.full((len(s.n), spec.size), _END)
        values[np.repeat(np.arange(len(s.n)), kept), flat.spread(np.zeros(len(s.n), np.int64), kept)] = s.h[flat.spread(s.first[:-1], kept)]
        rows, heads = np.arange(len(r["key"])), families.block_heads(r)
        after = np.repeat(heads[1:], np.diff(heads)) - rows - 1
        found = []
        for a, b in families.cut(np.cumsum(after), 1 << 20):
            left, right = np.repeat(rows[a:b], after[a:b]), flat.spread(rows[a:b] + 1, after[a:b])
            ok = families.may_meet(r, left, right, spec.num, spec.den)
            row, left, right = left[ok], number[left[ok]], number[right[ok]]
            both, first = np.unique(np.minimum(left, right) * len(s.n) + np.maximum(left, right), return_index=True)
            row, left, right = row[first], both // len(s.n), both % len(s.n)
            ok, estimate = may_link(values, s.n, left, right, spec)
            found.append((left[ok], right[ok], estimate[ok], row[ok]))
        return tuple(np.concatenate(x) for x in zip(*found))

    return find


def prepare(docs: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """(base, links): a row per document, and links (a, b) whose components are those of all links.  docs: _id (long), _text."""
    base = materialize(docs.mapInArrow(_sketches(spec), "doc long, n long, seal binary, sketch binary"))
    named, rows = families.one_row_each(docs, base, spec.shingle)
    rows = rows.filter("n > 0")
    equal = families.equal_sets(rows)
    single = families.among(rows, "doc", equal.select(F.col("b").alias("doc")).distinct(), how="left_anti")
    lists = families.shared_lists(single.select("doc", "n", "sketch").mapInArrow(_deal(spec), "key long, doc long, n long"))
    texts = families.Texts(named, spec.shingle, spec.num, spec.den)
    return base, families.links_of(lists, texts, _near(rows, spec), _candidates(spec)).union(equal)


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", spec: Spec = Spec()) -> DataFrame:
    """(doc, n, comp): per row its id, set size and component."""
    base, links = prepare(families.keyed(docs, id_col, text_col), spec)
    found = components(links)
    return base.select("doc", "n").join(found.withColumnRenamed("doc", "_doc"), F.col("doc") == F.col("_doc"), "left").select(
        "doc", "n", F.coalesce("comp", "doc").alias("comp"))


def digest(docs: DataFrame) -> DataFrame:
    """op13: doc_id, n_shingles, component_id, kept."""
    return groups(docs).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
                               F.col("doc").eqNullSafe(F.col("comp")).alias("kept"))


ORACLE = oracle(2, 4, 5, "n AS n_shingles, comp AS component_id, doc_id = comp AS kept")
