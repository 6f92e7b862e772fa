"""Super-k-mer exchange: equal windows of all texts meet in one bucket.

A unit is a word or a byte.  Every window of k units has a minimiser, the
least hashed m-gram inside it; consecutive windows that share it form a
segment, packed as one string and sent to the minimiser's bucket.  Equal
windows have equal minimisers, so a bucket can judge its windows alone.

m-grams that are frequent in the corpus rank behind all others, so windows
that only touch a common passage are dealt out by what surrounds it.  Windows
wholly inside one are equal text, of which each task sends one copy with a
count.  Frequency is counted over all texts in ``CELLS`` hash cells; a wrong
cell would only move windows to another bucket, never change a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm import flat

CELLS = 1 << 20
#: an m-gram cell with more than this share of all units is frequent
SHARE = 1 / (1 << 16)
#: packed bytes that a task holds before it sends them
FLUSH_BYTES = 24 << 20
#: packed bytes that one bucket is planned for
BUCKET_BYTES = 8 << 20
#: text bytes that a bucket is for at least
LEAST_BYTES = 1 << 18
_BYTES = flat.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
BLOB = "bucket int, body binary"
FLAGS = "h1 long, h2 int, spans array<int>"
LATER = ", later array<int>, od long, os int"
IDS = "h1 long, h2 int, _k1 long, _k2 long, start int"


@dataclass(frozen=True)
class Spec:
    unit: str  # "word" or "byte"
    k: int
    m: int
    spaces: bytes = flat.SPACES


class Units:
    """The units of a text column."""

    def __init__(self, col: pa.Array, spec: Spec):
        if spec.unit == "word":
            w = flat.Words(col, flat.byte_class(spec.spaces))
            self.data, self.start, self.end, self.first = w.data, w.start, w.end, w.first
            self.u = w.hashes()
        else:
            self.data, self.first = flat.utf8(col)
        self.spec = spec

    @classmethod
    def packed(cls, data: np.ndarray, off: np.ndarray, spec: Spec) -> Units:
        """Units of packed segments; words have their spaces with them."""
        out = cls.__new__(cls)
        out.spec, out.data, out.first = spec, data, off
        if spec.unit == "word":
            w = flat.Words.__new__(flat.Words)
            w.data, w.end = data, np.flatnonzero(data == 32)
            w.start = np.zeros_like(w.end)
            w.start[1:] = w.end[:-1] + 1
            out.start, out.end, out.first = w.start, w.end, np.searchsorted(w.end, off)
            out.u = w.hashes()
        return out

    def hashes(self) -> np.ndarray:
        return self.u if self.spec.unit == "word" else byte_hashes(self.data)

    def bytes_of(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of the unit ranges [lo, hi), with the space after each word."""
        return (self.start[lo], self.end[hi - 1] + 1) if self.spec.unit == "word" else (lo, hi)


def byte_hashes(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def gram_hashes(u: np.ndarray, m: int) -> np.ndarray:
    """30-bit hashes of all m-grams."""
    x = flat.windows_hash(u, m)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(34)).astype(np.uint32)


def least(order: np.ndarray, w: int, ties: bool) -> np.ndarray:
    """Twice the least value of each w consecutive ones, plus 1 if it occurs twice in there (with ``ties``)."""
    if not ties:
        return flat.sliding_min(order << np.uint32(1), w)

    def join(a, b):
        return np.minimum(a, b) | ((a ^ b) <= 1).astype(np.uint32)

    level, size, out, done = order << np.uint32(1), 1, None, 0
    if len(order) < w:
        return level[:0]
    n = len(order) - w + 1
    while True:  # disjoint blocks of 1, 2, 4, ... values that add up to w
        if w & size:
            part = level[done:done + n]
            out, done = part.copy() if out is None else join(out, part), done + size
        if 2 * size > w:
            return out
        level = join(level[:-size], level[size:])
        size *= 2


class Segments:
    """The segments of a text column, in text order."""

    def __init__(self, units: Units, hot: np.ndarray, ties: bool = True):
        k, m = units.spec.k, units.spec.m
        self.units = units
        grams = gram_hashes(units.hashes(), m)
        order = grams | (hot[grams >> np.uint32(10)].astype(np.uint32) << np.uint32(30))
        key = least(order, k - m + 1, ties)
        valid = flat.inside(units.first, k)[:len(key)]
        tie = (key & np.uint32(1)).astype(bool)
        key >>= np.uint32(1)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (key[1:] != key[:-1])
        self.at = np.flatnonzero(new)
        bounds = np.append(self.at, len(key))
        n_valid = np.concatenate([[0], np.cumsum(valid)])
        self.windows = n_valid[bounds[1:]] - n_valid[bounds[:-1]]
        n_ties = np.concatenate([[0], np.cumsum(tie & valid)])
        self.repeats = (n_ties[bounds[1:]] > n_ties[bounds[:-1]]) | (self.windows > k - m + 1)
        self.key = key[self.at]
        self.to = self.at + self.windows + k - 1
        self.row = np.searchsorted(units.first, self.at, "right") - 1
        self.start, self.end = units.bytes_of(self.at, self.to)
        self.h1, self.h2 = flat.digests(units.data, self.start, self.end)


def _cells(spec: Spec) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, units, size = np.zeros(CELLS, np.int64), 0, 0
        for batch in flat.rounds(batches):
            x = Units(batch.column("_text"), spec)
            n = int(x.first[-1])
            units, size = units + n, size + len(x.data)
            grams = gram_hashes(x.hashes(), spec.m)
            if len(grams):
                count += np.bincount(grams >> np.uint32(10), minlength=CELLS)
        # a cell over twice a task's share in none of the tasks isn't frequent overall
        some = np.flatnonzero(count >= max(4, units * SHARE / 4))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2]).astype(np.int32)),
             pa.array(np.append(count[some], [units, size]))], ["cell", "n"])

    return run


def frequent(docs: DataFrame, spec: Spec) -> tuple[np.ndarray, int]:
    """(mask of frequent cells, bytes of all units).  At most 1 / SHARE cells reach the driver."""
    from turnstile.session import ensure_checkpoint_dir  # not above: this module goes to tasks, the package may not

    ensure_checkpoint_dir(docs.sparkSession)
    seen = docs.select("_text").mapInArrow(_cells(spec), "cell int, n long").groupBy("cell").agg(
        F.sum("n").alias("n"))
    # the totals decide what is frequent; they come first, and the sums are kept by checkpoint
    seen = seen.checkpoint()
    total = {r["cell"]: r["n"] for r in seen.filter("cell < 0").collect()}
    bound = max(8, int(total.get(-1, 0) * SHARE))
    mask = np.zeros(CELLS, bool)
    mask[[r["cell"] for r in seen.filter((F.col("cell") >= 0) & (F.col("n") > bound)).collect()]] = True
    return mask, int(total.get(-2, 0))


def _mask(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)


class Packed:
    """Distinct segments with counts and least origins, as arrays."""

    fields = (("key", np.uint32), ("size", np.int32), ("count", np.int64), ("repeats", np.uint8),
              ("od", np.int64), ("os", np.int64))

    def __init__(self, parts: list[dict]):
        for name, kind in self.fields:
            setattr(self, name, np.concatenate([p[name] for p in parts] or [np.zeros(0, kind)]))
        self.data = np.concatenate([p["data"] for p in parts] or [np.zeros(0, np.uint8)])
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size

    def reorder(self, order: np.ndarray) -> None:
        self.data = flat.gather(self.data, self.start[order], self.start[order] + self.size[order])
        for name, _ in self.fields:
            setattr(self, name, getattr(self, name)[order])
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size

    def merge(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Indices of one segment of each content; counts and least origins go to it."""
        order = np.argsort(h1)
        tied = np.zeros(len(order), bool)
        tied[1:] = h1[order[1:]] == h1[order[:-1]]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        few = order[at]
        order[at] = few[np.lexsort((self.os[few], self.od[few], h2[few], h1[few]))]
        same = np.zeros(len(order), bool)
        a, b = order[:-1], order[1:]
        same[1:] = (h1[a] == h1[b]) & (h2[a] == h2[b]) & (self.size[a] == self.size[b])
        at = np.flatnonzero(same)
        same[at] = flat.ranges_equal(self.data, self.start[order[at - 1]], self.start[order[at]],
                                     self.size[order[at]].astype(np.int64))
        group = np.cumsum(~same) - 1
        total = np.bincount(group, self.count[order]).astype(np.int64) if len(order) else self.count
        kept = order[~same]
        self.count[kept] = total
        return kept

    def body(self, pick: np.ndarray) -> bytes:
        parts = [np.array([len(pick)], np.int64).tobytes()]
        parts += [np.ascontiguousarray(getattr(self, n)[pick]).astype(k).tobytes() for n, k in self.fields]
        parts.append(flat.gather(self.data, self.start[pick], self.start[pick] + self.size[pick]).tobytes())
        raw = b"".join(parts)
        return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=2).compress(raw, asbytes=True)

    @classmethod
    def read(cls, bodies: list[bytes]) -> Packed:
        parts = []
        for body in bodies:
            raw = pa.Codec("zstd").decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)
            n, at, part = int(np.frombuffer(raw[:8], np.int64)[0]), 8, {}
            for name, kind in cls.fields:
                part[name] = np.frombuffer(raw, kind, n, at)
                at += n * np.dtype(kind).itemsize
            part["data"] = np.frombuffer(raw, np.uint8, -1, at)
            parts.append(part)
        out = cls(parts)
        out.count = out.count.copy()
        return out


def row_numbers(col: pa.Array) -> np.ndarray:
    """Row ids as integers for the order of copies; null, and ids that aren't integers, come first."""
    if not pa.types.is_integer(col.type):
        return np.full(len(col), -2**63, np.int64)
    return col.cast(pa.int64()).fill_null(-2**63).to_numpy(zero_copy_only=False)


def _pack(spec: Spec, bits: bytes, buckets: int) -> Callable:
    def send(parts: list[dict], ids: list) -> Iterator[pa.RecordBatch]:
        p = Packed(parts)
        h1, h2 = (np.concatenate([x[i] for x in ids]) for i in (0, 1))
        kept = p.merge(h1, h2)
        bucket = (flat.mix(p.key[kept].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        kept, bucket = kept[order], bucket[order]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        for pick in np.split(np.arange(len(kept)), cut):
            if len(pick):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[pick[0]]], pa.int32()), pa.array([p.body(kept[pick])], pa.binary())],
                    ["bucket", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, parts, ids, held = _mask(bits), [], [], 0
        for batch in flat.rounds(batches):
            x = Units(batch.column("_text"), spec)
            s = Segments(x, hot)
            if len(s.at) == 0:
                continue
            parts.append({"key": s.key, "size": (s.end - s.start).astype(np.int32),
                          "count": np.ones(len(s.at), np.int64), "repeats": s.repeats.view(np.uint8),
                          "od": row_numbers(batch.column("_id"))[s.row], "os": s.at - x.first[s.row],
                          "data": flat.gather(x.data, s.start, s.end)})
            ids.append((s.h1, s.h2))
            held += len(parts[-1]["data"])
            if held >= FLUSH_BYTES:
                yield from send(parts, ids)
                parts, ids, held = [], [], 0
        if parts:
            yield from send(parts, ids)

    return run


def _ids(spec: Spec, bits: bytes, later: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = _mask(bits)
        for batch in flat.rounds(batches):
            x = Units(batch.column("_text"), spec)
            s = Segments(x, hot, ties=False)
            if len(s.at):
                row = pa.array(s.row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.h1.view(np.int64)), pa.array((s.h2 & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)),
                     batch.column("_k1").take(row), batch.column("_k2").take(row), pa.array((s.at - x.first[s.row]).astype(np.int32)),
                     *([batch.column("_id").take(row)] if later else [])],
                    ["h1", "h2", "_k1", "_k2", "start", *(["_id"] if later else [])])

    return run


def _judge(spec: Spec, kernel: Callable, later: bool) -> Callable:
    """kernel(packed, units, kept rows) -> (any, later): masks over units of repeated window starts.

    Rows are in the order of their first copies.
    """
    def run(table: pa.Table) -> pa.Table:
        p = Packed.read([b.as_py() for b in table.column("body")])
        p.reorder(np.lexsort((p.os, p.od)))
        x = Units.packed(p.data, np.append(p.start, len(p.data)), spec)
        h1, h2 = flat.digests(p.data, p.start, p.start + p.size)
        kept = np.sort(p.merge(h1, h2))
        masks = kernel(p, x, kept)
        edges = [flat.runs(mask) for mask in masks[:1 + later]]
        rows = np.unique(np.searchsorted(x.first, edges[0][0], "right") - 1)
        spans = []
        for lo, hi in edges:
            row = np.searchsorted(x.first, lo, "right") - 1
            base = x.first[row]
            both = np.stack([lo - base, hi - base + spec.k - 1], 1).reshape(-1)  # windows to the units they cover
            cut = 2 * np.append(np.searchsorted(row, rows), len(row))
            spans.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(both, pa.int32())))
        origin = [pa.array(p.od[rows]), pa.array(p.os[rows].astype(np.int32))] if later else []
        return pa.table([pa.array(h1[rows].view(np.int64)), pa.array((h2[rows] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)), *spans, *origin],
                        names=["h1", "h2", "spans", *(["later", "od", "os"] if later else [])])

    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames, so that the last join moves less."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = [None if t is None else len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True)
                 for t in batch.column("_text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_k1"), batch.column("_k2"), pa.array(texts, pa.binary())],
                                         ["_id", "_k1", "_k2", "_z"])


def unsqueeze(z: bytes | None) -> bytes:
    if z is None:
        return b""
    return pa.Codec("zstd").decompress(z[8:], int.from_bytes(z[:8], "little"), asbytes=True)


def repeated_spans(docs: DataFrame, spec: Spec, kernel: Callable, *, later: bool) -> DataFrame:
    """(_id, _z, hits): texts with the unit ranges that repeated windows cover.

    ``docs`` is keyed().  hits: array of (start, spans): ``spans`` are pairs of
    unit offsets from ``start``.  With ``later``, those of windows whose first copy this is are
    left out.
    """
    spark: SparkSession = docs.sparkSession
    id_type = docs.schema["_id"].dataType.simpleString()
    hot, size = frequent(docs, spec)
    bits = np.packbits(hot).tobytes()
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by bytes; little data is cut finer, so that all tasks have some of it
    buckets = max(-(-3 * size // BUCKET_BYTES), min(4 * deal, -(-size // LEAST_BYTES)), 1)
    flags = (docs.select("_id", "_text").mapInArrow(_pack(spec, bits, buckets), BLOB)
             .groupBy("bucket").applyInArrow(_judge(spec, kernel, later), FLAGS + LATER * later))
    ids = docs.mapInArrow(_ids(spec, bits, later), IDS + f", _id {id_type}" * later)
    spans = F.col("spans")
    if later:
        number = ids["_id"].cast("long") if isinstance(docs.schema["_id"].dataType, T.IntegralType) else F.lit(None)
        first = (F.coalesce(number, F.lit(-2**63).cast("long")) == flags["od"]) & (ids["start"] == flags["os"])
        spans = F.when(first, F.col("later")).otherwise(spans)
    hits = (ids.join(flags, (ids["h1"] == flags["h1"]) & (ids["h2"] == flags["h2"]))
            .select("_k1", "_k2", F.struct(F.col("start"), spans.alias("spans")).alias("hit"))
            .groupBy("_k1", "_k2").agg(F.collect_list("hit").alias("hits")))
    packed = docs.mapInArrow(_squeeze, f"_id {id_type}, _k1 long, _k2 long, _z binary")
    return packed.join(hits, ["_k1", "_k2"], "left").select("_id", "_z", "hits")
