"""Flat numpy views of text columns, used inside Arrow map tasks.

A batch of texts becomes one byte array plus row offsets; words, hashes and
windows are arrays over all rows at once, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: text bytes that one round of array work covers; a longer text is a round of its own
ROUND_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_TABLES: dict[str, np.ndarray] = {}


def byte_class(separators: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, byte after A-Z lower-casing) by byte value."""
    word = np.ones(256, bool)
    word[list(separators)] = False
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    return word, table


#: words are runs of anything but space and \t \n \v \f \r
SPACES = b" \t\n\v\f\r"


def keyed(docs: DataFrame, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    """(_id, _k1, _k2, _text): rows are told apart by a 128-bit hash of id and
    text, so null or repeated ids neither get lost nor mix their texts."""
    text = F.col(text_col).cast("string")
    content = (F.col(id_col).isNull(), F.col(id_col), text.isNull(), text)
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(*content).alias("_k1"), F.xxhash64(F.lit("second"), *content).alias("_k2"),
                       text.alias("_text"), *extra)


#: bytes of a batch that goes to a Python worker
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few bytes in this session from here on, whatever the texts' sizes: a task holds several at
    once, on both sides of the pipe."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def revive(cls: type, state: dict):
    """An object from its attributes; only those are broadcast, as plain arrays."""
    out = cls.__new__(cls)
    vars(out).update(state)
    return out


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, pa.scalar(b"" if pa.types.is_binary(col.type) or
                                          pa.types.is_large_binary(col.type) else "", col.type))
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[
        col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def rounds(batches: Iterator[pa.RecordBatch], text: str = "_text",
           limit: int = ROUND_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        off = utf8(batch.column(text))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_TABLES.get("p", ())) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        for name, base in (("p", _P), ("q", pow(_P, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _TABLES[name] = np.multiply.accumulate(table)
    return _TABLES["p"][:n], _TABLES["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix(u: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash, one longer than ``u``."""
    out = np.zeros(len(u) + 1, np.uint64)
    np.cumsum(u * powers(len(u))[0], out=out[1:])
    return out


def ranges_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each [start, end): equal content has equal hash wherever it stands."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def windows_hash(u: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values."""
    if len(u) < n:
        return np.zeros(0, np.uint64)
    sums = prefix(u)
    return (sums[n:] - sums[:-n]) * powers(len(sums))[1][:len(u) - n + 1]


#: ranges of more bytes than this are hashed one by one
LANES_BYTES = 128


def content_hash(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Hash of the bytes of each [lo, hi), eight at a time through a bijective
    scrambling, so that no structure of the bytes makes hashes meet."""
    out = mix((hi - lo).astype(np.uint64) + np.uint64(_P))
    for at in range(0, len(lo), step):  # some ranges at a time: the work arrays are many
        _hash_into(out[at:at + step], data, lo[at:at + step], hi[at:at + step])
    return out


def _hash_into(out: np.ndarray, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
    base = int(lo.min())
    data = np.concatenate([data[base:int(hi.max())], np.zeros(8, np.uint8)])
    lo, size = lo - base, hi - lo
    lanes = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    left = np.flatnonzero((size > 0) & (size <= LANES_BYTES))
    at = 0
    while len(left):
        lane = lanes[lo[left] + at].view(np.uint64).ravel()
        rest = size[left] - at
        short = rest < 8
        lane[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        out[left] = mix(out[left] ^ lane)
        at += 8
        left = left[rest > 8]
    view = memoryview(data)
    for i in np.flatnonzero(size > LANES_BYTES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(view[lo[i]:lo[i] + size[i]])


class Words:
    """The words of a text column: ``data`` holds each word and one space after it.

    Word i is data[start[i]:end[i]]; row r has words first[r]:first[r + 1].
    """

    def __init__(self, col: pa.Array, cls: tuple[np.ndarray, np.ndarray]):
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        if col.null_count:
            col = pc.fill_null(col, "")
        data, off = utf8(pc.binary_join_element_wise(col, pa.scalar("", col.type),
                                                     pa.scalar(" ", col.type)))
        is_word = cls[0][data]
        before = np.zeros(len(data), bool)
        before[1:] = is_word[:-1]
        keep = is_word | before
        self.data = cls[1][data[keep]]
        self.data[~is_word[keep]] = 32
        self.end = np.flatnonzero(self.data == 32)
        self.start = np.zeros_like(self.end)
        self.start[1:] = self.end[:-1] + 1
        self.first = np.searchsorted(np.flatnonzero(is_word & ~before), off)

    def __len__(self) -> int:
        return len(self.end)

    def hashes(self) -> np.ndarray:
        return content_hash(self.data, self.start, self.end)

    def inside(self, n: int) -> np.ndarray:
        """For each word, whether n words of its row start there."""
        return inside(self.first, n)


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """For each unit, whether n units of its row start there."""
    last = np.repeat(first[1:], np.diff(first))
    return np.arange(first[0], first[-1]) + n <= last


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    if len(a) < w:
        return a[:0]
    size = 1
    while 2 * size <= w:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return np.minimum(a[:len(a) - (w - size)], a[w - size:]) if w > size else a


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges [start, start + length), one range after another."""
    total = int(length.sum())
    out = np.ones(total, np.int64)
    some = length > 0
    start, length = start[some], length[some]
    if total == 0:
        return out
    at = np.cumsum(length) - length
    out[0] = start[0]
    out[at[1:]] = start[1:] - start[:-1] - length[:-1] + 1
    return np.cumsum(out)


def gather(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The bytes of the ranges [lo, hi), one range after another; for ranges of some hundred bytes."""
    view = memoryview(np.ascontiguousarray(data))
    return np.frombuffer(b"".join([view[a:b] for a, b in zip(lo.tolist(), hi.tolist())]), np.uint8)


def digests(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of the bytes of the ranges [lo, hi), as two arrays."""
    view = memoryview(np.ascontiguousarray(data))
    both = b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(lo.tolist(), hi.tolist())])
    both = np.frombuffer(both, np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def ranges_equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray,
                 step: int = 1 << 22) -> np.ndarray:
    """Whether data[a:a+length] and data[b:b+length] hold the same bytes, for each pair."""
    out = np.ones(len(a), bool)
    total = np.cumsum(length)
    at = 0
    while at < len(a):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + step, "right")))
        n = length[at:to]
        same = data[spread(a[at:to], n)] == data[spread(b[at:to], n)]
        bad = np.flatnonzero(~same)
        if len(bad):
            out[at + np.searchsorted(np.cumsum(n), bad, "right")] = False
        at = to
    return out


def covered(first: np.ndarray, start: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Mask over n units of those inside any [start, start + length)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + length, n), -1)
    return np.cumsum(edge[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    change = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        change = np.concatenate([[0], change])
    if len(mask) and mask[-1]:
        change = np.append(change, len(mask))
    return change[::2], change[1::2]


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row (0 for rows without any)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def strings(data: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A string or binary column from bytes and offsets."""
    wide = len(data) >= 2**31 - 1
    if wide:
        kind = pa.large_string() if kind == pa.string() else pa.large_binary()
    return pa.Array.from_buffers(kind, len(off) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(off, np.int64 if wide else np.int32)),
        pa.py_buffer(np.ascontiguousarray(data))])
