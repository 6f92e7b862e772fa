"""Vector code compression: product codes from exact integer distances.

Components become integers ``floor(scale * x)``; vectors are cut into equal
parts, and each part gets the index of the nearest of its position's codebook
entries.  Codebooks start as the vectors of the smallest ids and are refined by
a fixed number of rounds of assignment and componentwise floored means.

Distances come from matrix products in float64 that are exact: integers are
broken into limbs so narrow that the products of two limbs, summed over a part,
stay within 2**53; the limbs' dot products are put together again in int64, and
the first least distance wins.  A round reads the vectors once and sends one
row of sums per codebook component and task; the codebooks (entries times
dimension integers, whatever the number of vectors) are all that the driver and
the tasks hold.

Defined cases: a row whose vector is null or holds a null, a NaN or an infinite
component is dropped, and so is one whose integers are so large that a long
can't hold its squared distances (2**27 and more for 64 components).  All
vectors have one length: the commonest (ties: the longest) that the parts divide;
rows of another length are dropped.  Ties of ids are ordered by the vectors,
null ids come last; repeated rows count each.  Fewer vectors than entries give
smaller codebooks, an empty table an empty result.  Labels are compared with
nulls as one label.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.session import ensure_checkpoint_dir, materialize

#: rows whose distances are held at once
ROWS = 2048


def most(length: int) -> int:
    """Integers below this in magnitude have squared distances, over ``length`` components, that a long holds."""
    return 1 << (61 - int(length).bit_length()) // 2


def _integers(scale: float):
    """Kept rows with their integers as little-endian int32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.filter(batch.column("_x").is_valid())
            x = held.column("_x")
            size = np.diff(np.asarray(x.offsets)) if len(x) else np.zeros(0, np.int64)
            first = np.concatenate([[0], np.cumsum(size)])
            flat = x.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(values * scale)
                row_limit = np.repeat([most(n) for n in size.tolist()], size)
                bad = ~(np.abs(values) < row_limit)
            total = np.concatenate([[0], np.cumsum(bad)])
            ok = np.flatnonzero(total[first[1:]] == total[first[:-1]])
            whole = np.where(bad, 0, values).astype("<i4")
            parts = [whole[first[i]:first[i + 1]].tobytes() for i in ok.tolist()]
            part = held.take(pa.array(ok, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_label"), pa.array(size[ok].astype(np.int32)),
                                              pa.array(parts, pa.binary())], ["_id", "_label", "_n", "_v"])

    return run


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 limbs of integers, lowest first; the last one has the sign."""
    out = []
    while True:
        if not len(x.ravel()) or (x.min() >= -(1 << bits) and x.max() <= 1 << bits):
            return [*out, x.astype(float)]
        out.append((x & ((1 << bits) - 1)).astype(float))
        x = x >> bits


def dots(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of int64 arrays (part, row, component) and (part, entry, component)."""
    bits = (53 - int(v.shape[2]).bit_length()) // 2
    out = np.zeros((v.shape[0], v.shape[1], c.shape[1]), np.int64)
    low = limbs(c, bits)
    for i, a in enumerate(limbs(v, bits)):
        for j, b in enumerate(low):
            out += np.matmul(a, b.transpose(0, 2, 1)).astype(np.int64) << np.int64(bits * (i + j))
    return out


def nearest(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) by part and row; ties go to the lower entry."""
    far = (v * v).sum(2)[:, :, None] - 2 * dots(v, books) + (books * books).sum(2)[:, None, :]
    best = far.argmin(2)
    return best, np.take_along_axis(far, best[:, :, None], 2)[:, :, 0]


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their integers as (part, row, component)."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            x = np.frombuffer(b"".join(some.column("_v").to_pylist()), "<i4").astype(np.int64)
            yield some, x.reshape(some.num_rows, parts, -1).transpose(1, 0, 2)


SUMS = "part int, entry int, place int, total long, n long"


def _sums(books: np.ndarray):
    """Per part, entry and component the sum and number of what is nearest to the entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for _, v in _blocks(batches, parts):
            best, _ = nearest(v, books)
            for p in range(parts):
                np.add.at(total[p], best[p], v[p])
                n[p] += np.bincount(best[p], minlength=entries)
        p, e = np.nonzero(n)
        columns = (np.repeat(p, width).astype(np.int32), np.repeat(e, width).astype(np.int32),
                   np.tile(np.arange(width, dtype=np.int32), len(p)), total[p, e].ravel(), np.repeat(n[p, e], width))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "place", "total", "n"])

    return run


def _encode(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, v in _blocks(batches, len(books)):
            best, far = nearest(v, books)
            code = [row.tobytes() for row in best.T.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([some.column("_id"), some.column("_label"), pa.array(code, pa.binary()), pa.array(far.sum(0))],
                                             ["_id", "_label", "code", "error"])

    return run


def _refined(books: np.ndarray, kept: DataFrame) -> np.ndarray:
    """The books after one round; sums over all tasks are decimals, so they can't overflow."""
    out = books.copy()
    total = F.sum(F.col("total").cast("decimal(20,0)"))
    for r in kept.mapInArrow(_sums(books), SUMS).groupBy("part", "entry", "place").agg(total.alias("total"), F.sum("n").alias("n")).collect():
        out[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = 16, entries: int = 64, scale: float = 256, rounds: int = 2) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): per kept row _id, _label, code (a byte per part) and
    error, and int64 codebooks by part, entry and component."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index is one byte")
    kind = vectors.select(F.col(id_col).alias("i"), F.col(label_col).alias("l")).dtypes
    ids = f"_id {kind[0][1]}, _label {kind[1][1]}"
    whole = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).cast("array<double>").alias("_x")
                           ).mapInArrow(_integers(scale), f"{ids}, _n int, _v binary")
    length = whole.filter((F.col("_n") > 0) & (F.col("_n") % parts == 0)).groupBy("_n").count().orderBy(F.desc("count"), F.desc("_n")).first()
    kept = whole.filter(F.col("_n") == (length["_n"] if length else -1)).drop("_n")
    seeds = [bytes(r["_v"]) for r in kept.orderBy(F.asc_nulls_last("_id"), "_v").limit(entries).select("_v").collect()]
    books = np.frombuffer(b"".join(seeds), "<i4").astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2) if seeds else np.zeros((parts, 1, 1), np.int64)
    for _ in range(rounds if seeds else 0):
        books = _refined(books, kept)
    return kept.mapInArrow(_encode(np.ascontiguousarray(books)), f"{ids}, code binary, error long"), books if seeds else books[:, :0]


def digest(vectors: DataFrame) -> DataFrame:
    """op12: vec_id, code, error, label_error, codebooks_sha256."""
    ensure_checkpoint_dir(vectors.sparkSession)
    codes, books = compress(vectors)
    codes = materialize(codes)
    sums = codes.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    seal = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return codes.join(sums, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(seal).alias("codebooks_sha256"))


ORACLE = """
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rn, len(embedding) // 16 AS width,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT rn, p, list_slice(v, p * width + 1, (p + 1) * width) AS x FROM kept, range(16) AS r(p)),
book0 AS MATERIALIZED (SELECT p, rn - 1 AS e, x FROM pieces WHERE rn <= 64),
near0 AS MATERIALIZED (
  SELECT rn, a.p, any_value(a.x) AS x,
         min({'d': list_sum(list_transform(list_zip(a.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.e}) AS best
  FROM pieces a JOIN book0 c ON a.p = c.p GROUP BY rn, a.p),
mean0 AS (
  SELECT p, best.e AS e, j, sum(x[j]) AS s, count(*) AS n FROM near0, range(1, 1 + len(x)) AS r(j) GROUP BY ALL),
flat0 AS (SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM mean0 GROUP BY p, e),
book1 AS MATERIALIZED (SELECT b.p, b.e, coalesce(f.x, b.x) AS x FROM book0 b LEFT JOIN flat0 f ON b.p = f.p AND b.e = f.e),
near1 AS MATERIALIZED (
  SELECT rn, a.p, any_value(a.x) AS x,
         min({'d': list_sum(list_transform(list_zip(a.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.e}) AS best
  FROM pieces a JOIN book1 c ON a.p = c.p GROUP BY rn, a.p),
mean1 AS (
  SELECT p, best.e AS e, j, sum(x[j]) AS s, count(*) AS n FROM near1, range(1, 1 + len(x)) AS r(j) GROUP BY ALL),
flat1 AS (SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM mean1 GROUP BY p, e),
book2 AS MATERIALIZED (SELECT b.p, b.e, coalesce(f.x, b.x) AS x FROM book1 b LEFT JOIN flat1 f ON b.p = f.p AND b.e = f.e),
near2 AS (
  SELECT rn, a.p, min({'d': list_sum(list_transform(list_zip(a.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.e}) AS best
  FROM pieces a JOIN book2 c ON a.p = c.p GROUP BY rn, a.p),
coded AS (
  SELECT rn, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near2 GROUP BY rn),
seal AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rn), seal
"""
