"""Planned reads of operational tables (S1, S2): even splits, and filters that reach the store.

A range-partitioned read with equal steps between the least and the greatest
id gives one task most of the rows when ids are skewed.  Here the splits come
from equi-depth quantiles of the key; a value that fills several splits by
itself is dealt out by a hash of its rows' other key.  Conditions of the scan are
handed to the store with each split's range, and splits that a condition on the
key rules out are never planned.  (Conditions are an argument: Spark 4.1 keeps the
filters that it pushes into a Python source for later queries of the same frame.)

The store is a function ``fetch(conditions, columns) -> Arrow batches``, where
conditions are ``(column, operator, value)`` triples to be joined by AND (operators:
``=  <  <=  >  >=  in  is null  is not null``, and ``mod`` with ``(n, i)``: hash
part i of n); :func:`parquet_fetch` reads files, a database's function would turn
the triples into a WHERE clause.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Condition = tuple[str, str, object]
Fetch = Callable[[list[Condition], list[str]], Iterable[pa.RecordBatch]]


def equi_depth(keys: DataFrame, key: str, parts: int, error: float = 0.1) -> list[tuple[int | None, int | None, int]]:
    """Splits ``(from, to, pieces)`` of an integer key, from included and to not, None for open ends.

    Each split holds about a ``parts``-th of the rows (``error`` of that off at most), but for a value that alone
    holds more: it is a split of its own in several pieces.  ``keys`` may be a sample.
    """
    share = [i / parts for i in range(1, parts)]
    cuts = keys.select(F.col(key).cast("bigint").alias("k")).dropna().approxQuantile("k", share, error / parts) if parts > 1 else []
    cuts = [int(c) for c in cuts]
    ends: list[tuple[int, int]] = []  # value, how many quantiles fall on it
    for c in cuts:
        if ends and ends[-1][0] == c:
            ends[-1] = (c, ends[-1][1] + 1)
        else:
            ends.append((c, 1))
    out: list[tuple[int | None, int | None, int]] = []
    at: int | None = None
    for value, times in ends:
        if at is None or value > at:
            out.append((at, value, 1))
        if times > 1:  # as many splits as it fills
            out.append((value, value + 1, times))
            at = value + 1
        else:
            at = value
    return [*out, (at, None, 1)]


def parquet_fetch(path: str) -> Fetch:
    """Rows of Parquet files by pyarrow, whose row groups the conditions prune."""
    def fetch(conditions: list[Condition], columns: list[str]) -> Iterator[pa.RecordBatch]:
        import zlib

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        ops = {"=": lambda f, v: f == v, "<": lambda f, v: f < v, "<=": lambda f, v: f <= v, ">": lambda f, v: f > v, ">=": lambda f, v: f >= v,
               "in": lambda f, v: f.isin(list(v)), "is null": lambda f, v: f.is_null(), "is not null": lambda f, v: f.is_valid()}
        wanted, mods = None, [c for c in conditions if c[1] == "mod"]
        for column, op, value in conditions:
            if op != "mod":
                one = ops[op](pc.field(column), value)
                wanted = one if wanted is None else wanted & one
        extra = [c for c, _, _ in mods if c not in columns]
        for batch in ds.dataset(path).to_batches(columns=[*columns, *extra], filter=wanted):
            for column, _, (n, i) in mods:
                keep = [zlib.crc32(str(v).encode()) % n == i for v in batch.column(column).to_pylist()]
                batch = batch.filter(pa.array(keep, pa.bool_()))
            yield batch.select(columns)

    return fetch


def planned_source(fetch: Fetch, ddl: str, key: str, splits: list[tuple[int | None, int | None, int]], other_key: str | None = None,
                   where: tuple[Condition, ...] = ()):
    """A data source class over ``fetch``; it travels by value, so workers need not have this package."""
    from pyspark.sql import datasource as d

    class Split(d.InputPartition):
        def __init__(self, conditions: list):
            self.conditions = conditions

    class PlannedReader(d.DataSourceReader):
        def __init__(self, columns: list[str]):
            self.columns = columns

        def _excluded(self, low, high) -> bool:
            """Whether a condition on the key leaves nothing of a split."""
            for column, op, value in where:
                if column != key or op in ("is null", "is not null"):
                    continue
                values = list(value) if op == "in" else [value]
                if op in ("=", "in") and all((low is not None and v < low) or (high is not None and v >= high) for v in values):
                    return True
                if low is not None and (op == "<" and value <= low or op == "<=" and value < low):
                    return True
                if high is not None and (op == ">" and value >= high - 1 or op == ">=" and value >= high):
                    return True
            return False

        def partitions(self):
            out = []
            for low, high, pieces in splits:
                if self._excluded(low, high):
                    continue
                span = [(key, ">=", low)] * (low is not None) + [(key, "<", high)] * (high is not None)
                pieces = pieces if other_key else 1
                out += [Split(span + [(other_key, "mod", (pieces, i))] * (pieces > 1)) for i in range(pieces)]
            compared = any(c == key and op != "is null" for c, op, _ in where)
            if not compared:  # no comparison holds for a null key
                out.append(Split([(key, "is null", None)]))
            return out

        def read(self, partition):
            conditions = list(partition.conditions)
            if not conditions:  # the only split: everything but null keys, which have one of their own
                conditions = [(key, "is not null", None)]
            yield from fetch([*conditions, *where], self.columns)

    class PlannedSource(d.DataSource):
        @classmethod
        def name(cls) -> str:
            return "turnstile_planned"

        def schema(self) -> str:
            return ddl

        def reader(self, schema) -> d.DataSourceReader:
            return PlannedReader([f.name for f in schema.fields])

    return PlannedSource


def planned_scan(spark: SparkSession, fetch: Fetch, ddl: str, key: str, splits: list[tuple[int | None, int | None, int]],
                 other_key: str | None = None, where: Iterable[Condition] = ()) -> DataFrame:
    """The rows of a store that meet all conditions, in even splits of an integer key; see :func:`equi_depth`."""
    spark.dataSource.register(planned_source(fetch, ddl, key, splits, other_key, tuple(where)))
    return spark.read.format("turnstile_planned").load()
