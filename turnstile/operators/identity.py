"""Canonical ids across runs (J6, J7): a kept table of class minima.

One run gives every row the lowest id of its equivalence class.  Over several
runs the classes go on: a later run may meet members of a class whose id was
published before, or lower it.  The table holds, per class, the lowest id of all
runs, as appended folders::

    <path>/run=<run>/bucket=<b>/    classes that the run met first or lowered

so a run writes what it changes, reads the buckets that its classes fall into,
and can be repeated: its own folder is left out of what it reads and replaced.
:meth:`ClassMinima.superseded` lists the published ids that were lowered since.

A class is named by a 128-bit digest of its keys, as the change table's rows are: names of
any classes are equally short where rows are dealt and joined by them.  Rows that lack
a strict key have no class.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.functions.scalar import col_of
from turnstile.operators.backfill import class_keys
from turnstile.session import delete_path, materialize

#: ids of any kind, receipts of test data among them
ID = "decimal(38,0)"
SCHEMA = f"kind string, class string, low {ID}, run string, bucket int"


def class_name(df: DataFrame, strict: Sequence[str], sentinel: Mapping[str, object]) -> Column:
    """The class of a row as text, a 128-bit digest of its keys; null without a strict key.

    Sentinels stand for their nulls, so no key of a class is null."""
    keys, _, valid = class_keys(df, strict, sentinel)
    halves = [F.unhex(F.lpad(F.hex(h), 16, "0")) for h in (F.xxhash64(*keys), F.xxhash64(F.lit("second"), *keys))]
    return F.when(valid, F.base64(F.concat(*halves)))


def observed(df: DataFrame, kind: str, value: str | Column, strict: Sequence[str], sentinel: Mapping[str, object]) -> DataFrame:
    """(kind, class, low): the lowest value of each class of the rows."""
    rows = df.select(class_name(df, strict, sentinel).alias("class"), col_of(value).cast(ID).alias("low")).filter("class is not null")
    return rows.groupBy(F.lit(kind).alias("kind"), "class").agg(F.min("low").alias("low")).filter("low is not null")


def attach(df: DataFrame, minima: DataFrame, ids: Sequence[tuple], spread: Sequence[str]) -> DataFrame:
    """``df`` plus the class minima of each row, 0 without one.

    ``ids`` holds ``(kind, strict, sentinel, out, value_type)`` tuples.  All classes are named
    before the first join, so that a join carries no column for the sake of a later one's names.
    Rows without a class are spread by a name that no class has, from the columns ``spread``."""
    alone = F.concat(F.lit("-"), F.xxhash64(*[F.col(c) for c in spread]).cast("string"))
    named = df.select("*", *[F.coalesce(class_name(df, strict, sentinel), alone).alias(f"__class_{kind}") for kind, strict, sentinel, *_ in ids])
    for kind, _, _, out, value_type in ids:
        found = minima.filter(F.col("kind") == kind).select(F.col("class").alias("__class"), F.col("low").alias("__low"))
        named = (named.join(found, F.col(f"__class_{kind}") == F.col("__class"), "left")
                 .withColumn(out, F.coalesce(F.col("__low").cast(value_type), F.lit(0).cast(value_type)))
                 .drop("__class", "__low", f"__class_{kind}"))
    return named


class ClassMinima:
    """The kept table."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("kind", "class"), F.lit(self.buckets)).cast("int")

    def known(self) -> DataFrame:
        """(kind, class, low) over all runs."""
        return self._rows().groupBy("kind", "class").agg(F.min("low").alias("low"))

    def merge(self, run_id: str, seen: DataFrame) -> DataFrame:
        """(kind, class, low) over all runs for the classes that this run has
        ``seen`` (kind, class, low); what it met first or lowered is kept."""
        seen = materialize(seen.withColumn("bucket", self._bucket()))
        touched = [r["bucket"] for r in seen.select("bucket").distinct().collect()]  # at most self.buckets
        before = self._rows().filter(F.col("run") != run_id)
        if len(touched) < self.buckets:
            before = before.filter(F.col("bucket").isin(touched))
        mine = seen.select(F.col("kind").alias("k2"), F.col("class").alias("c2"))
        before = before.join(mine, (F.col("kind") == F.col("k2")) & (F.col("class") == F.col("c2")), "left_semi")
        old = before.groupBy("kind", "class").agg(F.min("low").alias("old"))
        merged = materialize(seen.join(old, ["kind", "class"], "left"))
        news = merged.filter("old is null or low < old").select("kind", "class", "low", "bucket")
        news.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/run={run_id}")
        return merged.select("kind", "class", F.least("low", "old").alias("low"))

    def superseded(self) -> DataFrame:
        """(kind, old, new): ids that a run gave out and a later one lowered, with what holds now."""
        # a class has at most a row a run
        now = F.min("low").over(Window.partitionBy("kind", "class"))
        rows = self._rows().select("kind", "class", "low", now.alias("new")).filter("new < low").distinct()
        return rows.select("kind", F.col("low").alias("old"), "new")

    def compact(self) -> None:
        """One folder of current minima instead of all; a crash in between leaves both, which means the same.

        The ids that were lowered so far are no longer listed."""
        folders = [r["run"] for r in self._rows().select("run").distinct().collect()]  # one row a run
        self.known().withColumn("bucket", self._bucket()).write.partitionBy("bucket").parquet(f"{self.path}/run=base-{uuid.uuid4().hex}")
        for run in folders:
            delete_path(self.spark, f"{self.path}/run={run}")


def renumbered(rows: DataFrame, column: str, superseded: DataFrame, kind: str) -> DataFrame:
    """``rows`` with the ids of ``column`` that were lowered since replaced by what holds now."""
    changes = superseded.filter(F.col("kind") == kind).select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    kept = rows.schema[column].dataType
    named = rows.join(changes, F.col(column).cast(ID) == F.col("__old"), "left")
    return named.withColumn(column, F.coalesce(F.col("__new").cast(kept), F.col(column))).drop("__old", "__new")
