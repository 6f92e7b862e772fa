"""Per-key lookups that replace correlated scalar subqueries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import col_of
from turnstile.operators.envelope import lowest_active


def first_by_key(df: DataFrame, key: str, order_by: Sequence[str | Column],
                 values: Mapping[str, str | Column],
                 only_when: Column | None = None) -> DataFrame:
    """One row per ``key``: ``values`` taken from the row with the lowest
    ``order_by`` (``TOP 1`` made deterministic).

    ``only_when`` restricts the candidate rows of this pick (rows where it is
    false or NULL are ignored by ``min_by``).  Computed with ``min_by`` so the
    aggregation is partial on the map side: a transaction with millions of
    receipts is reduced per task before the shuffle.
    """
    order = F.struct(*[col_of(c) for c in order_by])
    if only_when is not None:
        order = F.when(only_when, order)
    picked = F.min_by(F.struct(*[col_of(v).alias(k) for k, v in values.items()]), order)
    return (df.groupBy(key).agg(picked.alias("__pick"))
            .select(key, *[F.col(f"__pick.{k}").alias(k) for k in values]))


def first_match(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                order_by: Sequence[str | Column], values: Mapping[str, str | Column],
                only_when: Column | None = None) -> DataFrame:
    """``left`` plus ``(SELECT TOP 1 v FROM right WHERE right_key = left_key)``
    for each of ``values``; NULL where nothing matches."""
    picks = first_by_key(right, right_key, order_by, values, only_when)
    picks = picks.withColumnRenamed(right_key, "__fm_key")
    return (left.join(picks, F.col(left_key) == F.col("__fm_key"), "left")
            .drop("__fm_key"))


def sum_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``groupBy(key).sum(value)`` (partial on the map side; decimals summed
    in the decimal type itself)."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


def sum_lookup(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
               value: str, out: str) -> DataFrame:
    """``left`` plus ``(SELECT sum(value) FROM right WHERE right_key = left_key)``
    -- NULL, not 0, when there is no row."""
    sums = sum_by_key(right, right_key, value, out).withColumnRenamed(right_key, "__sum_key")
    return left.join(sums, F.col(left_key) == F.col("__sum_key"), "left").drop("__sum_key")


def _micros(df: DataFrame, c: str) -> Column:
    """Microseconds since 1970 of a date or timestamp column."""
    kind = df.schema[c].dataType.simpleString()
    if kind == "timestamp":
        return F.unix_micros(c)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


def range_lookup(left: DataFrame, left_key: str, left_ts: str, table: DataFrame,
                 table_key: str, start: str, end: str, value: str, out: str,
                 probes: DataFrame | None = None) -> DataFrame:
    """``left`` plus ``(SELECT TOP 1 value FROM table WHERE left_ts BETWEEN start
    AND end AND table_key = left_key)``, TOP 1 = lowest ``value``.

    Distinct ``(left_key, left_ts)`` pairs are looked up in one sweep over the
    table's intervals (:mod:`turnstile.operators.envelope`).  Rows without a
    start, an end or a value, or ending before they start, match nothing.
    ``probes`` holds all pairs of ``left`` in columns of the same names, where these are cheaper to come by.
    """
    asked = left if probes is None else probes
    points = (asked.select(F.col(left_key).alias("k"), _micros(asked, left_ts).alias("t"))
              .filter("k is not null and t is not null").distinct())
    spans = table.select(F.col(table_key).alias("k"), _micros(table, start).alias("s"), _micros(table, end).alias("e"),
                         F.col(value).alias("v")).dropna()
    found = lowest_active(points, spans).select(F.col("k").alias("__rk"), F.col("t").alias("__rt"), F.col("v").alias(out))
    return (left.join(found, (F.col(left_key) == F.col("__rk")) & (_micros(left, left_ts) == F.col("__rt")), "left")
            .drop("__rk", "__rt"))
