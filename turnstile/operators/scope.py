"""Ticket scope (J1, J2, P4, P5) and referenced-row semi-joins."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import col_of


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from ``datetime``/``date``/ISO text.

    ``'2015-01-31 23:59'`` means 23:59:00, so 23:59:30 on that day is outside
    an inclusive range ending there -- exactly like the SQL scripts."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def in_range(c: str | Column, lo, hi) -> Column:
    """Inclusive ``BETWEEN`` on a timestamp; NULL drops the row."""
    return col_of(c).between(ts_lit(lo), ts_lit(hi))


def ticket_scope(src: Mapping[str, DataFrame], lo, hi) -> DataFrame:
    """Tickets of sale shifts whose event falls in ``[lo, hi]``.

    tickets x events x shows x shifts(sfactiontype = 0) x till, all inner.
    The date predicate and the shift-type predicate are applied on their own
    tables, so they reach the Parquet/JDBC scan; show and till only act as
    existence checks and are tiny, so Spark broadcasts them from their size
    statistics (or AQE does so at runtime from the actual shuffle size).

    The original job also left-joins ``clients`` here without reading a column
    of it; with ``cltcode`` a key that join cannot change the result, so it
    is not performed (inside the IN-subqueries Catalyst would remove it too).

    Output: every ticket column plus evcode, evshow, eveventdate, evpricelist,
    shcode, sfcode, sftill, sfactiondate, tilcode.
    """
    events = src["events"].filter(in_range("eveventdate", lo, hi)).select(
        "evcode", "evshow", "eveventdate", "evpricelist")
    shows = src["shows"].select("shcode")
    shifts = src["shifts"].filter(F.col("sfactiontype") == 0).select(
        "sfcode", "sftill", "sfactiondate")
    till = src["till"].select("tilcode")
    return (src["tickets"]
            .join(events, F.col("tievent") == F.col("evcode"))
            .join(shows, F.col("evshow") == F.col("shcode"))
            .join(shifts, F.col("tishift") == F.col("sfcode"))
            .join(till, F.col("sftill") == F.col("tilcode")))


def referenced_rows(dim: DataFrame, dim_key: str | Column, scope: DataFrame,
                    scope_key: str | Column) -> DataFrame:
    """``dim WHERE dim_key IN (SELECT DISTINCT scope_key FROM scope)``.

    The distinct is taken first (partial aggregation on the map side), so a
    key that repeats millions of times in the scope ships once per task, and
    the semi-join then keeps each dimension row at most once.  NULL keys never
    match, on either side, as with ``IN``.
    """
    keys = scope.select(col_of(scope_key).alias("__ref_key")).distinct()
    return dim.join(keys, col_of(dim_key) == F.col("__ref_key"), "left_semi")
