"""Canonical-id backfills that replace the UPDATE ... FROM self-joins.

Both assign to every row the minimum of some id over the row's equivalence
class.  The class is defined by

* *strict* keys, compared with ``=``: a NULL never matches, so a row with a
  NULL strict key is in no class and keeps the default (0);
* *sentinel* keys, compared as ``isnull(a, s) = isnull(b, s)``: NULL and the
  sentinel value are the same class member.

When the original UPDATE finds several matching groups (NULL vs 0 guide,
say) it takes an arbitrary one; here the lowest id of the whole class wins,
which is what the grouped form yields.

Plan: ``groupBy(class keys).min(id)`` -- partial aggregation, so a hot class
(one contact holding a third of the rows) is reduced on the map side -- then
one left equi-join of all rows on the class keys; a hot class on the probe side
is split by AQE's skew-join handling.  Rows with a NULL strict key match
nothing; a salt that only they have keeps them out of one partition.
:mod:`turnstile.operators.identity` keeps the minima over several runs.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import col_of


def class_keys(df: DataFrame, strict: Sequence[str], sentinel: Mapping[str, object]):
    """Class-key expressions, their names, and the all-strict-keys-present flag."""
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    # datetimes go in as ISO text so no session/system time zone is involved
    sentinel = {c: (s.isoformat(" ") if isinstance(s, _dt.datetime)
                    else s.isoformat() if isinstance(s, _dt.date) else s)
                for c, s in sentinel.items()}
    keys = [F.col(c) for c in strict]
    keys += [F.coalesce(F.col(c), F.lit(s).cast(types[c.lower()])) for c, s in sentinel.items()]
    names = [f"__k{i}" for i in range(len(keys))]
    valid = F.lit(True)
    for c in strict:
        valid = valid & F.col(c).isNotNull()
    return [k.alias(n) for k, n in zip(keys, names)], names, valid


def class_mins(df: DataFrame, value: str | Column, strict: Sequence[str],
               sentinel: Mapping[str, object]) -> DataFrame:
    """``(__z, class keys..., __min)``: min(value) per class over rows whose strict
    keys are all present.  Partial aggregation runs before the shuffle.

    ``__z`` is the salt of all classes, 0.  It is no literal, since the optimizer would take that out
    of the join's keys, and a group key, so that the classes lie as the join wants them."""
    keys, names, _ = class_keys(df, strict, sentinel)
    # rows with a NULL strict key collapse before the shuffle and match nothing
    salt = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint").alias("__z")
    return df.select(salt, *keys, col_of(value).alias("__v")).groupBy("__z", *names).agg(F.min("__v").alias("__min"))


def attach_class_min(df: DataFrame, mins: DataFrame, strict: Sequence[str],
                     sentinel: Mapping[str, object], out: str, default=0,
                     value_type: str = "bigint") -> DataFrame:
    """``df`` plus ``out`` from a :func:`class_mins` table (``default`` when
    the row has a NULL strict key or its class has no minimum)."""
    return attach_class_mins(df, [(mins, strict, sentinel, out, default, value_type)])


def attach_class_mins(df: DataFrame, backfills: Sequence[tuple], spread: Sequence[str] | None = None) -> DataFrame:
    """Attach several class minima at once.

    ``backfills`` holds ``(mins, strict, sentinel, out, default, value_type)``
    tuples.  Each is one left join of all rows.  Rows with a NULL strict key
    match nothing; a salt that only they have spreads them over the partitions,
    so they don't meet in one task.  It is a hash of the columns ``spread``, all by default;
    rows that are alike in many columns are best kept together, which compresses.
    """
    columns = list(df.columns)
    spread = columns if spread is None else list(spread)
    result = df
    for i, (mins, strict, sentinel, out, default, value_type) in enumerate(backfills):
        keys, names, valid = class_keys(df, strict, sentinel)
        renamed = [f"__b{i}{n}" for n in names]
        salt = F.when(valid, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(1 << 15)))
        found = mins.select(*[F.col(n).alias(r) for n, r in zip(names, renamed)], F.col("__z").alias(f"__z{i}"),
                            F.col("__min").alias(f"__m{i}"))
        # the keys are compared as they are, so that the shuffled rows don't carry them twice
        same = F.col(f"__s{i}") == F.col(f"__z{i}")
        for key, r in zip(keys, renamed):
            same = same & (key == F.col(r))
        result = (result.withColumn(f"__s{i}", salt.cast("bigint")).join(found, same, "left")
                  .withColumn(out, F.coalesce(F.col(f"__m{i}"), F.lit(default).cast(value_type))))
        columns_out = [*columns, *[b[3] for b in backfills[:i + 1]]]
        result = result.select(*columns_out)
    return result


def class_min(df: DataFrame, value: str | Column, strict: Sequence[str],
              sentinel: Mapping[str, object], out: str, default=0) -> DataFrame:
    """``df`` plus ``out`` = min(value) over the row's class, ``default`` if none.

    Sentinels are cast to their key column's type (``isnull`` keeps the type
    of its first argument), so ``"2000-01-01"`` works for a timestamp key.
    Rows whose own ``value`` is NULL still take the class minimum; a class
    whose values are all NULL yields ``default``.
    """
    value_type = (df.schema[value].dataType.simpleString() if isinstance(value, str)
                  else "bigint")
    return attach_class_min(df, class_mins(df, value, strict, sentinel), strict, sentinel,
                            out, default, value_type)


def group_min_backfill(df: DataFrame, value: str, strict_keys: Sequence[str],
                       sentinel_keys: Mapping[str, object], out: str = "minticode",
                       default=0) -> DataFrame:
    """``out`` = lowest ``value`` among rows equal on the strict keys and on
    ``isnull(key, sentinel)`` for the sentinel keys; ``default`` when a strict
    key is NULL.  Example (the working set)::

        group_min_backfill(ws, "ticode",
            ["tipricetype", "tifullprice", "eveventdate", "shcode", "tilcode",
             "timailinglist", "tistatus"],
            {"guideid": 0, "ptdescr": "", "rcbshiftdate": datetime(2000, 1, 1)})
    """
    return class_min(df, value, strict_keys, sentinel_keys, out, default)


def payment_backfill(df: DataFrame, keys: Sequence[str], txn_min: str,
                     out: str = "paymentid", default=0) -> DataFrame:
    """``out`` = lowest receipt id over all receipts of all transactions of
    the rows sharing ``keys`` (all strict); ``default`` when a key is NULL or
    the class has no receipt.

    ``txn_min`` is the per-transaction lowest receipt id, already attached to
    each row (the working-set build computes it in the same pass over the
    receipts as the first-receipt lookups, see
    :func:`turnstile.plans.working_set.receipts_by_transaction`).  Joining
    receipts per row and grouping, as the original job does, gives the same
    minimum, because every ticket of a transaction sees the same receipts.
    The receipt-credit left join of the original job cannot change a MIN and is
    not performed.
    """
    return class_min(df, txn_min, keys, {}, out, default)
