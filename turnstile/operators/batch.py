"""Global row numbering and fixed-size batches.

``ROW_NUMBER() OVER (ORDER BY key)`` without PARTITION BY makes Spark move
every row into one task.  :func:`number_rows` numbers rows without that:

1. range-partition on the (total) order and sort inside each partition;
2. tag each row with its partition and ``monotonically_increasing_id`` --
   sequential within a partition once the rows are sorted;
3. write the tagged rows to the shared checkpoint folder as Parquet, which
   freezes the sampled range bounds and the ids: a lost executor reads them
   again, never a new sample;
4. count rows per partition (one row per partition reaches the driver),
   turn the counts into prefix offsets and broadcast that table -- its size
   is the number of partitions, bounded and known;
5. ``rn = offset[partition] + position in partition + 1``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.session import materialize

# Fixed value: rows per push request.
BATCH_SIZE = 100


def number_rows(df: DataFrame, order_by: Sequence[str | Column], out: str = "rn",
                num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based global row number in ``order_by`` order.

    ``order_by`` must be a total order (append a unique tiebreak) for the
    numbering to be reproducible; NULLs sort first, as in SQL Server.
    """
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    # without a count, adaptive execution joins neighbouring small ranges
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged
              .sortWithinPartitions(*order)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mono", F.monotonically_increasing_id()))
    tagged = materialize(tagged)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"),
                                         F.min("__mono").alias("__first")).collect()
    offsets, running = [], 0
    for row in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((row["__pid"], running, row["__first"]))
        running += row["__n"]
    table = spark.createDataFrame(offsets, "__opid int, __base long, __first long")
    return (tagged.join(F.broadcast(table), F.col("__pid") == F.col("__opid"))
            .withColumn(out, F.col("__base") + (F.col("__mono") - F.col("__first")) + 1)
            .drop("__pid", "__mono", "__opid", "__base", "__first"))


def number_batches(df: DataFrame, order_by: Sequence[str | Column], size: int = BATCH_SIZE,
                   rn: str = "rn", out: str = "batch_id") -> DataFrame:
    """Exact batching: row ``rn`` goes to batch ``(rn - 1) div size``; each row
    is sent once and every batch but the last has exactly ``size`` rows."""
    if size <= 0:
        raise ValueError("size must be positive")
    numbered = number_rows(df, order_by, rn)
    return numbered.withColumn(out, F.expr(f"({rn} - 1) div {int(size)}"))


def key_closure(df: DataFrame, key: str, order_by: Sequence[str | Column],
                size: int = BATCH_SIZE) -> DataFrame:
    """The original loader's batch selection: ``key IN (keys of rows numbered
    a .. a+size-1)``.

    A batch carries *every* row whose key appears among its numbered rows, so
    a key spanning several batches is sent in each of them and a batch can
    exceed ``size``; NULL keys take row numbers but are never sent.  The
    result is the compact membership ``(batch_id, key, n_rows)`` -- one row
    per key and batch, with ``n_rows`` the rows that key contributes -- so
    its size is bounded by the input, not by rows x batches.  Pushes use
    :func:`number_batches` (each row once).
    """
    columns = [key] + [c for c in order_by if isinstance(c, str) and c != key]
    numbered = number_batches(df.select(*columns), order_by, size)   # checkpointed
    keyed = numbered.filter(F.col(key).isNotNull())
    members = keyed.select("batch_id", key).distinct()
    per_key = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return members.join(per_key, key).select("batch_id", key, "n_rows")
