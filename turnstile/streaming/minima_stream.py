"""Canonical ids over a stream of tickets (I4): keyed state, corrections for late tickets.

Two queries, of which the second reads what the first has written:

* ``rows``: each micro-batch's joined working-set rows, without canonical ids, as
  they come (``<out>/rows/epoch=<id>``);
* ``changes``: per equivalence class the lowest id so far, in keyed state
  (a streaming aggregate in update mode).  When a class is met first, or a late ticket lowers it,
  one change ``(kind, class, contact, new)`` is emitted (``<out>/changes/epoch=<id>``).

The tickets of an arrival are joined once: a micro-batch of ``rows`` ends with a run of ``changes`` over the files that
it wrote, so both have the same epochs.  The products are rows and minima put together when they are read, so a late
ticket costs one change and rewrites nothing; :func:`corrections` lists the published
ids that it lowered, each the one that the class had before.  Rows of one class in a batch are reduced to their
minimum in each task before they are grouped, so a busy class is small.  A batch that is
replayed replaces its own epoch, or keeps it where it was complete: its files are known to ``changes``.  The state lives in RocksDB
below the checkpoint location.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnstile.operators.identity import ID, class_name
from turnstile.operators.scope import in_range
from turnstile.plans.working_set import (BUSY, CONTACT, PAYMENT, PAYMENT_KEYS, SENTINELS, TICKET, Parts, joined_rows, minticode_keys,
                                         side_tables, split_by_contact, with_ids, without_ids)
from turnstile.session import materialize, path_exists, released_shuffles

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def changes(rows: DataFrame) -> DataFrame:
    """Streamed joined rows to changes of their classes' minima."""
    both = [F.struct(F.lit(TICKET).alias("kind"), class_name(rows, minticode_keys(), SENTINELS).alias("class"), F.col("ticode").cast(ID).alias("low")),
            F.struct(F.lit(PAYMENT).alias("kind"), class_name(rows, PAYMENT_KEYS, {}).alias("class"), F.col("_txn_min_rcb").cast(ID).alias("low"))]
    seen = (rows.select(F.col(CONTACT).alias("contact"), F.explode(F.array(*both)).alias("x")).select("contact", "x.*")
            .filter("class is not null and low is not null"))
    # the state holds the lowest id and the batch that brought it: Spark's own aggregate, without a Python call per class
    held = (seen.withColumn("at", F.current_timestamp()).groupBy("kind", "class", "contact")
            .agg(F.min("low").alias("new"), F.min_by("at", "low").alias("at")))
    # a class is of one contact, by which those who read the changes can deal them
    return held.filter(F.col("at") == F.current_timestamp()).select("kind", "class", "contact", "new")


def static_tables(src: Mapping[str, DataFrame], lo, hi) -> dict[str, DataFrame]:
    """The static sources, with what every batch joins written once."""
    once = {"events": src["events"].filter(in_range("eveventdate", lo, hi)).select("evcode", "evshow", "eveventdate", "evpricelist"),
            "shifts": src["shifts"].filter("sfactiontype = 0").select("sfcode", "sfactiontype", "sftill", "sfactiondate"),
            "get_orderguides": src["get_orderguides"].select("gogordernumber", "gogticketid", "gogguidenumber")}
    return {**src, **{name: materialize(rows, release=True) for name, rows in once.items()}}


def _write(frame: DataFrame, folder: str) -> None:
    with released_shuffles(frame.sparkSession):
        frame.write.mode("overwrite").option("compression", "zstd").parquet(folder)


def start(tickets: DataFrame, static_src: Mapping[str, DataFrame], out_dir: str, checkpoint: str, lo, hi) -> list[StreamingQuery]:
    """Start the stream of ticket rows; it stops when all files that are there now are done, by both queries."""
    spark, out, checkpoint = tickets.sparkSession, out_dir.rstrip("/"), checkpoint.rstrip("/")
    sides = tuple(materialize(side, release=True) for side in side_tables(static_src))  # else every batch aggregates them
    static = static_tables(static_src, lo, hi)
    schema = joined_rows({**static, "tickets": tickets}, lo, hi, sides=sides).schema

    def follow() -> None:
        """One batch of ``changes`` over the epoch that was written last; none if it had that."""
        written = spark.readStream.schema(schema).parquet(f"{out}/rows")
        before = spark.conf.get(_PROVIDER, None)
        spark.conf.set(_PROVIDER, _ROCKSDB)
        try:
            query = (changes(written).writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/changes")
                     .foreachBatch(lambda batch, epoch: _write(batch, f"{out}/changes/epoch={epoch}")).trigger(availableNow=True).start())
        finally:
            spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
        query.awaitTermination()

    def process(batch: DataFrame, epoch: int) -> None:
        folder = f"{out}/rows/epoch={epoch}"
        if not path_exists(spark, f"{folder}/_SUCCESS"):
            _write(joined_rows({**static, "tickets": batch}, lo, hi, sides=sides), folder)
        follow()

    return [tickets.writeStream.foreachBatch(process).option("checkpointLocation", f"{checkpoint}/rows").trigger(availableNow=True).start()]


def _read(spark: SparkSession, out_dir: str, name: str, epoch: int | None) -> DataFrame:
    out = spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
    return out if epoch is None else out.filter(F.col("epoch") <= epoch)


def working_set(spark: SparkSession, out_dir: str, epoch: int | None = None) -> DataFrame:
    """The working set (with internal columns) of all batches, or of those up to ``epoch``."""
    rows = _read(spark, out_dir, "rows", epoch).drop("epoch")
    lows = _read(spark, out_dir, "changes", epoch).groupBy("kind", "class").agg(F.min("new").alias("low"))
    return with_ids(rows, lows)


def working_set_parts(spark: SparkSession, out_dir: str, epoch: int | None = None, busy: int = BUSY) -> Parts:
    """:func:`working_set` for roll-ups by contact (:func:`turnstile.plans.working_set.in_parts`): rows and changes are dealt
    by contact once, and the ids are the least changes of the rows' classes there."""
    rows, found = _read(spark, out_dir, "rows", epoch).drop("epoch"), _read(spark, out_dir, "changes", epoch).drop("epoch")
    usual, split, alone, many = split_by_contact(rows, busy)
    theirs = found.join(many, F.col("contact") == F.col("__busy"), "left_anti").withColumnRenamed("contact", CONTACT)
    both = usual.unionByName(theirs, allowMissingColumns=True).repartition(CONTACT)  # rows have no kind
    kinds = dict(rows.dtypes)
    for kind, strict, sentinel, out, like in ((TICKET, minticode_keys(), SENTINELS, "minticode", "ticode"),
                                              (PAYMENT, PAYMENT_KEYS, {}, "paymentid", "_txn_min_rcb")):
        name = F.when(F.col("kind").isNull(), class_name(rows, strict, sentinel)).when(F.col("kind") == kind, F.col("class"))
        low = F.min("new").over(Window.partitionBy(CONTACT, "__name")).cast(kinds[like])  # rows have no new
        both = (both.withColumn("__name", name)
                .withColumn(out, F.coalesce(F.when(F.col("__name").isNotNull(), low), F.lit(0).cast(kinds[like]))).drop("__name"))
    usual = both.filter("kind is null").drop("kind", "class", "new")
    lows = found.groupBy("kind", "class").agg(F.min("new").alias("low"))
    return Parts(rows, (usual, with_ids(split, lows), without_ids(alone)))


def corrections(spark: SparkSession, out_dir: str, epoch: int | None = None) -> DataFrame:
    """(kind, old, new, epoch): published ids that a later batch lowered."""
    before = Window.partitionBy("kind", "class").orderBy("epoch")
    return (_read(spark, out_dir, "changes", epoch).withColumn("old", F.lag("new").over(before))
            .filter("new < old").select("kind", "old", "new", "epoch"))
