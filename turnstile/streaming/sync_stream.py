"""Incremental sync as a Structured Streaming job (I4).

New ticket rows arrive as files; each micro-batch builds the working set of
its tickets against the (static) other sources and writes the procedure
products.  ``Trigger.AvailableNow`` processes whatever has arrived and stops,
so a scheduler can run it like the batch sync; the checkpoint location
records which files are done, so a restarted run neither skips nor repeats
input.  Each product is written to ``<out>/<product>/epoch=<id>`` with
overwrite, so a micro-batch replayed after a failure replaces its own output
instead of appending twice (exactly-once output).

The per-batch products only see tickets of that batch: equivalent tickets
that arrive in different batches get different canonical ids -- the same
limitation the original jobs have across sync runs (no late-data handling).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from turnstile.plans.sync import reformat
from turnstile.plans.working_set import build_working_set
from turnstile.session import materialize, scratch_frames

PRODUCTS = ("contacts", "tickets", "payments")


def start_sync_stream(tickets_stream: DataFrame, static_src: Mapping[str, DataFrame],
                      out_dir: str, checkpoint_location: str, lo, hi,
                      to_tickets: Callable[[DataFrame], DataFrame] | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``to_tickets`` maps a raw micro-batch to the tickets
    schema (identity when the stream already has it)."""
    out_dir = out_dir.rstrip("/")

    def process(batch: DataFrame, epoch_id: int) -> None:
        with scratch_frames(batch.sparkSession):  # a stream must not leave frames behind with every batch
            src = dict(static_src)
            src["tickets"] = to_tickets(batch) if to_tickets is not None else batch
            # three products read the working set; none needs the receipt id that its rows would carry through the backfills
            ws = materialize(build_working_set(src, lo, hi, keep_internal=True, prune_to_scope=True).drop("_txn_min_rcb"))
            products = reformat(src, ws, lo, hi, incremental=True)
            # the three products are independent jobs: submit them together
            # so their stages share the executors instead of queueing
            with ThreadPoolExecutor(max_workers=len(PRODUCTS)) as pool:
                futures = [pool.submit(products[name].write.mode("overwrite").parquet,
                                       f"{out_dir}/{name}/epoch={epoch_id}")
                           for name in PRODUCTS]
                for f in futures:
                    f.result()

    writer = (tickets_stream.writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
