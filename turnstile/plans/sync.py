"""Incremental sync (X4, X5, I1-I3): high-water mark -> rebuild -> reformat ->
count gates -> load.

State lives under ``state_dir`` (a shared location)::

    v=<run>/                          working set of the run, with its internal columns
    snapshots/run=<run>/entity=<e>/   what the run sent, as row digests (only with ``delta``)
    pending/run=<run>/                the run's bounds, until it completes
    bodies/run=<run>/entity=<e>/      request bodies with fixed batch ids
    responses/run=<run>/entity=<e>/   one row per push attempt and batch
    _runs/                            completed runs (appended last)

The most recently completed run is the previous working set.  A run counts as
completed only when its working set is written and every batch was accepted,
so a failure never moves the mark; ``retry_failed`` finishes such a run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from turnstile.operators.identity import ClassMinima
from turnstile.operators.xml import entity
from turnstile.plans import changes
from turnstile.plans import products as P
from turnstile.plans.load import xml_batches
from turnstile.plans.working_set import build_working_set
from turnstile.session import delete_path, scratch_frames
from turnstile.sources.sinks import Transport, push_batches

# Fixed value: start of the first sync when no previous working set exists.
INITIAL_START = "2016-02-01"

# Fixed value: load order, referential (contacts before payments before tickets).
LOAD_ORDER = ["contacts", "payments", "tickets"]


def increment_bounds(previous: DataFrame | None, now, default_start=INITIAL_START,
                     lookback: dt.timedelta | None = None):
    """``(lo, hi)``: ``lo`` = max event date of the previous working set (or
    ``default_start`` when there is none / it is empty), ``hi`` = ``now``.

    Both ends are inclusive, so rows at the mark are sent again
    (at-least-once).  ``lookback`` moves ``lo`` back to pick up late tickets
    of events just before the mark.  One aggregate row reaches the driver.
    """
    mark = None
    if previous is not None:
        mark = previous.agg(F.max("eveventdate").alias("m")).first()["m"]
    lo = mark if mark is not None else dt.datetime.fromisoformat(default_start)
    if lookback is not None:
        lo = lo - lookback
    return lo, now


def reformat(src: Mapping[str, DataFrame], ws: DataFrame, lo=None, hi=None,
             incremental: bool = False) -> dict[str, DataFrame]:
    """Procedure products: contacts, tickets (no schedule id), payments
    (card number '' without a card row).

    The contacts are the clients referenced by the working set: its contact
    values are exactly those of the scope (the working set only adds
    left-join fan-out), so the scope is not rebuilt.  ``lo``/``hi`` are kept
    for call compatibility; ``incremental`` restricts the card rows to the
    run's payment ids (small windows)."""
    return {"contacts": P.contacts(src, ws),
            "tickets": P.tickets(ws),
            "payments": P.payments(ws, src, card_default="", prune_cards=incremental)}


def record_counts(products: Mapping[str, DataFrame]) -> DataFrame:
    """One row per pushed product in load order: ``entity, n_rows, should_load``."""
    frames = [products[name].agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(name).alias("entity"), "n_rows") for name in LOAD_ORDER]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("should_load", F.col("n_rows") > 0)


@dataclass
class SyncReport:
    lo: object
    hi: object
    counts: dict[str, int] = field(default_factory=dict)
    responses: dict[str, DataFrame] = field(default_factory=dict)
    state_path: str | None = None
    failed_batches: int = 0


def _run_log(state_dir: str) -> str:
    return f"{state_dir.rstrip('/')}/_runs"


def _absent(exc: AnalysisException) -> bool:
    """Whether a read failed because there is nothing at the path; any other failure is a damaged log."""
    return exc.getCondition() == "PATH_NOT_FOUND"


def _latest_state(spark: SparkSession, state_dir: str) -> DataFrame | None:
    """The working set of the most recently completed run, from the run log
    (a small Parquet dataset with one row per completed run, stamped with the
    time it was logged; caller-chosen run ids need not sort in time)."""
    try:
        log = spark.read.option("mergeSchema", "true").parquet(_run_log(state_dir))
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        return None
    if "logged_at" not in log.columns:
        log = log.withColumn("logged_at", F.lit(None).cast("timestamp"))
    last = log.orderBy(F.col("logged_at").desc_nulls_last(), F.col("run_id").desc()) \
        .select("path").first()
    return None if last is None else spark.read.parquet(last["path"])


def _run_dir(state_dir: str, kind: str, run_id: str, name: str) -> str:
    return f"{state_dir.rstrip('/')}/{kind}/run={run_id}/entity={name}"


def _store_bodies(product: DataFrame, name: str, path: str) -> int:
    """Write the request bodies of a product, and count its rows in passing; an empty one leaves nothing."""
    seen = Observation()
    xml_batches(product, name).observe(seen, F.sum("n_rows").alias("rows")).write.mode("overwrite").parquet(path)
    rows = seen.get["rows"] or 0
    if not rows:
        delete_path(product.sparkSession, path)
    return rows


def _push_stored(spark: SparkSession, state_dir: str, run_id: str, name: str,
                 transport: Transport) -> int:
    """Push the stored bodies of one entity of a run that have no accepted
    response yet (all of them on the first attempt), append the responses,
    and return how many batches are still not accepted."""
    ent = entity(name)
    bodies_path = _run_dir(state_dir, "bodies", run_id, name)
    responses_path = _run_dir(state_dir, "responses", run_id, name)
    bodies = spark.read.parquet(bodies_path)
    if _has(spark, responses_path):
        accepted = (spark.read.parquet(responses_path)
                    .filter(F.col("status").between(200, 299)).select("batch_id"))
        bodies = bodies.join(accepted, "batch_id", "left_anti")
    push_batches(bodies, ent.name, ent.endpoint, transport, run_id) \
        .write.mode("append").parquet(responses_path)
    accepted = (spark.read.parquet(responses_path)
                .filter(F.col("status").between(200, 299)).select("batch_id").distinct())
    return spark.read.parquet(bodies_path).join(accepted, "batch_id", "left_anti").count()


def _log_run(spark: SparkSession, state_dir: str, run_id: str) -> None:
    """Move the run's pending record into the run log (advances the mark)."""
    pending = spark.read.parquet(f"{state_dir.rstrip('/')}/pending/run={run_id}")
    pending.withColumn("logged_at", F.current_timestamp()) \
        .write.mode("append").parquet(_run_log(state_dir))


def _push_run(spark: SparkSession, state_dir: str, run_id: str, transport: Transport,
              report: SyncReport | None = None) -> int:
    """Push every stored entity of a run in load order; stop at the first
    entity that still has unaccepted batches and return their number."""
    for name in LOAD_ORDER:
        if not _has(spark, _run_dir(state_dir, "bodies", run_id, name)):
            continue
        remaining = _push_stored(spark, state_dir, run_id, name, transport)
        if report is not None:
            report.responses[name] = spark.read.parquet(
                _run_dir(state_dir, "responses", run_id, name))
        if remaining:
            return remaining
    return 0


def sync(spark: SparkSession, src: Mapping[str, DataFrame], state_dir: str, now,
         transport: Transport | None = None, run_id: str | None = None,
         lookback: dt.timedelta | None = None, delta: bool = False,
         minima: ClassMinima | None = None) -> SyncReport:
    """One incremental run.

    1. the mark is read (one scalar) before anything is written;
    2. the working set is built (receipts pruned to the scope) and written to
       ``<state_dir>/v=<run_id>``, which the products read; the run's bounds go to
       a pending record ``pending/run=<run_id>``;
    3. contacts, payments, tickets are built once each: numbered, serialized and
       stored as request bodies under ``bodies/run=<run_id>/entity=<name>`` (fixed
       batch ids) before anything is sent; their rows are counted as they
       are written, and an empty product is not loaded;
    4. with ``delta``, rows that an accepted run sent before (at the mark, or
       within ``lookback``) are left out;
    5. the bodies are pushed in load order, responses appended under
       ``responses/run=<run_id>/entity=<name>``; pushing stops at the first
       entity with a rejected batch;
    6. only when every batch is accepted does the pending record move into
       the run log -- which advances the mark.  :func:`retry_failed` re-sends
       just the batches without an accepted response (and the entities not
       reached yet) and completes the run.

    Without a transport nothing is pushed and the run is logged.  With ``minima``
    canonical ids hold over all runs.  Temporary frames are deleted at the end.
    """
    with scratch_frames(spark):
        return _sync(spark, src, state_dir, now, transport, run_id, lookback, delta, minima)


def _accepted(spark: SparkSession, state_dir: str, name: str) -> DataFrame:
    """What the logged runs have sent of an entity, as a snapshot."""
    root = f"{state_dir.rstrip('/')}/snapshots"
    if not _has(spark, root) or not _has(spark, _run_log(state_dir)):
        return spark.createDataFrame([], changes.SNAPSHOT)
    logged = spark.read.parquet(_run_log(state_dir)).select(F.col("run_id").alias("run"))
    rows = spark.read.schema(f"{changes.SNAPSHOT}, run string, entity string").parquet(root)
    return rows.filter(F.col("entity") == name).join(logged, "run", "left_semi").select("key", "d1", "d2", "n")


def _sync(spark, src, state_dir, now, transport, run_id, lookback, delta, minima) -> SyncReport:
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    root = state_dir.rstrip("/")
    previous = _latest_state(spark, state_dir)
    lo, hi = increment_bounds(previous, now, lookback=lookback)
    state_path = f"{root}/v={run_id}"
    build_working_set(src, lo, hi, keep_internal=True, prune_to_scope=True, minima=minima,
                      run_id=run_id).write.mode("errorifexists").parquet(state_path)
    ws = spark.read.parquet(state_path)
    spark.createDataFrame([(run_id, state_path, str(lo), str(hi))],
                          "run_id string, path string, lo string, hi string"
                          ).write.mode("overwrite").parquet(f"{root}/pending/run={run_id}")
    products = reformat(src, ws, lo, hi, incremental=True)
    if delta:
        for name in LOAD_ORDER:
            fresh = changes.unsent(products[name], entity(name).key, _accepted(spark, state_dir, name))
            path = _run_dir(state_dir, "products", run_id, name)  # compared once, then counted, sent and remembered
            fresh.write.mode("overwrite").parquet(path)
            products[name] = spark.read.parquet(path)
            changes.snapshot(products[name], entity(name).key).write.mode("overwrite").parquet(_run_dir(state_dir, "snapshots", run_id, name))
    report = SyncReport(lo, hi, state_path=state_path)
    if transport is None:
        report.counts = {r["entity"]: r["n_rows"] for r in record_counts(products).collect()}
    else:
        for name in LOAD_ORDER:
            report.counts[name] = _store_bodies(products[name], name, _run_dir(state_dir, "bodies", run_id, name))
        report.failed_batches = _push_run(spark, state_dir, run_id, transport, report)
    if not report.failed_batches:
        _log_run(spark, state_dir, run_id)
    return report


def retry_failed(spark: SparkSession, state_dir: str, run_id: str,
                 transport: Transport) -> int:
    """Complete a run whose push failed: re-send only its batches without an
    accepted response, in load order, then log the run (advancing the mark)
    once nothing is left.  Returns the number of batches still not accepted;
    0 for a run that is already logged."""
    if _has(spark, _run_log(state_dir)) and spark.read.parquet(_run_log(state_dir)) \
            .filter(F.col("run_id") == run_id).count():
        return 0
    remaining = _push_run(spark, state_dir, run_id, transport)
    if not remaining:
        _log_run(spark, state_dir, run_id)
    return remaining


def _has(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as exc:
        if not _absent(exc):
            raise
        return False
