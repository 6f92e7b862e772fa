"""turnstile: ticket-sales staging and CRM sync, written as Spark DataFrame jobs.

Layout
------
``sources``    table scans, the ticketing source schemas, sinks and the role
               mapping that presents the driver's star-schema tables as
               ticketing sources.
``functions``  scalar column helpers (T-SQL ``len``/``isnull``/``convert``
               semantics, XML escaping and attribute extraction).
``operators``  DataFrame -> DataFrame operators with column names as arguments
               (scope, first-match lookups, id backfills, roll-ups, schedules,
               batch numbering, XML rows).
``plans``      compositions of operators into the staging products (working
               set, reformat, full/day dump, account model, load, sync).
``streaming``  the incremental sync as a Structured Streaming job.
"""

__version__ = "0.1.0"

__all__ = ["build_working_set", "dump", "load", "retry_failed", "start_sync_stream", "sync",
           "xml_batches"]


def __getattr__(name):
    # lazy re-exports: importing the package does not import pyspark modules
    if name == "build_working_set":
        from turnstile.plans.working_set import build_working_set
        return build_working_set
    if name == "dump":
        from turnstile.plans.dump import dump
        return dump
    if name in ("load", "xml_batches"):
        from turnstile.plans import load as _load
        return getattr(_load, name)
    if name in ("sync", "retry_failed"):
        from turnstile.plans import sync as _sync
        return getattr(_sync, name)
    if name == "start_sync_stream":
        from turnstile.streaming.sync_stream import start_sync_stream
        return start_sync_stream
    raise AttributeError(name)
