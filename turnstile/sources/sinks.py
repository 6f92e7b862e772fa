"""Sinks: staging tables (S3-S6) and the batch push.

There is no network code here.  The push calls a caller-supplied
``transport(endpoint, body, key) -> (status, response)`` inside executor
tasks; ``key`` is an idempotency key ``"<run>/<entity>/<batch>"`` the
receiving side can use to ignore a replayed request (a task retried after
an executor loss sends its batches again).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

Transport = Callable[[str, str, str], tuple[int, str]]


def replace_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> None:
    """``SELECT ... INTO`` after ``IF EXISTS DROP``: create-or-replace in one
    step (no window where the table is missing), schema from the frame."""
    writer = df.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """``INSERT INTO t (cols) SELECT ...``: append, matched by column name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name)


def write_folder(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a folder-backed staging product (no catalog needed)."""
    df.write.mode("overwrite").format(fmt).save(path)


RESPONSE_SCHEMA = "entity string, batch_id bigint, n_rows bigint, status int, response string"


def push_batches(bodies: DataFrame, entity: str, endpoint: str, transport: Transport,
                 run_id: str = "run") -> DataFrame:
    """POST each batch body with ``transport``; returns one response row per
    batch (``entity, batch_id, n_rows, status, response``).

    An exception of the transport becomes a response with status -1.  Runs in
    executor tasks via ``mapInPandas`` -- bodies never pass through
    the driver.  The caller persists the responses (a table) and advances its
    sync state only when every batch succeeded.
    """
    def send(batches):
        for pdf in batches:
            rows = []
            for b, n, body in zip(pdf["batch_id"], pdf["n_rows"], pdf["body"]):
                try:
                    status, response = transport(endpoint, body, f"{run_id}/{entity}/{int(b)}")
                except Exception as exc:  # noqa: BLE001 -- a failed batch must not lose the others' responses
                    status, response = -1, f"{type(exc).__name__}: {exc}"
                rows.append((entity, int(b), int(n), int(status), str(response)))
            yield pd.DataFrame(rows, columns=["entity", "batch_id", "n_rows", "status", "response"])

    return bodies.select("batch_id", "n_rows", "body").mapInPandas(send, RESPONSE_SCHEMA)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
