"""Push as a data source (S9, X2): batches go out from write tasks, with receipts, back-off and a rate.

``df.write.format(...)`` of request bodies posts each batch through the
caller's transport.  A batch's receipt is a small file in a shared folder, written as
soon as the receiver has accepted it; a task that is started again skips the
batches that have one, so it posts none twice but the one, at most, that it
was posting when it was lost, which carries the same idempotency key.  Batches that
are refused for good have a receipt with their status, and are posted again by the next push.
The commit message of each task holds its counts; commit and abort leave a marker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Transport = Callable[[str, str, str], tuple[int, str]]
RECEIPT = "entity string, batch_id bigint, n_rows bigint, status int, response string, attempts int"


def push_source(transport: Transport, attempts: int = 4, first_wait: float = 0.2, per_second: float | None = None):
    """A data source class for :func:`push`.

    A batch is posted up to ``attempts`` times while the transport fails or answers 429 or 5xx, waiting twice as
    long each time from ``first_wait`` seconds on; ``per_second`` bounds a task's requests.  The class travels
    by value, so workers need not have this package.
    """
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    class Done(WriterCommitMessage):
        def __init__(self, sent: int, skipped: int, refused: int):
            self.sent, self.skipped, self.refused = sent, skipped, refused

    class Receipts:
        """One file per batch below a folder of any store that pyarrow opens."""

        def __init__(self, folder: str):
            from pyarrow import fs

            self.store, self.folder = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")

        def read(self, name: str) -> dict | None:
            import json

            try:
                with self.store.open_input_stream(f"{self.folder}/{name}.json") as f:
                    return json.loads(f.read())
            except (FileNotFoundError, ValueError):
                return None

        def write(self, name: str, row: dict) -> None:
            import json

            self.store.create_dir(self.folder, recursive=True)
            with self.store.open_output_stream(f"{self.folder}/_{name}.part") as f:
                f.write(json.dumps(row).encode())
            self.store.move(f"{self.folder}/_{name}.part", f"{self.folder}/{name}.json")

    class PushWriter(DataSourceWriter):
        def __init__(self, options: dict):
            self.entity, self.endpoint, self.run = options["entity"], options["endpoint"], options["run"]
            self.folder = options["receipts"]

        def _post(self, body: str, key: str) -> tuple[int, str, int]:
            import time

            wait = first_wait
            for n in range(1, attempts + 1):
                try:
                    status, response = transport(self.endpoint, body, key)
                except Exception as exc:  # noqa: BLE001 -- a failed batch must not lose the others
                    status, response = -1, f"{type(exc).__name__}: {exc}"
                if not (status < 0 or status == 429 or status >= 500) or n == attempts:
                    return int(status), str(response), n
                time.sleep(wait)
                wait *= 2
            raise AssertionError("attempts is one at least")

        def write(self, iterator) -> WriterCommitMessage:
            import time

            receipts, sent, skipped, refused, ready = Receipts(self.folder), 0, 0, 0, 0.0
            for row in iterator:
                name = f"{self.entity}-{row['batch_id']}"
                before = receipts.read(name)
                if before and 200 <= before["status"] < 300:
                    skipped += 1
                    continue
                if per_second:
                    time.sleep(max(0.0, ready - time.monotonic()))
                    ready = time.monotonic() + 1 / per_second
                status, response, n = self._post(row["body"], f"{self.run}/{self.entity}/{row['batch_id']}")
                receipts.write(name, {"entity": self.entity, "batch_id": row["batch_id"], "n_rows": row["n_rows"],
                                      "status": status, "response": response, "attempts": n})
                sent, refused = sent + 1, refused + (not 200 <= status < 300)
            return Done(sent, skipped, refused)

        def commit(self, messages) -> None:
            counts = [m for m in messages if m is not None]
            Receipts(f"{self.folder}/_done").write(self.entity, {c: sum(getattr(m, c) for m in counts) for c in ("sent", "skipped", "refused")})

        def abort(self, messages) -> None:
            Receipts(f"{self.folder}/_aborted").write(self.entity, {"tasks": sum(m is not None for m in messages)})

    class PushSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "turnstile_push"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return PushWriter(dict(self.options))

    return PushSource


def push(bodies: DataFrame, entity: str, endpoint: str, run_id: str, receipts: str, transport: Transport, **options) -> DataFrame:
    """Post the batches (batch_id, n_rows, body) that have no accepted receipt yet; returns the entity's receipts."""
    spark: SparkSession = bodies.sparkSession
    spark.dataSource.register(push_source(transport, **options))
    folder = f"{receipts.rstrip('/')}/run={run_id}"
    (bodies.select("batch_id", "n_rows", "body").write.format("turnstile_push").mode("append")
     .option("entity", entity).option("endpoint", endpoint).option("run", run_id).option("receipts", folder).save())
    return spark.read.schema(RECEIPT).option("pathGlobFilter", f"{entity}-*.json").json(folder).filter(F.col("entity") == entity)
