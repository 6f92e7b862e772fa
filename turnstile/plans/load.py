"""Push a staging product to the CRM in fixed-size XML batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from turnstile.operators.batch import BATCH_SIZE, number_batches
from turnstile.operators.xml import batch_envelope, entity, to_xml_rows
from turnstile.session import materialize
from turnstile.sources.sinks import Transport, push_batches


def xml_batches(product: DataFrame, entity_name: str, size: int = BATCH_SIZE,
                tiebreak: list[str] | None = None) -> DataFrame:
    """``(batch_id, n_rows, body)`` for every batch of ``product``.

    Rows are numbered by the entity key (plus ``tiebreak`` -- by default all
    mapped fields -- so equal keys get a reproducible order), cut into
    batches of ``size`` with each row sent exactly once, serialized to the
    entity's XML element and wrapped in the request envelope.
    """
    ent = entity(entity_name)
    fields = [c for c, _ in ent.fields]
    order = [ent.key, *(tiebreak if tiebreak is not None else [c for c in fields if c != ent.key])]
    # range partitioning samples its input: written first, the product is built once
    numbered = number_batches(materialize(product.select(*fields)), order, size)
    rows = to_xml_rows(numbered, ent.element, ent.fields).select("batch_id", "rn", "xml")
    return batch_envelope(rows)


def load(product: DataFrame, entity_name: str, transport: Transport, run_id: str = "run",
         size: int = BATCH_SIZE) -> DataFrame:
    """Serialize and push; returns the response rows (one per batch)."""
    ent = entity(entity_name)
    bodies = xml_batches(product, entity_name, size)
    return push_batches(bodies, ent.name, ent.endpoint, transport, run_id)
