"""The working set of in-range tickets with canonical ticket and payment ids.

Columns (procedure form)::

    ticode, tipricetype, tifullprice, eveventdate, shcode, tilcode, timailinglist,
    titransactnum, ptdescr, rcbshiftdate, rcbcachinout, fees, guideid, tistatus,
    minticode, paymentid

The dump form (``group_by="event"``) adds ``evcode`` after ``eveventdate``
and groups the canonical ticket id by event instead of show.

Physical shape: the receipts are reduced to one row per transaction in a
single partial aggregation (first pay-type description, first shift date and
cash-in/out flag, lowest receipt id, receipt total) and the commissions to
one row per ticket; both are equi-joined to the scope.  The two id backfills
are aggregate + join (see :mod:`turnstile.operators.backfill`); these are the
operations of ``group_min_backfill`` and ``payment_backfill``, with both
aggregates taken from the same pre-backfill rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.operators.backfill import attach_class_mins, class_keys, class_mins
from turnstile.operators.identity import ClassMinima, attach, observed
from turnstile.operators.lookup import sum_by_key
from turnstile.operators.scope import ticket_scope
from turnstile.session import materialize

# Sentinels that make NULL equal to a value when matching
# equivalent tickets (guide 0, empty pay-type text, 2000-01-01 shift date).
SENTINELS = {"guideid": 0, "ptdescr": "", "rcbshiftdate": "2000-01-01"}

PAYMENT_KEYS = ["timailinglist", "ptdescr", "rcbshiftdate", "rcbcachinout"]

INTERNAL = ["_txn_min_rcb", "_txn_amount"]


def working_columns(group_by: str = "show") -> list[str]:
    """Columns of the working set's rows before the id backfills."""
    return ["ticode", "tipricetype", "tifullprice", "eveventdate", *(["evcode"] if group_by == "event" else []),
            "shcode", "tilcode", "timailinglist", "titransactnum", "ptdescr", "rcbshiftdate", "rcbcachinout", "fees", "guideid", "tistatus", *INTERNAL]


def scope_columns(group_by: str = "show") -> list[str]:
    """What the working set needs of the scope."""
    return [*minticode_keys(group_by), "ticode", "titransactnum", "tiorder", *(["shcode"] if group_by == "event" else [])]


def minticode_keys(group_by: str = "show") -> list[str]:
    if group_by not in ("show", "event"):
        raise ValueError("group_by must be 'show' or 'event'")
    return ["tipricetype", "tifullprice", "eveventdate",
            "shcode" if group_by == "show" else "evcode",
            "tilcode", "timailinglist", "tistatus"]


def receipts_by_transaction(src: Mapping[str, DataFrame]) -> DataFrame:
    """One row per transaction: ``ptdescr`` of its first receipt that has a
    pay type, ``rcbshiftdate``/``rcbcachinout`` of its first receipt, the
    lowest receipt id and the receipt total ("first" = lowest receipt id).

    Every aggregate keeps a fixed-width buffer (ids, timestamps, flags, a
    long sum), so Spark runs a hash aggregation -- no sort of the receipts --
    partial on the map side.  The pay-type *code* is picked and its text is
    looked up afterwards, on one row per transaction.
    """
    codes = src["paytype"].select(F.col("ptcode").alias("__known")).distinct()
    r = src["recieptbase"].join(codes, F.col("rcbpaytype") == F.col("__known"), "left")
    typed = F.when(F.col("__known").isNotNull(), F.col("rcbcode"))
    agg = r.groupBy("rcbtransactnum").agg(
        F.min_by("rcbpaytype", typed).alias("__ptcode"),
        F.min_by("rcbshiftdate", "rcbcode").alias("rcbshiftdate"),
        F.min_by("rcbcachinout", "rcbcode").alias("rcbcachinout"),
        F.min("rcbcode").alias("_txn_min_rcb"),
        F.sum("rcbpayamount").alias("_txn_amount"))
    texts = src["paytype"].groupBy(F.col("ptcode").alias("__pc")).agg(
        F.min("ptdescr").alias("ptdescr"))
    return (agg.join(texts, F.col("__ptcode") == F.col("__pc"), "left")
            .select("rcbtransactnum", "ptdescr", "rcbshiftdate", "rcbcachinout",
                    "_txn_min_rcb", "_txn_amount"))


def build_working_set(src: Mapping[str, DataFrame], lo, hi, group_by: str = "show",
                      keep_internal: bool = False, prune_to_scope: bool = False,
                      minima: ClassMinima | None = None, run_id: str = "run") -> DataFrame:
    """Working set for events in ``[lo, hi]`` (inclusive).

    Its joined rows are written once to the shared checkpoint folder: the two
    class minima and the rows themselves are three readers of them.

    ``keep_internal=True`` keeps the per-transaction helper columns
    ``_txn_min_rcb`` and ``_txn_amount`` that the payment roll-up reuses.  Without it no
    receipt's amount is summed, dealt or written.

    ``prune_to_scope=True`` semi-joins the receipts and commissions to the
    scope's distinct transactions / tickets *before* aggregating them; the
    scope, then read three times, is written once.  Use it
    when the window is small compared with the history (incremental sync,
    streaming micro-batches): AQE sees a small key set at runtime and
    broadcasts it, so only in-scope receipts are read past the scan.  For a
    window covering most of the history leave it off: the receipts are then
    partially aggregated before their only shuffle.  A scope of at least half as many rows as
    there are commissions is such a window: nothing is pruned then.

    With ``minima`` the canonical ids are the lowest over all runs merged into
    that table, this one (``run_id``) among them.
    """
    rows = joined_rows(src, lo, hi, group_by, prune_to_scope)
    return with_backfills(rows if keep_internal else rows.drop("_txn_amount"), group_by, keep_internal, minima, run_id)


def with_backfills(rows: DataFrame, group_by: str = "show", keep_internal: bool = False,
                   minima: ClassMinima | None = None, run_id: str = "run") -> DataFrame:
    """Joined rows, written once, with both canonical ids."""
    base = materialize(rows, release=True)
    if minima is not None:
        ws = with_ids(base, minima.merge(run_id, observed_classes(base, group_by)), group_by)
        return ws if keep_internal else ws.drop(*INTERNAL)
    ws = _joined_ids(base, group_by)
    if not keep_internal:
        ws = ws.drop(*INTERNAL)
    return ws


def _ids(rows: DataFrame, group_by: str) -> list[tuple]:
    """``(value, strict, sentinel, out, default, value_type)`` of both backfills."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return [("ticode", minticode_keys(group_by), SENTINELS, "minticode", 0, kinds["ticode"]),
            ("_txn_min_rcb", PAYMENT_KEYS, {}, "paymentid", 0, kinds["_txn_min_rcb"])]


def _joined_ids(rows: DataFrame, group_by: str) -> DataFrame:
    """Rows, which are read three times, with both ids by joins with the class minima."""
    return attach_class_mins(rows, [(class_mins(rows, value, strict, sentinel), strict, sentinel, *rest)
                                    for value, strict, sentinel, *rest in _ids(rows, group_by)], spread=["titransactnum"])


CONTACT = "timailinglist"


@dataclass(frozen=True)
class Parts:
    """The working set in ``parts`` of different contacts, and its ``rows`` before the id backfills."""
    rows: DataFrame
    parts: tuple[DataFrame, ...]


#: rows of a contact that one task may get
BUSY = 1 << 20


def split_by_contact(rows: DataFrame, busy: int = BUSY) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows of contacts with up to ``busy`` rows, of contacts with more, rows without a contact, and the contacts with more (``__busy``)."""
    # at most one contact for each ``busy`` rows
    many = F.broadcast(rows.groupBy(F.col(CONTACT).alias("__busy")).agg(F.count("*").alias("__n"))
                       .filter(F.col("__busy").isNotNull() & (F.col("__n") > busy)).select("__busy"))
    own, known = F.col(CONTACT) == F.col("__busy"), F.col(CONTACT).isNotNull()
    return rows.filter(known).join(many, own, "left_anti"), rows.join(many, own, "left_semi"), rows.filter(~known), many


def without_ids(rows: DataFrame) -> DataFrame:
    """Rows in no class, with the ids that such rows have."""
    kinds = dict(rows.dtypes)
    return rows.withColumns({"minticode": F.lit(0).cast(kinds["ticode"]), "paymentid": F.lit(0).cast(kinds["_txn_min_rcb"])})


def in_parts(base: DataFrame, group_by: str = "show", busy: int = BUSY) -> Parts:
    """Joined rows, written before, with both canonical ids, in parts of different contacts.

    The contact is a strict key of both backfills and a key of the roll-ups.  So rows that are dealt by
    it once have their classes and groups in one partition, where the joins and a roll-up deal all rows three times.  What one
    task would get of a contact is bounded: rows of contacts with more than ``busy`` of them take the joins, which spread
    them.  Rows without a contact are in no class.
    """
    usual, split, alone, _ = split_by_contact(base, busy)
    usual = usual.repartition(CONTACT)
    for value, strict, sentinel, out, default, kind in _ids(base, group_by):
        keys, _, valid = class_keys(base, strict, sentinel)
        low = F.min(value).over(Window.partitionBy(CONTACT, *keys))
        usual = usual.withColumn(out, F.coalesce(F.when(valid, low), F.lit(default).cast(kind)))
    return Parts(base, tuple(part.drop(*INTERNAL) for part in (usual, _joined_ids(split, group_by), without_ids(alone))))


def working_set_parts(src: Mapping[str, DataFrame], lo, hi, group_by: str = "show", busy: int = BUSY) -> Parts:
    """:func:`build_working_set` for roll-ups by contact: the same rows, without internal columns (:func:`in_parts`)."""
    return in_parts(written_rows(src, lo, hi, group_by), group_by, busy)


def written_rows(src: Mapping[str, DataFrame], lo, hi, group_by: str = "show") -> DataFrame:
    """:func:`joined_rows` without receipt totals, written once."""
    return materialize(joined_rows(src, lo, hi, group_by).drop("_txn_amount"), release=True)


def with_guides(src: Mapping[str, DataFrame], scope: DataFrame) -> DataFrame:
    """The scope with ``guideid``; a ticket with several guides has a row for each."""
    guides = src["get_orderguides"].select("gogordernumber", "gogticketid", F.col("gogguidenumber").alias("guideid"))
    # equal orders written as a range: the rows are dealt by ticket alone, as the fees are, so both joins share one exchange
    same_order = (F.col("tiorder") >= F.col("gogordernumber")) & (F.col("tiorder") <= F.col("gogordernumber"))
    return scope.join(guides, (F.col("ticode") == F.col("gogticketid")) & same_order, "left")


def guided_scope(src: Mapping[str, DataFrame], lo, hi) -> DataFrame:
    """Tickets in scope with their guides: what the users product needs of the working set."""
    return with_guides(src, ticket_scope(src, lo, hi))


TICKET, PAYMENT = "ticket", "payment"


def observed_classes(rows: DataFrame, group_by: str = "show") -> DataFrame:
    """(kind, class, low) of both id backfills over joined rows."""
    return (observed(rows, TICKET, "ticode", minticode_keys(group_by), SENTINELS)
            .unionByName(observed(rows, PAYMENT, "_txn_min_rcb", PAYMENT_KEYS, {})))


def with_ids(rows: DataFrame, lows: DataFrame, group_by: str = "show") -> DataFrame:
    """Joined rows with the canonical ids of ``lows`` (kind, class, low)."""
    kinds = dict(rows.dtypes)
    return attach(rows, lows, [(TICKET, minticode_keys(group_by), SENTINELS, "minticode", kinds["ticode"]),
                               (PAYMENT, PAYMENT_KEYS, {}, "paymentid", kinds["_txn_min_rcb"])], ["titransactnum"])


def side_tables(src: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Receipts by transaction and fees by ticket."""
    return receipts_by_transaction(src), sum_by_key(src["calculatedcommission"], "clcticketnum", "clcsum", "fees")


def joined_rows(src: Mapping[str, DataFrame], lo, hi, group_by: str = "show",
                prune_to_scope: bool = False, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The working set's rows before the two id backfills; ``sides`` are :func:`side_tables` that are there already."""
    scope = ticket_scope(src, lo, hi)
    if prune_to_scope:
        scope = materialize(scope.select(*scope_columns(group_by)), release=True)
        # counts of Parquet rows are in its footers; a scope of most tickets prunes nothing, and whole receipts would be dealt
        prune_to_scope = 2 * scope.count() < src["calculatedcommission"].count()
    if prune_to_scope:
        src = dict(src)
        txns = scope.select(F.col("titransactnum").alias("__scope_txn")).distinct()
        src["recieptbase"] = src["recieptbase"].join(
            txns, F.col("rcbtransactnum") == F.col("__scope_txn"), "left_semi")
        tickets = scope.select(F.col("ticode").alias("__scope_ticket")).distinct()
        src["calculatedcommission"] = src["calculatedcommission"].join(
            tickets, F.col("clcticketnum") == F.col("__scope_ticket"), "left_semi")
    ws = with_guides(src, scope)
    rcpt, fees = sides if sides is not None else side_tables(src)
    # receipts last: their wide columns are in no exchange, and the rows come out in the order of transactions, whose tickets are alike
    ws = ws.join(fees, F.col("ticode") == F.col("clcticketnum"), "left")
    ws = ws.join(rcpt.withColumnRenamed("rcbtransactnum", "__txn"), F.col("titransactnum") == F.col("__txn"), "left")
    return ws.select(*working_columns(group_by))


def published(ws: DataFrame) -> DataFrame:
    """The working set without internal helper columns."""
    return ws.drop(*[c for c in INTERNAL if c in ws.columns])
