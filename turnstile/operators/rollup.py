"""Ticket and payment roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import label, mask_card, xml_attribute, zero_to_null
from turnstile.session import materialize

TICKET_GROUP_KEYS = ["minticode", "tipricetype", "tifullprice", "eveventdate", "shcode",
                     "tilcode", "timailinglist", "tistatus", "guideid", "fees", "paymentid"]

PAYMENT_GROUP_KEYS = ["paymentid", "timailinglist", "ptdescr", "rcbshiftdate", "rcbcachinout"]

# Guide ids are published with this offset; status and mode labels.
GUIDE_ID_OFFSET = 1000
RETURN_STATUS = 9
REFUND_FLAG = 1


def ticket_rollup(ws: DataFrame, schedule_id: str | None = None) -> DataFrame:
    """One row per canonical ticket and price/date/show/till/contact/status/
    guide/fees/payment: ``qty`` = rows, ``last_transact_no`` = max transaction.

    NULL group keys form their own groups.  ``schedule_id="min_evcode"`` adds
    ``activityscheduleid = min(evcode)`` (full-dump form); the day-dump form
    is :func:`turnstile.operators.lookup.range_lookup` applied on the result.
    Partial aggregation runs before the shuffle, so the many rows sharing
    ticket id 0 collapse per task.
    """
    aggs = [F.count(F.lit(1)).alias("qty"),
            F.max("titransactnum").alias("last_transact_no")]
    if schedule_id == "min_evcode":
        aggs.append(F.min("evcode").alias("activityscheduleid"))
    elif schedule_id is not None:
        raise ValueError(f"unknown schedule_id {schedule_id!r}")
    g = ws.groupBy(*TICKET_GROUP_KEYS).agg(*aggs)
    cols = [F.col("minticode").alias("tickid")]
    if schedule_id == "min_evcode":
        cols.append(F.col("activityscheduleid"))
    cols += [
        F.col("tipricetype").alias("pricetypeid"),
        F.col("tifullprice").alias("price"),
        F.col("eveventdate").alias("evEventDate"),
        F.col("shcode").alias("Activity"),
        F.col("tilcode").alias("userid"),
        F.col("timailinglist").alias("contactid"),
        F.col("qty"),
        label("tistatus", RETURN_STATUS, "Return", "Sale").alias("status"),
        (F.col("guideid") + GUIDE_ID_OFFSET).alias("guideid"),
        F.col("fees"),
        zero_to_null("paymentid").alias("paymentid"),
        F.col("last_transact_no"),
    ]
    return g.select(*cols)


def payment_amounts(rows: DataFrame, txn_amount: str = "_txn_amount") -> DataFrame:
    """Per payment id, the sum of the receipts of the *set* of its
    transactions (a transaction shared by several tickets counts once).

    ``rows`` has ``paymentid``, ``titransactnum`` and ``txn_amount`` -- the
    per-transaction receipt total -- e.g. working-set rows or their
    per-transaction aggregate; the distinct (payment, transaction) pairs are
    summed.
    """
    return (rows.filter(F.col("paymentid") > 0)
            .select("paymentid", "titransactnum", txn_amount).distinct()
            .groupBy("paymentid").agg(F.sum(txn_amount).alias("amount")))


def card_lookup(credit: DataFrame, card_default: str | None) -> DataFrame:
    """Per receipt id: max card number (over ``isnull(n, card_default)`` when a
    default is given) and max card-holder name from the XML parameters."""
    num = F.col("rcccreditnum")
    if card_default is not None:
        num = F.coalesce(num, F.lit(card_default))
    return (credit.groupBy("rcccode")
            .agg(F.max(num).alias("lastCardNum"),
                 F.max(xml_attribute("card_name", F.col("rccparamsdata"))).alias("lastCardName")))


def payment_rollup(ws: DataFrame | Sequence[DataFrame], credit: DataFrame, card_default: str | None = "",
                   txn_amount: str = "_txn_amount", mask: bool = False,
                   prune_cards: bool = False) -> DataFrame:
    """Payments: one row per (payment id, contact, pay type, shift date,
    cash-in/out) with ``paymentid > 0``; contact is grouped on but not output,
    so a payment id can repeat.

    The original job left-joins the receipt-credit rows *before* grouping; since
    those rows depend only on the payment id (a group key) and are only read
    through MAX, they are aggregated per receipt id and joined to the much
    smaller grouped result.  ``prune_cards=True`` (incremental runs) first
    semi-joins the card rows to the payment ids: a small id set is broadcast
    by AQE, so only the card rows of this run's payments are read past the
    scan.  ``card_default=""`` is the procedure form
    (``max(isnull(num, ''))``), ``None`` the dump form (NULL without a card).
    ``mask=True`` publishes only the last four digits of the card number.
    ``ws`` may come in parts of different contacts.
    """
    parts = [part.filter(F.col("paymentid") > 0) for part in ([ws] if isinstance(ws, DataFrame) else ws)]
    # one pass over the working set: per payment group and transaction (the
    # transaction total is a function of the transaction); the grouped
    # payments and the amounts are both derived from this smaller frame,
    # whose shuffle output Spark reuses for the two
    per_txn = reduce(DataFrame.unionByName, [p.groupBy(*PAYMENT_GROUP_KEYS, "titransactnum").agg(
        F.max(txn_amount).alias("__amt")) for p in parts])
    if len(parts) > 1:  # dealt by contact each, which is no shuffle of this frame: both readers would deal all rows again
        per_txn = materialize(per_txn, release=True)
    p = reduce(DataFrame.unionByName, parts)
    g = per_txn.groupBy(*PAYMENT_GROUP_KEYS).agg(
        F.max("titransactnum").alias("last_transact_no"))
    if prune_cards:
        ids = p.select(F.col("paymentid").alias("__pid")).distinct()
        credit = credit.join(ids, F.col("rcccode") == F.col("__pid"), "left_semi")
    cards = card_lookup(credit, card_default)
    amounts = payment_amounts(per_txn, "__amt").withColumnRenamed("paymentid", "__amt_pid")
    j = (g.join(cards, F.col("paymentid") == F.col("rcccode"), "left")
         .join(amounts, F.col("paymentid") == F.col("__amt_pid"), "left"))
    card_num: Column = F.col("lastCardNum")
    if card_default is not None:
        card_num = F.coalesce(card_num, F.lit(card_default))
    if mask:
        card_num = mask_card(card_num)
    return j.select(
        "paymentid",
        F.col("ptdescr").alias("type"),
        F.col("rcbshiftdate").alias("trandate"),
        label("rcbcachinout", REFUND_FLAG, "Refund", "Receipt").alias("mode"),
        "last_transact_no",
        card_num.alias("lastCardNum"),
        "lastCardName",
        "amount",
    )
