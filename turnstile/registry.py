"""Registered queries: the staging products and operators instantiated on the
driver's tables (through :mod:`turnstile.sources.roles`).

Each entry is ``(spark, sf_dir) -> DataFrame``; money columns are returned
as DOUBLE so results compare with the DuckDB oracle.  All queries read whole
tables: the date window below (the staging jobs' own scope parameter) spans
every order date of the driver data (1995-2001), so no row is left out; the
inclusive-bound semantics are tested on the fixtures instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.functions.scalar import xml_attribute
from turnstile.operators.backfill import group_min_backfill
from turnstile.operators.batch import key_closure, number_batches
from turnstile.operators.identity import ClassMinima, renumbered
from turnstile.operators.lookup import sum_lookup
from turnstile.operators.schedule import activity_schedule, lookup_times, price_schedule
from turnstile.operators.scope import in_range, ticket_scope
from turnstile.plans import accounts as A
from turnstile.plans import changes
from turnstile.plans import products as P
from turnstile.plans.load import xml_batches
from turnstile.plans.staging import Staging
from turnstile.plans.sync import increment_bounds, record_counts, reformat
from turnstile.plans.working_set import (PAYMENT, TICKET, build_working_set, guided_scope, published, receipts_by_transaction,
                                         in_parts, with_backfills, working_set_parts, written_rows)
from turnstile.session import ensure_checkpoint_dir, materialize
from turnstile.sources.planned import equi_depth, parquet_fetch, planned_scan
from turnstile.sources.publish import Publication
from turnstile.sources.push_source import push
from turnstile.sources.roles import driver_sources

# Parameters of the driver instantiation.
LO = "1995-01-01 00:00:00"
HI = "2001-12-31 23:59:00"
HWM_PREV_HI = "1997-12-31 23:59:00"
HWM_NOW = "1998-06-30 23:59:00"
PROFILE = P.UserProfile(email_suffix="@crm.example", profile_id="PROFILE-01")

MONEY = {"tifullprice", "fees", "price", "amount"}

Query = Callable[[SparkSession, str], DataFrame]


def money_as_double(df: DataFrame) -> DataFrame:
    """Money as DOUBLE and the wide payment ids as text, for comparison."""
    shown = {**dict.fromkeys(MONEY, "double"), "paymentid": "string"}
    return df.select(*[F.col(c).cast(shown[c]).alias(c) if c in shown else F.col(c)
                       for c in df.columns])


_SOURCES: dict[tuple[int, str], dict[str, DataFrame]] = {}


def _src(spark: SparkSession, sf_dir: str):
    """The role source set, built once per session and folder (file listing
    and plan analysis of ~20 role frames is driver work worth doing once)."""
    key = (id(spark), sf_dir.rstrip("/"))
    if key not in _SOURCES or _SOURCES[key]["tickets"].sparkSession is not spark:
        _SOURCES[key] = driver_sources(spark, sf_dir)
    return _SOURCES[key]


def _ws(spark, sf_dir, group_by="show", payments=False):
    """Sources and working set; only ``payments`` need its internal columns."""
    src = _src(spark, sf_dir)
    return src, build_working_set(src, LO, HI, group_by=group_by, keep_internal=payments)


def _parts(spark, sf_dir, group_by="show"):
    """Sources and working set for roll-ups by contact."""
    src = _src(spark, sf_dir)
    return src, working_set_parts(src, LO, HI, group_by=group_by)


def q_contacts_semi(spark, sf_dir):
    src = _src(spark, sf_dir)
    return P.contacts(src, ticket_scope(src, LO, HI))


def q_dim_pricetypes(spark, sf_dir):
    src = _src(spark, sf_dir)
    return P.pricetypes(src, ticket_scope(src, LO, HI))


def q_dim_activities(spark, sf_dir):
    src = _src(spark, sf_dir)
    return P.activities(src, ticket_scope(src, LO, HI))


def q_ticket_scope(spark, sf_dir):
    src = _src(spark, sf_dir)
    return ticket_scope(src, LO, HI).select("ticode", "evcode", "eveventdate", "shcode", "tilcode",
                                            "timailinglist", "sfactiondate")


def q_guide_left_join(spark, sf_dir):
    src = _src(spark, sf_dir)
    return guided_scope(src, LO, HI).select("ticode", "guideid")


def q_first_match(spark, sf_dir):
    src = _src(spark, sf_dir)
    return receipts_by_transaction(src).select("rcbtransactnum", "ptdescr", "rcbshiftdate",
                                               "rcbcachinout")


def q_fees_lookup(spark, sf_dir):
    src = _src(spark, sf_dir)
    out = sum_lookup(src["tickets"].select("ticode"), "ticode", src["calculatedcommission"],
                     "clcticketnum", "clcsum", "fees")
    return money_as_double(out)


def q_group_min_backfill(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    d = o.select("o_orderkey", "o_custkey",
                 F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
                 F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("prio"))
    return group_min_backfill(d, "o_orderkey", ["o_custkey", "status"], {"prio": "5-LOW"}, "minkey")


def q_payment_backfill(spark, sf_dir):
    _, ws = _ws(spark, sf_dir)
    return money_as_double(ws.select("ticode", "timailinglist", "ptdescr", "rcbshiftdate",
                                     "rcbcachinout", "paymentid"))


def q_ids_across_runs(spark, sf_dir):
    """Two increments of tickets, the lower ids of all classes in the later one, with a kept table of class minima."""
    src = _src(spark, sf_dir)
    kept = ClassMinima(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/minima-{uuid.uuid4().hex}")
    late = F.col("ticode") % 8 < 4
    runs = [materialize(build_working_set({**src, "tickets": src["tickets"].filter(part)}, LO, HI, minima=kept, run_id=run)
                        .select("ticode", "minticode", "paymentid")) for run, part in (("first", ~late), ("second", late))]
    lowered, rows = materialize(kept.superseded()), runs[0].unionByName(runs[1])
    return money_as_double(renumbered(renumbered(rows, "minticode", lowered, TICKET), "paymentid", lowered, PAYMENT))


def q_staged_working_set(spark, sf_dir):
    """The working set from tables bucketed by transaction."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    staged = Staging(spark, path, f"staged_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    staged.write(_src(spark, sf_dir))
    rows = with_backfills(staged.joined_rows(LO, HI))
    staged.drop()  # the rows are written; the files stay with the checkpoint folder
    return money_as_double(rows)


def q_working_set(spark, sf_dir):
    _, ws = _ws(spark, sf_dir)
    return money_as_double(published(ws))


def q_ticket_rollup(spark, sf_dir):
    _, ws = _parts(spark, sf_dir)
    return money_as_double(P.tickets(ws))


def q_payment_rollup(spark, sf_dir):
    src, ws = _ws(spark, sf_dir, payments=True)
    return money_as_double(P.payments(ws, src, card_default=""))


def q_dump_working_set(spark, sf_dir):
    _, ws = _ws(spark, sf_dir, "event")
    return money_as_double(published(ws))


def q_dump_tickets(spark, sf_dir):
    _, ws = _parts(spark, sf_dir, "event")
    return money_as_double(P.tickets(ws, schedule_id="min_evcode"))


def q_dump_payments(spark, sf_dir):
    src, ws = _ws(spark, sf_dir, "event", payments=True)
    return money_as_double(P.payments(ws, src, card_default=None))


def _day_schedule(src, scope=None):
    acts = P.activities(src, ticket_scope(src, LO, HI) if scope is None else scope)
    return activity_schedule(src, LO, HI, activities=acts)


def q_range_lookup(spark, sf_dir):
    src, ws = _parts(spark, sf_dir, "event")
    # the working set has the scope's shows (it only adds rows of left joins), as in the day dump
    return money_as_double(P.tickets(ws, _day_schedule(src, ws.rows), schedule_id="range"))


def q_activity_schedule(spark, sf_dir):
    return activity_schedule(_src(spark, sf_dir), LO, HI)


def q_day_activity_schedule(spark, sf_dir):
    return _day_schedule(_src(spark, sf_dir))


def _scope_pricetypes(src):
    return P.pricetypes(src, ticket_scope(src, LO, HI)).select(F.col("pricetypeid").alias("pctcode"))


def q_price_schedule(spark, sf_dir):
    src = _src(spark, sf_dir)
    return money_as_double(price_schedule(src, _scope_pricetypes(src)))


def q_day_price_schedule(spark, sf_dir):
    src = _src(spark, sf_dir)
    return money_as_double(price_schedule(src, _scope_pricetypes(src), LO, HI))


def q_lookup_times(spark, sf_dir):
    return lookup_times(activity_schedule(_src(spark, sf_dir), LO, HI))


def q_users_union(spark, sf_dir):
    src = _src(spark, sf_dir)
    guided = guided_scope(src, LO, HI)  # guides and tills are all that users need of the working set
    return P.users(src, guided, guided, PROFILE)


def q_accounts_union(spark, sf_dir):
    return A.accounts(_src(spark, sf_dir), LO, HI)


def q_contacts_enriched(spark, sf_dir):
    src = _src(spark, sf_dir)
    return A.contacts_enriched(src, ticket_scope(src, LO, HI))


def q_orders_visit(spark, sf_dir):
    src = _src(spark, sf_dir)
    return A.orders(src, LO, HI, A.accounts(src, LO, HI))


def q_batch_number(spark, sf_dir):
    src = _src(spark, sf_dir)
    return number_batches(src["tickets"].select("ticode"), ["ticode"]).select("ticode", "rn", "batch_id")


def q_batch_key_closure(spark, sf_dir):
    src = _src(spark, sf_dir)
    return key_closure(src["tickets"].select("timailinglist", "ticode"), "timailinglist",
                       ["timailinglist", "ticode"])


def q_xml_payload(spark, sf_dir):
    src = _src(spark, sf_dir)
    return xml_batches(P.contacts(src, ticket_scope(src, LO, HI)), "contacts")


def q_xml_attribute(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    # urls with their characters written as references of every form, behind a commented-out attribute
    coded = F.col("url")
    for char, text in (("/", "&#47;"), (":", "&#x3A;"), (".", "&amp;#46;"), ("e", "&#x065;"), ("s", "&s;")):
        coded = F.replace(coded, F.lit(char), F.lit(text))
    tag = F.concat(F.lit('<!-- a t="no" --><a t="'), coded, F.lit('&#0;&#xD800;&#39;&#x27;&#128512;"/>'))
    return pages.select("page_id", xml_attribute("lang", F.col("html")).alias("lang"), xml_attribute("t", tag).alias("t"))


def _increment(spark, sf_dir):
    """Sources and working set of the incremental run after HWM_PREV_HI; the
    scope of the previous run holds its mark (later joins keep all its rows)."""
    src = _src(spark, sf_dir)
    lo, hi = increment_bounds(ticket_scope(src, LO, HWM_PREV_HI), HWM_NOW)
    return src, build_working_set(src, lo, hi, keep_internal=True, prune_to_scope=True)


def q_hwm_increment(spark, sf_dir):
    return money_as_double(published(_increment(spark, sf_dir)[1]))


def _increment_product(name: str) -> Query:
    def query(spark, sf_dir):
        src, ws = _increment(spark, sf_dir)
        return money_as_double(reformat(src, ws, incremental=True)[name])
    return query


def q_ticket_changes(spark, sf_dir):
    """What the tickets up to HWM_NOW have changed since those up to HWM_PREV_HI, by ticket id."""
    src = _src(spark, sf_dir)
    rows = written_rows(src, LO, HWM_NOW)  # the earlier run's rows are among them, its ids are its own
    runs = (in_parts(rows.filter(in_range("eveventdate", LO, hi))) for hi in (HWM_PREV_HI, HWM_NOW))
    before, now = (materialize(changes.snapshot(P.tickets(run), "tickid"), release=True) for run in runs)
    return (changes.changes(before, now).groupBy(F.col("key").alias("tickid"), "kind")
            .agg(F.sum("n").alias("n_rows")))


def q_planned_scan(spark, sf_dir):
    """Line items of more than 30 pieces, read in even splits of the order key with the condition at the store."""
    path = f"{sf_dir}/lineitem.parquet"
    lines = spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_quantity")
    ddl = ", ".join(f"{name} {kind}" for name, kind in lines.dtypes)
    rows = planned_scan(spark, parquet_fetch(path), ddl, "l_orderkey", equi_depth(lines, "l_orderkey", 8), "l_linenumber", [("l_quantity", ">", 30)])
    return rows.groupBy("l_linenumber").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").cast("double").alias("quantity"),
                                            F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"))


def q_published_dimensions(spark, sf_dir):
    """Dimensions published, replaced and appended to under one root, read back from a pinned version."""
    src = _src(spark, sf_dir)
    scope = materialize(ticket_scope(src, LO, HI).select("tipricetype", "shcode"))
    out = Publication(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}")
    prices, shows = P.pricetypes(src, scope), P.activities(src, scope)
    out.replace({"pricetypes": prices.filter("pricetypeid = 1"), "activities": shows, "scratch": prices})
    out.replace({"pricetypes": prices.filter("pricetypeid <= 2")}, drop=["scratch"])
    out.append({"pricetypes": prices.filter("pricetypeid > 2")})
    now = out.pin()
    named = [now.read(name).select(F.lit(name).alias("product"), F.col(key).alias("id"), "description")
             for name, key in (("pricetypes", "pricetypeid"), ("activities", "activityid")) if name in now.products]
    return named[0].unionByName(named[1])


def q_push_receipts(spark, sf_dir):
    """Receipts of the contacts' batches, pushed through the data source to a receiver that answers with their lengths."""
    src = _src(spark, sf_dir)
    bodies = xml_batches(P.contacts(src, ticket_scope(src, LO, HI)), "contacts")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/receipts-{uuid.uuid4().hex}"
    return push(bodies, "contacts", "/contacts", "run", folder, lambda endpoint, body, key: (200, f"{key} {len(body)}")).drop("attempts")


def q_record_counts(spark, sf_dir):
    src, ws = _ws(spark, sf_dir, payments=True)
    return record_counts(reformat(src, materialize(ws.drop("_txn_min_rcb")), LO, HI))  # the products need no receipt id


def q_xml_tickets(spark, sf_dir):
    _, ws = _parts(spark, sf_dir)
    return xml_batches(P.tickets(ws), "tickets")


def q_xml_payments(spark, sf_dir):
    src, ws = _ws(spark, sf_dir, payments=True)
    return xml_batches(P.payments(ws, src, card_default=""), "payments")


QUERIES: dict[str, Query] = {
    "contacts_semi": q_contacts_semi,
    "dim_pricetypes": q_dim_pricetypes,
    "dim_activities": q_dim_activities,
    "ticket_scope": q_ticket_scope,
    "guide_left_join": q_guide_left_join,
    "first_match": q_first_match,
    "fees_lookup": q_fees_lookup,
    "group_min_backfill": q_group_min_backfill,
    "payment_backfill": q_payment_backfill,
    "ids_across_runs": q_ids_across_runs,
    "working_set": q_working_set,
    "staged_working_set": q_staged_working_set,
    "ticket_rollup": q_ticket_rollup,
    "payment_rollup": q_payment_rollup,
    "dump_working_set": q_dump_working_set,
    "dump_tickets": q_dump_tickets,
    "dump_payments": q_dump_payments,
    "range_lookup": q_range_lookup,
    "activity_schedule": q_activity_schedule,
    "day_activity_schedule": q_day_activity_schedule,
    "price_schedule": q_price_schedule,
    "day_price_schedule": q_day_price_schedule,
    "lookup_times": q_lookup_times,
    "users_union": q_users_union,
    "accounts_union": q_accounts_union,
    "contacts_enriched": q_contacts_enriched,
    "orders_visit": q_orders_visit,
    "batch_number": q_batch_number,
    "batch_key_closure": q_batch_key_closure,
    "xml_payload": q_xml_payload,
    "xml_attribute": q_xml_attribute,
    "xml_tickets": q_xml_tickets,
    "xml_payments": q_xml_payments,
    "hwm_increment": q_hwm_increment,
    "hwm_contacts": _increment_product("contacts"),
    "hwm_tickets": _increment_product("tickets"),
    "hwm_payments": _increment_product("payments"),
    "record_counts": q_record_counts,
    "ticket_changes": q_ticket_changes,
    "published_dimensions": q_published_dimensions,
    "push_receipts": q_push_receipts,
    "planned_scan": q_planned_scan,
}
