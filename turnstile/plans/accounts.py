"""Account/contact/order model (D11-D13; P7, J9, J10, J14, J15, J18, U1, U2).

Named clients (first name not blank) and blank-name clients are handled in
two branches; a NULL first name is neither blank nor not-blank, so such
clients appear in neither branch -- as in the scripts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import is_blank, is_not_blank, mmddyyyy
from turnstile.operators.lookup import first_by_key
from turnstile.operators.scope import in_range, referenced_rows
from turnstile.sources.schemas import ADDRESS_COLUMNS


def mailing_addresses(src: Mapping[str, DataFrame]) -> DataFrame:
    """(client, six address columns) for mailing addresses only.

    The mailing flag sits in the ON clause of an outer join, so it filters
    the address side *before* the join -- a client without a mailing
    address keeps its row with NULL address columns."""
    links = src["clientaddresses"].filter(F.col("claisformailing") == 1)
    return (links.join(src["addresses"], F.col("claaddresscode") == F.col("adrcode"), "left")
            .select(F.col("claclientcode").alias("__acl"), *ADDRESS_COLUMNS))


def first_phones(src: Mapping[str, DataFrame]) -> DataFrame:
    """Per client its first phone number (TOP 1 made deterministic: the
    smallest number)."""
    return first_by_key(src["clientphonenumbers"], "cpnclientcode", ["cpnphonenumber"],
                        {"phone": "cpnphonenumber"}).withColumnRenamed("cpnclientcode", "__pcl")


def _with_address(df: DataFrame, src: Mapping[str, DataFrame]) -> DataFrame:
    return (df.join(mailing_addresses(src), F.col("cltcode") == F.col("__acl"), "left")
            .drop("__acl"))


def _with_phone(df: DataFrame, src: Mapping[str, DataFrame]) -> DataFrame:
    return df.join(first_phones(src), F.col("cltcode") == F.col("__pcl"), "left").drop("__pcl")


def _client_tickets(src: Mapping[str, DataFrame], lo, hi) -> DataFrame:
    """Tickets of the window with their client: the window is applied first, so
    only its tickets are shuffled on the contact."""
    events = src["events"].filter(in_range("eveventdate", lo, hi)).select("evcode", "eveventdate")
    return (events
            .join(src["tickets"].select("timailinglist", "tievent", "tishift", "tiorder"),
                  F.col("tievent") == F.col("evcode"))
            .join(src["clients"], F.col("timailinglist") == F.col("cltcode")))


def accounts(src: Mapping[str, DataFrame], lo, hi, with_id_kind: bool = False) -> DataFrame:
    """``recid, cltEmail, orcfullname, <address>, phone``.

    Named branch: one row per (client, e-mail, order-contact name, address)
    with ``recid`` the lowest order-contact record.  Blank branch: the
    client's own code as ``recid`` and surname as ``orcfullname``; the order
    contacts only have to exist.  The UNION removes duplicates.  No shift
    filter here (wider scope than the orders product).

    ``recid`` mixes two id spaces (order-contact records and client codes);
    ``with_id_kind=True`` adds ``id_kind`` ('order_contact' / 'client') so a
    consumer can tell them apart.  The default output is the original one.
    """
    base = _client_tickets(src, lo, hi)
    oc = src["ordercontacts"]
    named = (base.filter(is_not_blank("cltfirstname"))
             .join(oc, F.col("orcordernumber") == F.col("tiorder")))
    named = _with_address(named, src)
    named = (named.groupBy("cltcode", "cltemail", "orcfullname", *ADDRESS_COLUMNS)
             .agg(F.min("orcrecordid").alias("recid")))
    named = _with_phone(named, src).select(
        "recid", F.col("cltemail").alias("cltEmail"), "orcfullname", *ADDRESS_COLUMNS, "phone",
        *([F.lit("order_contact").alias("id_kind")] if with_id_kind else []))
    blank = base.filter(is_blank("cltfirstname"))
    blank = blank.join(oc.select("orcordernumber"),
                       F.col("tiorder") == F.col("orcordernumber"), "left_semi")
    blank = _with_address(blank, src)
    blank = blank.select("cltcode", "cltsurname", "cltemail", *ADDRESS_COLUMNS).distinct()
    blank = _with_phone(blank, src).select(
        F.col("cltcode").alias("recid"), F.col("cltemail").alias("cltEmail"),
        F.col("cltsurname").alias("orcfullname"), *ADDRESS_COLUMNS, "phone",
        *([F.lit("client").alias("id_kind")] if with_id_kind else []))
    return named.union(blank).distinct()


def contacts_enriched(src: Mapping[str, DataFrame], scope: DataFrame) -> DataFrame:
    """Named clients referenced by an in-scope ticket, with mailing
    address (one row per mailing address) and first phone."""
    named_scope = scope.join(
        src["clients"].filter(is_not_blank("cltfirstname")).select(F.col("cltcode").alias("__nc")),
        F.col("timailinglist") == F.col("__nc"), "left_semi")
    clients = referenced_rows(src["clients"], "cltcode", named_scope, "timailinglist")
    out = _with_phone(_with_address(clients, src), src)
    return out.select("cltcode", "cltfirstname", F.col("cltsurname").alias("cltSurName"),
                      F.col("cltemail").alias("cltEmail"), *ADDRESS_COLUMNS, "phone")


def orders(src: Mapping[str, DataFrame], lo, hi, account_product: DataFrame) -> DataFrame:
    """``ordernumber, accountid, billingcontactid, visitdate, orderstartdate``.

    Named branch joins the order contacts to the *accounts product* on
    ``orcrecordid = recid`` (so only an account's lowest record id joins);
    blank branch uses the client as account and 0 as billing contact.
    Dates are ``MM/dd/yyyy`` of the earliest event / shift date.
    """
    shifts = src["shifts"].filter(F.col("sfactiontype") == 0).select("sfcode", "sfactiondate")
    base = _client_tickets(src, lo, hi).join(shifts, F.col("tishift") == F.col("sfcode"))
    accts = account_product.select(F.col("recid").alias("__recid")).distinct()
    named = (base.filter(is_not_blank("cltfirstname"))
             .join(src["ordercontacts"].select("orcordernumber", "orcrecordid"),
                   F.col("orcordernumber") == F.col("tiorder"))
             .join(accts, F.col("orcrecordid") == F.col("__recid"))
             .groupBy("tiorder", "__recid", "cltcode")
             .agg(F.min("eveventdate").alias("__v"), F.min("sfactiondate").alias("__s"))
             .select(F.col("tiorder").alias("ordernumber"), F.col("__recid").alias("accountid"),
                     F.col("cltcode").alias("billingcontactid"),
                     mmddyyyy("__v").alias("visitdate"), mmddyyyy("__s").alias("orderstartdate")))
    blank = (base.filter(is_blank("cltfirstname"))
             .groupBy("tiorder", "cltcode")
             .agg(F.min("eveventdate").alias("__v"), F.min("sfactiondate").alias("__s"))
             .select(F.col("tiorder").alias("ordernumber"), F.col("cltcode").alias("accountid"),
                     F.lit(0).cast("bigint").alias("billingcontactid"),
                     mmddyyyy("__v").alias("visitdate"), mmddyyyy("__s").alias("orderstartdate")))
    return named.union(blank).distinct()
