"""CRM entity mapping, XML rows and batch envelopes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.scalar import xml_escape


@dataclass(frozen=True)
class Entity:
    name: str
    endpoint: str
    element: str
    key: str
    fields: tuple[tuple[str, str], ...]   # (product column, CRM field)


# CRM endpoints, XML element names, batch keys and field names
# of the three pushed products, in the order they are serialized.
ENTITIES: dict[str, Entity] = {
    "tickets": Entity(
        "tickets", "/services/apexrest/MultiTicket", "tickets", "tickid",
        (("tickid", "External_TicketID__c"), ("pricetypeid", "PriceType__c"),
         ("price", "Price__c"), ("evEventDate", "Date_Time__c"),
         ("Activity", "Activity__c"), ("userid", "User__c"), ("contactid", "Contact__c"),
         ("qty", "Quantity__c"), ("status", "Status__c"), ("guideid", "Guide__c"),
         ("fees", "Fees__c"), ("paymentid", "Payment__c"),
         ("last_transact_no", "Last_Transaction_No__c"))),
    "payments": Entity(
        "payments", "/services/apexrest/MultiPayment", "payments", "paymentid",
        (("paymentid", "External_Pay__c"), ("type", "Type__c"),
         ("trandate", "TransactionDate__c"), ("mode", "Mode__c"),
         ("last_transact_no", "Transaction_Number__c"), ("lastCardNum", "Card__c"),
         ("lastCardName", "Cardholder_Name__c"), ("amount", "Amount__c"))),
    "contacts": Entity(
        "contacts", "/services/apexrest/MultiContact", "contacts", "cltcode",
        (("cltcode", "ExternalCID__c"), ("cltfirstname", "FirstName"),
         ("cltSurName", "LastName"), ("cltEmail", "Email"))),
}


def entity(name: str) -> Entity:
    """Look an entity up by ``tickets`` or ``dbo.tickets``; unknown -> ValueError."""
    key = name.lower().removeprefix("dbo.")
    if key not in ENTITIES:
        raise ValueError(f"unknown entity {name!r}; expected one of {sorted(ENTITIES)}")
    return ENTITIES[key]


def xml_text(df: DataFrame, column: str) -> Column:
    """Text of a value as an XML serializer prints it: timestamps as
    ``yyyy-MM-ddTHH:mm:ss`` plus the stored fraction (three or six digits) when
    it is not zero, decimals in plain notation, doubles with all their digits."""
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        # whole milliseconds print three digits, finer fractions all six
        micros = F.regexp_replace(F.date_format(c, "SSSSSS"), "000$", "")
        return F.when(micros == F.lit("000"), whole).otherwise(F.concat(whole, F.lit("."), micros))
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.cast("string")  # every digit of the value; an exponent where it needs one
    return c.cast("string")


def to_xml_rows(df: DataFrame, element: str, fields: Sequence[tuple[str, str]],
                out: str = "xml") -> DataFrame:
    """``FOR XML PATH(element)`` per row: ``<element><F>v</F>...</element>``.

    NULL columns are omitted, empty strings give ``<F></F>``, ``& < >`` are
    escaped.  Built from ``concat_ws`` (which skips NULL fragments), so it is
    one codegen'd expression per row.  Numbers, dates and timestamps print no
    character that is escaped, so only the others are searched for them.
    """
    def content(c: str) -> Column:
        text = xml_text(df, c)
        return text if isinstance(df.schema[c].dataType, (T.NumericType, T.DatetimeType, T.BooleanType)) else xml_escape(text)

    parts = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{f}>"), content(c), F.lit(f"</{f}>"))) for c, f in fields]
    body = F.concat(F.lit(f"<{element}>"), F.concat_ws("", *parts), F.lit(f"</{element}>"))
    return df.withColumn(out, body)


def batch_envelope(rows: DataFrame, batch: str = "batch_id", order: str = "rn",
                   xml: str = "xml") -> DataFrame:
    """One request body per batch: ``<request><req>rows in order</req></request>``.

    A batch holds at most the batch size rows (exact batching), so the
    per-group list is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(xml).alias("x"))))
    return (rows.groupBy(batch)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.array_join(F.transform(ordered, lambda s: s["x"]), "").alias("__inner"))
            .select(F.col(batch).alias("batch_id"), "n_rows",
                    F.concat(F.lit("<request><req>"), F.col("__inner"),
                             F.lit("</req></request>")).alias("body")))
