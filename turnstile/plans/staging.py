"""Co-located staging (J1, J3, J10, J11): tickets, receipts, commissions and guides bucketed by transaction.

Dumps, increments and account jobs join the same tables on the same keys again and
again.  Staged once, as tables bucketed and sorted by the transaction (to
which each ticket belongs, so commissions and guides get their ticket's), they
are joined bucket by bucket: the working set's rows need no exchange.

Sold tickets carry what the scope takes from events, shows, shifts and tills;
receipts carry their pay type's text.  Tables are external, below a folder of the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.operators.scope import in_range, ticket_scope
from turnstile.plans.working_set import working_columns

KEY = "titransactnum"
#: the whole range of timestamps
ALWAYS = ("0001-01-01 00:00:00", "9999-12-31 23:59:59.999999")
#: joins on the bucket key and more of two tables with the same buckets need no exchange
_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true",
         "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


def tables(src: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The staged tables' rows, each with the transaction as its key."""
    sold = ticket_scope(src, *ALWAYS)
    owner = src["tickets"].select(F.col("ticode").alias("__t"), F.col("tiorder").alias("__o"), KEY).distinct()
    types = src["paytype"].groupBy(F.col("ptcode").alias("__pc")).agg(F.min("ptdescr").alias("ptdescr"))
    receipts = src["recieptbase"].join(types, F.col("rcbpaytype") == F.col("__pc"), "left").select(
        F.col("rcbtransactnum").alias(KEY), "rcbcode", F.col("__pc").isNotNull().alias("rcbtyped"), "ptdescr", "rcbshiftdate", "rcbcachinout", "rcbpayamount")
    fees = src["calculatedcommission"].join(owner.select("__t", KEY).distinct(), F.col("clcticketnum") == F.col("__t")).select(KEY, "clcticketnum", "clcsum")
    guides = src["get_orderguides"].join(owner, (F.col("gogticketid") == F.col("__t")) & (F.col("gogordernumber") == F.col("__o"))).select(
        KEY, "gogordernumber", "gogticketid", F.col("gogguidenumber").alias("guideid"))
    return {"tickets": sold, "receipts": receipts, "commissions": fees, "guides": guides}


class Staging:
    """Staged tables ``<prefix>_<name>`` of the session's catalog, with their files below ``path``."""

    def __init__(self, spark: SparkSession, path: str, prefix: str, buckets: int):
        self.spark, self.path, self.prefix, self.buckets = spark, path.rstrip("/"), prefix, buckets

    def _name(self, table: str) -> str:
        return f"{self.prefix}_{table}"

    def write(self, src: Mapping[str, DataFrame]) -> None:
        """Stage the sources, in place of what was staged under the prefix."""
        for table, rows in tables(src).items():
            # one file a bucket, so that its order is known too
            (rows.repartition(self.buckets, KEY).write.mode("overwrite").option("path", f"{self.path}/{table}")
             .bucketBy(self.buckets, KEY).sortBy(KEY).saveAsTable(self._name(table)))

    def read(self, table: str) -> DataFrame:
        for name, value in _CONF.items():
            self.spark.conf.set(name, value)
        return self.spark.table(self._name(table))

    def drop(self) -> None:
        for table in ("tickets", "receipts", "commissions", "guides"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")

    def joined_rows(self, lo, hi, group_by: str = "show") -> DataFrame:
        """The working set's rows before the two id backfills, as from the sources."""
        rows = self.read("tickets").filter(in_range("eveventdate", lo, hi))
        guides = self.read("guides").withColumnRenamed(KEY, "__g")
        rows = rows.join(guides, (F.col(KEY) == F.col("__g")) & (F.col("tiorder") == F.col("gogordernumber")) & (F.col("ticode") == F.col("gogticketid")), "left")
        first = F.when(F.col("rcbtyped"), F.col("rcbcode"))
        paid = self.read("receipts").groupBy(F.col(KEY).alias("__r")).agg(
            F.min_by("ptdescr", first).alias("ptdescr"), F.min_by("rcbshiftdate", "rcbcode").alias("rcbshiftdate"),
            F.min_by("rcbcachinout", "rcbcode").alias("rcbcachinout"), F.min("rcbcode").alias("_txn_min_rcb"), F.sum("rcbpayamount").alias("_txn_amount"))
        rows = rows.join(paid, F.col(KEY) == F.col("__r"), "left")
        fees = self.read("commissions").groupBy(F.col(KEY).alias("__c"), "clcticketnum").agg(F.sum("clcsum").alias("fees"))
        rows = rows.join(fees, (F.col(KEY) == F.col("__c")) & (F.col("ticode") == F.col("clcticketnum")), "left")
        return rows.select(*working_columns(group_by))
