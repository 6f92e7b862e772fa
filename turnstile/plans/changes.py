"""What a product's rows have changed since the last accepted ones.

A row is known by its entity's key and a 128-bit digest of all its columns;
a snapshot counts such rows, since products may hold equal ones.  Comparing two
snapshots is one outer join on key and digest, so a key that holds a third of
all rows (ticket id 0) is dealt out by its digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows of a key that was not there; other rows of a key that was; rows that other ones took
#: the place of; rows of a key that is gone
INSERT, CHANGE, REPLACED, TOMBSTONE = "insert", "change", "replaced", "tombstone"
SNAPSHOT = "key string, d1 bigint, d2 bigint, n bigint"


def _digest(df: DataFrame) -> tuple[Column, Column]:
    content = [c for name in sorted(df.columns) for c in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(*content), F.xxhash64(F.lit("second"), *content)


def _marked(product: DataFrame, key: str) -> DataFrame:
    d1, d2 = _digest(product)
    return product.select("*", F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"), d1.alias("__d1"), d2.alias("__d2"))


def snapshot(product: DataFrame, key: str) -> DataFrame:
    """(key, d1, d2, n): how often each row occurs."""
    return (_marked(product, key).groupBy(F.col("__key").alias("key"), F.col("__d1").alias("d1"), F.col("__d2").alias("d2"))
            .agg(F.count("*").alias("n")))


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(key, d1, d2, kind, n) from two snapshots; rows that both have are left out."""
    keys = ["key", "d1", "d2"]
    old = before.groupBy(*keys).agg(F.sum("n").alias("__old"))
    new = now.groupBy(*keys).agg(F.sum("n").alias("__new"))
    both = old.join(new, keys, "full").withColumn("__d", F.coalesce("__new", F.lit(0)) - F.coalesce("__old", F.lit(0)))
    held = (before.select("key", F.lit(1).alias("__was"), F.lit(0).alias("__is"))
            .union(now.select("key", F.lit(0), F.lit(1))).groupBy("key").agg(F.max("__was").alias("__was"), F.max("__is").alias("__is")))
    kind = (F.when((F.col("__d") > 0) & (F.col("__was") == 0), INSERT).when(F.col("__d") > 0, CHANGE)
            .when(F.col("__is") == 1, REPLACED).otherwise(TOMBSTONE))
    return both.filter("__d <> 0").join(held, "key").select(*keys, kind.alias("kind"), F.abs("__d").alias("n"))


def unsent(product: DataFrame, key: str, accepted: DataFrame) -> DataFrame:
    """The product's rows that are not among the accepted ones (a snapshot); of equal rows as many as are new."""
    known = accepted.groupBy("key", "d1", "d2").agg(F.sum("n").alias("__known"))
    fresh = snapshot(product, key).join(known, ["key", "d1", "d2"], "left").withColumn("__more", F.col("n") - F.coalesce("__known", F.lit(0)))
    fresh = fresh.filter("__more > 0").select(F.col("key").alias("__fk"), F.col("d1").alias("__f1"), F.col("d2").alias("__f2"), "__more", F.col("n").alias("__have"))
    marked = _marked(product, key)
    met = marked.join(fresh, (F.col("__key") == F.col("__fk")) & (F.col("__d1") == F.col("__f1")) & (F.col("__d2") == F.col("__f2")))
    # equal rows are one row and their number, so that some of them can be taken
    whole, some = met.filter("__more = __have").select(product.columns), met.filter("__more < __have")
    each = some.dropDuplicates(["__key", "__d1", "__d2"]).withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__more"))))
    return whole.unionByName(each.select(product.columns))
