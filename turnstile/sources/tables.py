"""Table scans.

A *source set* is a plain ``dict[str, DataFrame]`` keyed by lower-case
ticketing table name.  Every operator reads from it, so tables may come from
Parquet folders, a catalog, or a JDBC database (the cross-database scans of
the original jobs are simply entries loaded from a second location).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.sources.schemas import SOURCE_SCHEMAS


def load_parquet(spark: SparkSession, root: str, names: Iterable[str],
                 schemas: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Read ``root/<name>.parquet`` (file or folder) for each name.

    With a schema the read skips inference and column pruning / filter
    pushdown reach the Parquet reader as usual.
    """
    schemas = dict(SOURCE_SCHEMAS if schemas is None else schemas)
    out = {}
    for name in names:
        reader = spark.read
        if name in schemas:
            reader = reader.schema(schemas[name])
        out[name] = reader.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return out


def load_catalog(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """``{name: "catalog.db.table"}`` -> DataFrames (cross-database scan, S2)."""
    return {name: spark.table(qualified) for name, qualified in names.items()}


def load_jdbc(spark: SparkSession, url: str, table: str, *, properties: Mapping[str, str],
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC scan of one operational table.

    ``partition_column`` (an integer id such as ``ticode``) splits the scan
    into ``num_partitions`` range queries so one executor does not pull the
    whole table.  Filters and projections applied later are pushed into the
    generated SQL by Spark's JDBC source.  Credentials come from the caller.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC scans need bounds and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def with_collation(src: Mapping[str, DataFrame], columns: Mapping[str, Iterable[str]],
                   collation: str = "UTF8_LCASE_RTRIM") -> dict[str, DataFrame]:
    """Source set whose listed string columns carry ``collation`` (default:
    binary).  Use it when the operational database compares text keys
    case-insensitively, so ``'Cash'`` and ``'CASH '`` match in the id
    backfills and group together in the roll-ups."""
    from turnstile.functions.scalar import collated

    out = dict(src)
    for table, cols in columns.items():
        cols = set(c.lower() for c in cols)
        df = out[table]
        out[table] = df.select(*[collated(c, collation).alias(c) if c.lower() in cols else F.col(c)
                                 for c in df.columns])
    return out
