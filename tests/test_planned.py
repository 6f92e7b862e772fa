import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from turnstile.sources.planned import equi_depth, parquet_fetch, planned_scan

SCHEMA = "id bigint, other bigint, v string"


@pytest.fixture(scope="module")
def table(tmp_path_factory):
    rng = random.Random(3)
    ids = [7] * 4000 + [rng.randint(0, 100) for _ in range(3000)] + [rng.randint(10**6, 10**12) for _ in range(3000)] + [None] * 50
    rng.shuffle(ids)
    path = str(tmp_path_factory.mktemp("planned") / "t.parquet")
    pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "other": pa.array(range(len(ids)), pa.int64()),
                             "v": [f"v{i % 13}" for i in range(len(ids))]}), path, row_group_size=500)
    return path


@pytest.fixture()
def scan(spark, table):
    splits = equi_depth(spark.read.parquet(table), "id", 10)
    return planned_scan(spark, parquet_fetch(table), SCHEMA, "id", splits, "other")


def test_a_skewed_id_gives_even_splits(spark, table, scan):
    per_task = [r["n"] for r in scan.filter("id is not null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 10000 and max(per_task) <= 1500  # an even share is 1000; ranges of equal steps would give one task 7000
    assert scan.count() == 10050
    assert scan.exceptAll(spark.read.parquet(table)).isEmpty()


def test_one_split_and_no_rows(spark, table):
    frame = spark.read.parquet(table)
    assert equi_depth(frame, "id", 1) == [(None, None, 1)] and equi_depth(frame.limit(0), "id", 5) == [(None, None, 1)]
    one = planned_scan(spark, parquet_fetch(table), SCHEMA, "id", [(None, None, 1)])
    assert one.count() == 10050 and one.rdd.getNumPartitions() == 2


CONDITIONS = {"id = 7": [("id", "=", 7)], "id < 7": [("id", "<", 7)], "id <= 6": [("id", "<=", 6)], "id > 1000000": [("id", ">", 10**6)],
              "id >= 10000000 and v = 'v3'": [("id", ">=", 10**7), ("v", "=", "v3")], "id in (1, 2, 7, 10)": [("id", "in", [1, 2, 7, 10])],
              "id is null": [("id", "is null", None)], "id is not null": [("id", "is not null", None)], "v = 'v1'": [("v", "=", "v1")], "id = -1": [("id", "=", -1)],
              "id > 5 and id < 7": [("id", ">", 5), ("id", "<", 7)], "true": []}


@pytest.mark.parametrize("condition", CONDITIONS)
def test_conditions_reach_the_store(spark, table, condition):
    frame = spark.read.parquet(table)
    got = planned_scan(spark, parquet_fetch(table), SCHEMA, "id", equi_depth(frame, "id", 6), "other", CONDITIONS[condition])
    want = sorted(map(str, frame.filter(condition).collect()))
    assert sorted(map(str, got.collect())) == want
    assert sorted(map(str, got.select("v").collect())) == sorted(map(str, frame.filter(condition).select("v").collect()))


def test_splits_that_a_filter_rules_out_are_not_read(spark, table):
    log = table + ".log"
    inner = parquet_fetch(table)

    def fetch(conditions, columns, log=log, inner=inner):
        with open(log, "a") as f:
            f.write(f"{conditions} {columns}\n")
        yield from inner(conditions, columns)

    rows = planned_scan(spark, fetch, SCHEMA, "id", [(None, 7, 1), (7, 8, 4), (8, 10**6, 1), (10**6, None, 1)], "other", [("id", ">", 100), ("v", "=", "v1")])
    assert len(rows.collect()) > 0
    lines = open(log).read().splitlines()
    assert len(lines) == 2 and all("('v', '=', 'v1')" in x and "('id', '>', 100)" in x for x in lines)
