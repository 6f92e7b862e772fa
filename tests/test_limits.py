"""Values that once were cut or wrapped."""
from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException

from turnstile.functions.scalar import xml_attribute, xml_escape
from turnstile.operators.backfill import group_min_backfill
from turnstile.operators.lookup import sum_by_key
from turnstile.operators.xml import to_xml_rows
from turnstile.plans.sync import _latest_state


def test_sums_beyond_a_long_and_with_ten_digits(spark):
    big = spark.sql("SELECT 1 AS k, CAST(900000000000000 AS decimal(19,4)) AS v FROM range(3)")
    assert sum_by_key(big, "k", "v", "s").first()["s"] == Decimal("2700000000000000.0000")
    fine = spark.sql("SELECT 1 AS k, CAST(0.1234567891 AS decimal(19,10)) AS v FROM range(3)")
    assert sum_by_key(fine, "k", "v", "s").first()["s"] == Decimal("0.3703703673")


def test_xml_keeps_digits_fractions_and_carriage_returns(spark):
    df = spark.sql("SELECT 1e-12D AS d, timestamp_ntz'2020-01-02 03:04:05.123456' AS t, "
                   "timestamp_ntz'2020-01-02 03:04:05.120' AS m, 'a\\rb' AS s")
    xml = to_xml_rows(df, "r", [("d", "D"), ("t", "T"), ("m", "M")]).first()["xml"]
    assert "<D>1.0E-12</D>" in xml and "05.123456<" in xml and "05.120<" in xml
    assert df.select(xml_escape("s")).first()[0] == "a&#xD;b"


def test_attribute_in_single_quotes(spark):
    df = spark.createDataFrame([("<p card='A &amp; B'/>",), ('<p card="x"/>',), ("<p card=''/>",)], "x string")
    assert [r[0] for r in df.select(xml_attribute("card", "x")).collect()] == ["A & B", "x", None]


def test_damaged_run_log_raises_and_absent_one_does_not(spark, scratch):
    import os

    assert _latest_state(spark, f"{scratch}/none") is None
    os.makedirs(f"{scratch}/state/_runs")
    with pytest.raises(AnalysisException):
        _latest_state(spark, f"{scratch}/state")


def test_backfill_is_one_join_of_all_rows(spark):
    df = spark.createDataFrame([(3, 1, None), (2, 1, 0), (5, None, 7), (6, None, 7)], "v long, k long, s long")
    out = group_min_backfill(df, "v", ["k"], {"s": 0})
    assert sorted((r["v"], r["minticode"]) for r in out.collect()) == [(2, 2), (3, 2), (5, 0), (6, 0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join") == 1


def test_control_characters_in_xml(spark):
    df = spark.sql("SELECT concat('a', char(1), 'b', char(9), 'c') AS s")
    assert df.select(xml_escape("s")).first()[0] == "a�b\tc"


def test_range_lookup_equals_brute_force(spark):
    import datetime as dt
    import random

    from turnstile.operators.lookup import range_lookup

    rnd = random.Random(5)
    day = lambda: dt.datetime(2000, 1, 1) + dt.timedelta(hours=rnd.randrange(-9000, 9000))
    table = [(rnd.choice([1, 2, None]), *sorted((day(), day())), rnd.choice([None, *range(1, 60)])) for _ in range(150)]
    table += [(1, day(), None, 0), (1, None, day(), 0), (1, dt.datetime(2001, 1, 1), dt.datetime(2000, 1, 1), 0)]
    left = [(rnd.choice([1, 2, 3, None]), day()) for _ in range(300)] + [(1, None)]
    left += [(k, s) for k, s, _, _ in table[:40]] + [(k, e) for k, _, e, _ in table[:40]]
    types = "k long, s timestamp_ntz, e timestamp_ntz, v long"
    out = range_lookup(spark.createDataFrame(left, "lk long, lt timestamp_ntz"), "lk", "lt",
                       spark.createDataFrame(table, types), "k", "s", "e", "v", "hit")

    def brute(k, t):
        hits = [v for tk, s, e, v in table if None not in (k, t, s, e, v) and tk == k and s <= t <= e]
        return min(hits, default=None)

    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr((k, t, brute(k, t))) for k, t in left)


def test_row_numbers_use_few_partitions_for_few_rows(spark):
    from turnstile.operators.batch import number_rows

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        rows = number_rows(spark.range(1000).selectExpr("999 - id AS k"), ["k"])
        assert rows.rdd.getNumPartitions() < 20
        assert [(r["k"], r["rn"]) for r in rows.orderBy("k").collect()] == [(i, i + 1) for i in range(1000)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
