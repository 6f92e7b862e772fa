"""Steps whose cost once grew too fast: what their plans must not hold again."""
from __future__ import annotations

import re

import pytest

from tests.fixtures import HI, LO, ROWS
from turnstile.operators.identity import ClassMinima
from turnstile.plans.working_set import build_working_set, joined_rows, observed_classes
from turnstile.sources.schemas import SOURCE_SCHEMAS
from turnstile.streaming import minima_stream


def test_stream_minima_call_no_python_per_class(spark, src, scratch):
    spark.createDataFrame(ROWS["tickets"], SOURCE_SCHEMAS["tickets"]).write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(SOURCE_SCHEMAS["tickets"]).parquet(f"{scratch}/in")
    found = minima_stream.changes(joined_rows({**src, "tickets": stream}, LO, HI))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert found.isStreaming and "Aggregate" in plan
    assert "TransformWithState" not in plan and "InArrow" not in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_guides_and_fees_share_one_exchange_of_the_rows(src, no_broadcast):
    plan = _plan(joined_rows(src, LO, HI))
    assert plan.count("hashpartitioning(ticode") == 1 and "hashpartitioning(tiorder" not in plan


def test_backfilled_rows_are_dealt_by_their_own_keys_and_a_salt(src, no_broadcast):
    plan = _plan(build_working_set(src, LO, HI))
    for i, key in enumerate(("tipricetype", "timailinglist")):
        assert re.search(rf"hashpartitioning\(__s{i}#\d+L, {key}#", plan)


def test_ids_of_several_guides_and_of_other_orders(spark, src):
    from turnstile.plans.working_set import with_guides

    scope = spark.createDataFrame([(1, 10), (1, 11), (2, None), (None, 10)], "ticode long, tiorder long")
    guides = spark.createDataFrame([(10, 1, 7), (10, 1, 8), (12, 1, 9), (None, 2, 5)], "gogordernumber long, gogticketid long, gogguidenumber long")
    rows = with_guides({"get_orderguides": guides}, scope).select("ticode", "tiorder", "guideid").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 10, 7), (1, 10, 8), (1, 11, None), (2, None, None), (None, 10, None)], key=str)


def test_class_names_are_short_and_lowered_ids_need_no_join(spark, src, scratch):
    seen = observed_classes(joined_rows(src, LO, HI))
    assert {len(r["class"]) for r in seen.collect()} == {24}
    kept = ClassMinima(spark, f"{scratch}/m", buckets=4)
    kept.merge("a", seen)
    assert "Join" not in _plan(kept.superseded())
