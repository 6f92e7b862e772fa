"""Physical-plan properties of every registered query (checked on sf0.001)."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - {"sync_stream"}))
def test_no_python_udf_no_cross_join_no_single_partition(spark, name):
    plan = plan_of(E.queries()[name](spark, SF), "simple")
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            # only pre-aggregated rows (one per partition) may meet in one task
            assert "partial_" in lines[i + 1], f"{name}: rows moved to a single partition"


def test_each_backfill_is_one_salted_left_join(spark):
    plan = plan_of(E.queries()["working_set"](spark, SF), "simple")
    # all rows take each join once; the salt, which only NULL-key rows have, is among its keys
    for i in range(2):
        lines = [ln for ln in plan.splitlines() if f"__b{i}__k0" in ln and "Join" in ln]
        assert len(lines) == 1 and "LeftOuter" in lines[0] and f"__s{i}" in lines[0]
    assert "Union" not in plan


def test_price_schedule_aggregates_before_the_price_list_join(spark):
    plan = plan_of(E.queries()["price_schedule"](spark, SF), "simple")
    join = next(i for i, ln in enumerate(plan.splitlines())
                if "Join" in ln and "evpricelist" in ln and "pdpricelist" in ln)
    below = "\n".join(plan.splitlines()[join:join + 40])
    assert "HashAggregate" in below


def test_row_numbering_is_range_partitioned(spark):
    from turnstile.operators.batch import number_rows
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = plan_of(number_rows(df, ["k"], num_partitions=4), "simple")
    assert "SinglePartition" not in plan and "Window" not in plan
    assert "BroadcastExchange" in plan   # the per-partition offset table


def test_receipt_pass_is_a_hash_aggregation(spark):
    # min_by over fixed-width values keeps Spark on HashAggregate (no sort of
    # every receipt); a string or struct buffer would fall back to SortAggregate
    plan = plan_of(E.queries()["first_match"](spark, SF), "simple")
    assert "HashAggregate(keys=[rcbtransactnum" in plan
    assert "SortAggregate(key=[rcbtransactnum" not in plan


def _below(plan, line_has):
    """Lines of the subtree under the first line with every one of the texts."""
    lines = plan.splitlines()
    at = next(i for i, ln in enumerate(lines) if all(t in ln for t in line_has))
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*"))
    rest = []
    for ln in lines[at + 1:]:
        if len(ln) - len(ln.lstrip(" :+-*")) <= depth:
            break
        rest.append(ln)
    return "\n".join(rest)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["accounts_union", "orders_visit"])
def test_the_event_window_is_joined_before_the_clients(spark, no_broadcast, name):
    plan = plan_of(E.queries()[name](spark, SF), "simple")
    assert "evcode" in _below(plan, ["Join", "timailinglist", "cltcode"])


def test_range_lookup_multiplies_no_row(spark, no_broadcast):
    plan = plan_of(E.queries()["range_lookup"](spark, SF), "simple")
    assert "Generate" not in plan and "MapInArrow" in plan  # one sweep over sorted events instead of a range join
    joins = [ln for ln in plan.splitlines() if "Join" in ln and "__rk" in ln]
    assert joins and all("__rt" in ln for ln in joins)  # what it found is joined by show and time


def test_tickets_are_shuffled_by_transaction_once(spark, no_broadcast):
    from turnstile.plans.working_set import joined_rows
    from turnstile.registry import HI, LO
    from turnstile.sources.roles import driver_sources

    rows = plan_of(joined_rows(driver_sources(spark, SF), LO, HI), "simple")
    assert sum("hashpartitioning(titransactnum" in ln for ln in rows.splitlines()) == 1
    # the backfills and the rows read what that plan wrote, not the ticketing tables again
    plan = plan_of(E.queries()["working_set"](spark, SF), "simple")
    assert "titransactnum#" in plan and "hashpartitioning(titransactnum" not in plan and "l_orderkey" not in plan


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
import __spark_entry__ as E
for name in {names!r}:
    print("DONE", name, len(E.queries()[name](spark, {sf!r}).collect()))
"""


def test_workers_need_not_have_the_package(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    names = ["range_lookup", "planned_scan", "push_receipts", "stream_payments", "xml_tickets"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = SCRIPT.format(root=str(Path(E.__file__).resolve().parent), shared=str(tmp_path / "ck"), names=names, sf=SF)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert [line.split()[1] for line in out.stdout.splitlines() if line.startswith("DONE")] == names, out.stderr[-3000:]
