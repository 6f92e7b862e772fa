import contextlib
import io

import pytest

from tests.fixtures import HI, LO
from turnstile.plans.staging import Staging
from turnstile.plans.working_set import build_working_set, joined_rows, with_backfills


@pytest.fixture()
def staged(spark, src, scratch):
    out = Staging(spark, f"{scratch}/staged", "staged_test", 4)
    out.write(src)
    yield out
    out.drop()


def rows(df):
    return sorted(map(str, df.collect()))


def test_staged_rows_equal_those_of_the_sources(spark, src, staged):
    for group_by in ("show", "event"):
        got = staged.joined_rows(LO, HI, group_by)
        assert rows(got) == rows(joined_rows(src, LO, HI, group_by)) and got.columns == joined_rows(src, LO, HI, group_by).columns
    assert rows(with_backfills(staged.joined_rows(LO, HI))) == rows(build_working_set(src, LO, HI))
    staged.write({**src, "tickets": src["tickets"].filter("ticode <> 1")})  # staged again, in place
    assert staged.joined_rows(LO, HI).filter("ticode = 1").isEmpty()


def test_staged_joins_need_no_exchange(spark, staged):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            staged.joined_rows(LO, HI).explain("simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = out.getvalue()
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
    assert "PushedFilters" in plan and "GreaterThanOrEqual(eveventdate" in plan
