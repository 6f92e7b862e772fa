import datetime as dt

from pyspark.sql import functions as F

from tests.fixtures import HI, LO
from turnstile.plans import products as P
from turnstile.plans.dump import dump
from turnstile.plans.sync import increment_bounds, sync


def ok(endpoint, body, key):
    return 200, "ok"


def test_increment_bounds(spark):
    empty = spark.createDataFrame([], "eveventdate timestamp_ntz")
    assert increment_bounds(None, "now")[0] == dt.datetime(2016, 2, 1)
    assert increment_bounds(empty, "now")[0] == dt.datetime(2016, 2, 1)
    prev = spark.createDataFrame([(dt.datetime(2014, 10, 1, 23, 50),)], "eveventdate timestamp_ntz")
    assert increment_bounds(prev, "now") == (dt.datetime(2014, 10, 1, 23, 50), "now")
    lo, _ = increment_bounds(prev, "now", lookback=dt.timedelta(hours=1))
    assert lo == dt.datetime(2014, 10, 1, 22, 50)


def test_sync_first_run_empty_then_incremental(spark, src, scratch):
    state = f"{scratch}/state"
    # first run: no previous working set -> start 2016-02-01 -> nothing after it: no load
    first = sync(spark, src, state, now=dt.datetime(2016, 3, 1), transport=ok, run_id="a")
    assert first.lo == dt.datetime(2016, 2, 1)
    assert first.counts == {"contacts": 0, "payments": 0, "tickets": 0} and not first.responses


def test_sync_incremental_from_mark(spark, src, scratch):
    state = f"{scratch}/state"
    # seed a previous run whose mark is 23:50 (as a completed run would leave it)
    prev = spark.createDataFrame([(dt.datetime(2014, 10, 1, 23, 50),)], "eveventdate timestamp_ntz")
    prev.write.parquet(f"{state}/v=seed")
    spark.createDataFrame([("seed", f"{state}/v=seed", "", "")],
                          "run_id string, path string, lo string, hi string"
                          ).write.parquet(f"{state}/_runs")
    rep = sync(spark, src, state, now=dt.datetime(2014, 10, 1, 23, 59), transport=ok, run_id="b")
    assert rep.lo == dt.datetime(2014, 10, 1, 23, 50)
    # only the 23:50 event (tickets 4, 5) is in the increment
    assert rep.counts == {"contacts": 1, "payments": 1, "tickets": 2}
    assert {k: sum(r.n_rows for r in v.collect()) for k, v in rep.responses.items()} == rep.counts
    ws = spark.read.parquet(rep.state_path)
    assert sorted(r.ticode for r in ws.select("ticode").distinct().collect()) == [4, 5]
    # the next run starts at this run's mark
    again = sync(spark, src, state, now=dt.datetime(2014, 10, 1, 23, 59), run_id="c")
    assert again.lo == dt.datetime(2014, 10, 1, 23, 50)


def fail(endpoint, body, key):
    return 500, "down"


def test_failed_push_does_not_advance_the_mark(spark, src, scratch):
    state = f"{scratch}/state"
    prev = spark.createDataFrame([(dt.datetime(2014, 10, 1, 23, 50),)], "eveventdate timestamp_ntz")
    prev.write.parquet(f"{state}/v=seed")
    spark.createDataFrame([("seed", f"{state}/v=seed", "", "")],
                          "run_id string, path string, lo string, hi string"
                          ).write.parquet(f"{state}/_runs")
    now = dt.datetime(2014, 10, 2, 23, 59)
    bad = sync(spark, src, state, now=now, transport=fail, run_id="b")
    assert bad.failed_batches == 1 and list(bad.responses) == ["contacts"]  # stops at the failure
    # the mark did not move: the next run sends the same increment again
    good = sync(spark, src, state, now=now, transport=ok, run_id="c")
    assert good.lo == bad.lo == dt.datetime(2014, 10, 1, 23, 50) and good.failed_batches == 0
    assert set(good.responses) == {"contacts", "payments", "tickets"}
    persisted = spark.read.parquet(f"{state}/responses")
    assert {r.run for r in persisted.select("run").distinct().collect()} == {"b", "c"}


def test_full_and_day_dump(src):
    profile = P.UserProfile(email_suffix="@crm.test", profile_id="P1")
    full = dump(src, LO, HI, profile, "full")
    day = dump(src, LO, HI, profile, "day")
    for products in (full, day):
        assert set(products) == {"contacts", "pricetypes", "activities", "temptickets",
                                 "activityschedule", "tickets", "payments",
                                 "activitypriceschedule", "users", "lookuptimes"}
        assert products["temptickets"].count() == 8
        assert "_txn_min_rcb" not in products["temptickets"].columns
    assert full["activitypriceschedule"].count() == 7 and day["activitypriceschedule"].count() == 6
    assert full["payments"].filter(F.col("lastCardNum").isNull()).count() == 1
    assert "activityscheduleid" in day["tickets"].columns


def test_retry_resends_only_failed_batches(spark, src, scratch):
    from turnstile.plans.sync import retry_failed
    state = f"{scratch}/state"
    prev = spark.createDataFrame([(dt.datetime(2014, 10, 1, 23, 50),)], "eveventdate timestamp_ntz")
    prev.write.parquet(f"{state}/v=seed")
    spark.createDataFrame([("seed", f"{state}/v=seed", "", "")],
                          "run_id string, path string, lo string, hi string"
                          ).write.parquet(f"{state}/_runs")
    now = dt.datetime(2014, 10, 2, 23, 59)
    bad = sync(spark, src, state, now=now, transport=fail, run_id="r1")
    assert bad.failed_batches == 1
    assert retry_failed(spark, state, "r1", fail) == 1          # still down
    assert retry_failed(spark, state, "r1", ok) == 0            # recovered: everything sent
    responses = spark.read.parquet(f"{state}/responses").filter("run = 'r1'")
    per_entity = {r.entity: r.n for r in responses.filter("status = 200").groupBy("entity")
                  .agg(F.count("*").alias("n")).collect()}
    assert per_entity == {"contacts": 1, "payments": 1, "tickets": 1}   # one batch each, once
    # the run is logged now, so the next sync starts from its mark
    mark = spark.read.parquet(f"{state}/v=r1").agg(F.max("eveventdate")).first()[0]
    assert mark == dt.datetime(2014, 10, 1, 23, 59, 30)     # ticket 8's event joined the window
    nxt = sync(spark, src, state, now=now, run_id="a0")       # id sorts before "r1": order is by time
    assert nxt.lo == mark
    assert retry_failed(spark, state, "r1", ok) == 0
