import datetime as dt
import os
from collections import Counter

from tests.fixtures import HI, LO
from turnstile.operators.identity import ClassMinima
from turnstile.plans import changes
from turnstile.plans import products as P
from turnstile.plans.dump import dump
from turnstile.plans.sync import retry_failed, sync
from turnstile.session import scratch_frames
from turnstile.sources.sinks import write_folder

SCHEMA = "id long, v string, n int"


def test_change_table_counts_equal_rows(spark):
    before = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, "b", None), (3, "c", 3), (None, "x", 1), (4, "d", 4)], SCHEMA)
    now = spark.createDataFrame([(1, "a", 1), (2, None, None), (3, "c", 3), (3, "c", 3), (5, "e", 5), (None, "x", 1)], SCHEMA)
    got = changes.changes(changes.snapshot(before, "id"), changes.snapshot(now, "id")).collect()
    assert sorted((r["key"], r["kind"], r["n"]) for r in got) == [
        ("1", "replaced", 1), ("2", "change", 1), ("2", "replaced", 1), ("3", "change", 1), ("4", "tombstone", 1), ("5", "insert", 1)]
    unsent = changes.unsent(now, "id", changes.snapshot(before, "id"))
    assert Counter(map(tuple, unsent.collect())) == Counter([(2, None, None), (3, "c", 3), (5, "e", 5)])
    assert changes.unsent(now, "id", spark.createDataFrame([], changes.SNAPSHOT)).count() == 6
    assert changes.unsent(now, "id", changes.snapshot(now, "id")).isEmpty()


def ok(endpoint, body, key):
    return 200, "ok"


def down(endpoint, body, key):
    return 500, "down"


def seeded(spark, state):
    spark.createDataFrame([(dt.datetime(2014, 10, 1, 0, 0),)], "eveventdate timestamp_ntz").write.parquet(f"{state}/v=seed")
    spark.createDataFrame([("seed", f"{state}/v=seed", "", "")], "run_id string, path string, lo string, hi string").write.parquet(f"{state}/_runs")


def frames(spark):
    where = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f for f in os.listdir(where) if f.startswith("frame-")}


def test_a_run_without_news_sends_nothing(spark, src, scratch):
    state, before = f"{scratch}/state", frames(spark)
    seeded(spark, state)
    minima = ClassMinima(spark, f"{state}/minima", buckets=4)
    now, options = dt.datetime(2014, 10, 1, 23, 59), {"delta": True, "minima": minima, "lookback": dt.timedelta(days=1)}
    failed = sync(spark, src, state, now, down, run_id="a", **options)
    assert failed.failed_batches == 1 and failed.counts["tickets"] > 0
    first = sync(spark, src, state, now, ok, run_id="b", **options)  # what was not accepted counts as not sent
    assert first.counts == failed.counts and first.failed_batches == 0
    again = sync(spark, src, state, now, ok, run_id="c", **options)
    assert again.counts == dict.fromkeys(first.counts, 0) and not again.responses
    # one changed client is all that a further run sends
    changed = {**src, "clients": src["clients"].selectExpr("cltcode", "if(cltcode = 1, 'Anna', cltfirstname) as cltfirstname", "cltsurname", "cltemail")}
    later = sync(spark, changed, state, now, ok, run_id="d", **options)
    assert later.counts == {"contacts": 1, "payments": 0, "tickets": 0}
    assert retry_failed(spark, state, "d", ok) == 0
    assert frames(spark) == before  # no frame is left behind


def test_dump_leaves_no_frames(spark, src, scratch):
    before = frames(spark)
    with scratch_frames(spark):
        for name, product in dump(src, LO, HI, P.UserProfile(email_suffix="@crm.test", profile_id="P1"), "day").items():
            write_folder(product, f"{scratch}/out/{name}")
    assert frames(spark) == before and spark.read.parquet(f"{scratch}/out/tickets").count() > 0


def test_sync_counts_what_it_writes(spark, src, scratch):
    state = f"{scratch}/state"
    seeded(spark, state)
    report = sync(spark, src, state, dt.datetime(2014, 10, 1, 23, 59), ok, run_id="a")
    bodies = {r["entity"]: r["n"] for r in spark.read.parquet(f"{state}/bodies").groupBy("entity").agg({"n_rows": "sum"}).toDF("entity", "n").collect()}
    assert report.counts == bodies and "_txn_amount" in spark.read.parquet(report.state_path).columns
