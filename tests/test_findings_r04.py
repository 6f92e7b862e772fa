"""What the findings of round 4 asked for: less on the executors' disks at once, and in all."""

import os
import time
from pathlib import Path

import pytest

import __spark_entry__ as E
from tests.fixtures import HI, LO, ROWS
from tests.test_findings_r03 import SF, frames_of, plan_of
from turnstile import registry as R
from turnstile.operators.rollup import ticket_rollup
from turnstile.plans import products as P
from turnstile.plans.working_set import build_working_set, in_parts, published, working_set_parts, written_rows
from turnstile.session import ensure_checkpoint_dir, materialize
from turnstile.sources.schemas import SOURCE_SCHEMAS
from turnstile.streaming import minima_stream


def rows(df, columns=None):
    return sorted(repr(tuple(r)) for r in df.select(*(columns or df.columns)).collect())


def whole(parts, columns):
    return sorted(x for part in parts for x in rows(part, columns))


@pytest.mark.parametrize("group_by", ["show", "event"])
def test_parts_are_the_working_set_whatever_contact_is_busy(spark, src, group_by):
    more = src["tickets"].unionByName(spark.createDataFrame(  # rows without a contact, without other keys, and twice the same
        [(90 + i, *r[1:]) for i, r in enumerate(ROWS["tickets"][:3])] + ROWS["tickets"][:2], SOURCE_SCHEMAS["tickets"]))
    nulls = more.selectExpr("ticode + 1000 AS ticode", *[f"CAST(NULL AS {t}) AS {c}" if c in ("timailinglist", "tistatus") else c
                                                         for c, t in more.dtypes if c != "ticode"]).select(more.columns)
    odd = {**src, "tickets": more.unionByName(nulls)}
    ws = published(build_working_set(odd, LO, HI, group_by=group_by))
    want, rolled = rows(ws), rows(P.tickets(ws))
    base = written_rows(odd, LO, HI, group_by)
    for busy in (0, 1, 1 << 20):
        got = in_parts(base, group_by, busy)
        assert whole(got.parts, ws.columns) == want and want
        assert rows(P.tickets(got), P.tickets(ws).columns) == rolled


def test_a_roll_up_by_contact_deals_the_rows_once(spark, src):
    usual = working_set_parts(src, LO, HI).parts[0]
    plan = plan_of(ticket_rollup(usual))
    assert plan.count("REPARTITION_BY_COL") == 1 and "hashpartitioning(minticode" not in plan


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for d in dirs for p in Path(d.getPath()).glob("*/shuffle_*")}


def test_frames_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    was, before = spark.conf.get(key), shuffle_files(spark)
    frame = materialize(df, release=True)
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and frame.count() == 7 and spark.conf.get(key) == was


def test_changes_join_two_runs_rows_once(spark):
    frames = frames_of(spark, lambda: E.queries()["ticket_changes"](spark, SF).collect())
    assert sum("titransactnum" in f for f in frames) == 1


def test_the_range_lookups_schedule_reads_the_written_rows(spark):
    src = R._src(spark, SF)
    ws = working_set_parts(src, R.LO, R.HI, "event")
    schedule = R._day_schedule(src, ws.rows)
    assert rows(schedule) == rows(R._day_schedule(src)) and "l_linenumber" not in plan_of(schedule)


ARRIVALS = [[9, 8, 7, 6, 5], [4, 3, 2], [1]]


@pytest.fixture()
def streamed(spark, src, scratch):
    for i, codes in enumerate(ARRIVALS):
        (spark.createDataFrame([r for r in ROWS["tickets"] if r[0] in codes], SOURCE_SCHEMAS["tickets"]).coalesce(1)
         .write.parquet(f"{scratch}/inbox/{i}"))
    static = {k: v for k, v in src.items() if k != "tickets"}

    def run():
        stream = (spark.readStream.schema(SOURCE_SCHEMAS["tickets"]).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", "true").parquet(f"{scratch}/inbox"))
        for query in minima_stream.start(stream, static, f"{scratch}/out", f"{scratch}/ck", LO, HI):
            query.awaitTermination()

    run()
    return Path(scratch), run


def test_the_stream_joins_its_tickets_once(streamed):
    root, _ = streamed
    log = "".join(f.read_text() for f in (root / "ck/changes/sources/0").glob("[0-9]*"))
    assert "/out/rows/epoch=2/" in log and "/inbox/" not in log
    for name in ("rows", "changes"):
        assert sorted(p.name for p in (root / "out" / name).glob("epoch=*")) == ["epoch=0", "epoch=1", "epoch=2"]


def test_a_stream_that_broke_off_goes_on(spark, src, streamed):
    root, run = streamed
    for name in ("rows", "changes"):  # the last batch ended, but wasn't known to have
        for f in (root / "ck" / name / "commits").glob("*2*"):
            os.remove(f)
    before = sorted(p.name for p in (root / "out/rows/epoch=2").glob("*.parquet"))
    run()
    assert sorted(p.name for p in (root / "out/rows/epoch=2").glob("*.parquet")) == before
    ws = build_working_set(src, LO, HI)
    assert rows(minima_stream.working_set(spark, f"{root}/out").select(ws.columns)) == rows(ws)


def test_streamed_queries_leave_only_what_they_read(spark):
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.iterdir())
    E.queries()["stream_tickets"](spark, SF)
    assert [sorted(p.name for p in new.iterdir()) for new in set(root.iterdir()) - before] == [["out"]]


def test_the_streams_parts_are_its_working_set(spark, src, streamed):
    root, _ = streamed
    for epoch, busies in ((None, (0, 1 << 20)), (0, (1 << 20,))):
        ws = minima_stream.working_set(spark, f"{root}/out", epoch)
        want, rolled = rows(ws), rows(P.tickets(ws))
        paid = rows(P.payments(ws, src))
        for busy in busies:
            got = minima_stream.working_set_parts(spark, f"{root}/out", epoch, busy)
            assert whole(got.parts, ws.columns) == want and want
            assert rows(P.tickets(got), P.tickets(ws).columns) == rolled and rows(P.payments(got, src)) == paid
