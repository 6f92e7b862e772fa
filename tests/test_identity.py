from decimal import Decimal

import pytest

from tests.fixtures import HI, LO, ROWS
from turnstile.operators.identity import ClassMinima, renumbered
from turnstile.plans import products as P
from turnstile.plans.working_set import build_working_set
from turnstile.sources.schemas import SOURCE_SCHEMAS
from turnstile.streaming import minima_stream


#: tickets by arrival: equivalent ones (5 and 4, 2 and 1) come apart, the lower id last
ARRIVALS = [[9, 8, 7, 6, 5], [4, 3, 2], [1]]


def arrived(spark, codes):
    return spark.createDataFrame([r for r in ROWS["tickets"] if r[0] in codes], SOURCE_SCHEMAS["tickets"])


def split_sources(spark, src, arrivals):
    return [{**src, "tickets": arrived(spark, codes)} for codes in arrivals]


def ids(frame):
    return sorted(map(tuple, frame.select("ticode", "minticode", "paymentid", "guideid").collect()), key=str)


@pytest.mark.parametrize("arrivals", [ARRIVALS, [sum(ARRIVALS[:2], []), ARRIVALS[2]]])
def test_runs_give_the_ids_of_one_run(spark, src, scratch, arrivals):
    kept = ClassMinima(spark, f"{scratch}/minima", buckets=4)
    published = [build_working_set(s, LO, HI, keep_internal=True, minima=kept, run_id=f"r{i}")
                 for i, s in enumerate(split_sources(spark, src, arrivals))]
    lowered = kept.superseded()
    assert lowered.filter("kind = 'ticket'").count() >= 1
    whole = published[0]
    for p in published[1:]:
        whole = whole.unionByName(p)
    whole = renumbered(renumbered(whole, "minticode", lowered, "ticket"), "paymentid", lowered, "payment")
    assert ids(whole) == ids(build_working_set(src, LO, HI))
    # a run that is repeated changes nothing, and a compacted table means the same
    before = sorted(map(tuple, kept.known().collect()))
    again = build_working_set(split_sources(spark, src, arrivals)[-1], LO, HI, minima=kept, run_id=f"r{len(arrivals) - 1}")
    assert again.count() and sorted(map(tuple, kept.known().collect())) == before
    kept.compact()
    assert sorted(map(tuple, kept.known().collect())) == before and kept.superseded().count() == 0


def test_a_run_reads_only_its_buckets(spark, scratch):
    kept = ClassMinima(spark, f"{scratch}/m", buckets=16)
    rows = lambda found: spark.createDataFrame([("ticket", c, Decimal(x)) for c, x in found], "kind string, class string, low decimal(38,0)")
    kept.merge("a", rows([(f"c{i}", i + 10) for i in range(200)]))
    out = kept.merge("b", rows([("c5", 3), ("c6", 99), ("new", 1)]))
    assert sorted((r["class"], int(r["low"])) for r in out.collect()) == [("c5", 3), ("c6", 16), ("new", 1)]
    assert [tuple(map(int, r[1:])) for r in kept.superseded().collect()] == [(15, 3)]
    kept_rows = spark.read.parquet(f"{scratch}/m").filter("run = 'b'")
    assert sorted(r["class"] for r in kept_rows.collect()) == ["c5", "new"]


def test_stream_corrects_ids_that_late_tickets_lower(spark, src, scratch):
    inbox, static = f"{scratch}/inbox", {k: v for k, v in src.items() if k != "tickets"}
    for i, codes in enumerate(ARRIVALS):
        arrived(spark, codes).coalesce(1).write.parquet(f"{inbox}/{i}")
    stream = (spark.readStream.schema(SOURCE_SCHEMAS["tickets"]).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(inbox))
    for _ in range(2):  # a restart finds nothing new
        for q in minima_stream.start(stream, static, f"{scratch}/out", f"{scratch}/ck", LO, HI):
            q.awaitTermination()
        got = minima_stream.working_set(spark, f"{scratch}/out")
        assert ids(got) == ids(build_working_set(src, LO, HI))
    fixed = minima_stream.corrections(spark, f"{scratch}/out")
    assert {(r["kind"], int(r["old"]), int(r["new"])) for r in fixed.collect()} == {("ticket", 5, 4), ("ticket", 2, 1), ("payment", 54, 53)}
    # the first batch alone is a product of its own
    first = minima_stream.working_set(spark, f"{scratch}/out", 0)
    assert ids(first) == ids(build_working_set({**src, "tickets": arrived(spark, ARRIVALS[0])}, LO, HI))
    want = P.payments(build_working_set(src, LO, HI, keep_internal=True), src)
    assert sorted(map(str, P.payments(got, src).collect())) == sorted(map(str, want.collect()))
    # a late ticket lowers an id that was published before
    late = spark.createDataFrame([(0, *next(r for r in ROWS["tickets"] if r[0] == 1)[1:])], SOURCE_SCHEMAS["tickets"])
    late.coalesce(1).write.parquet(f"{inbox}/late")
    for q in minima_stream.start(stream, static, f"{scratch}/out", f"{scratch}/ck", LO, HI):
        q.awaitTermination()
    both = {**src, "tickets": src["tickets"].unionByName(late)}
    assert ids(minima_stream.working_set(spark, f"{scratch}/out")) == ids(build_working_set(both, LO, HI))
