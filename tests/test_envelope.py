import datetime as dt
import random

from turnstile.operators.envelope import add_to_stairs, lowest_active
from turnstile.operators.lookup import range_lookup


def some(rng, n, keys):
    spans = []
    for i in range(n):
        s = rng.randint(0, 1000)
        e = rng.choice([s, s + rng.randint(0, 60), s + rng.randint(0, 900), 10**15, s - 1])
        spans.append((rng.choice(keys), s, e, rng.randint(0, n // 2)))
    points = sorted({(rng.choice(keys + [99]), rng.randint(-5, 1100)) for _ in range(n)})
    return spans, points


def brute(spans, points):
    out = {}
    for k, t in points:
        held = [v for key, s, e, v in spans if key == k and s <= t <= e]
        if held:
            out[k, t] = min(held)
    return out


def test_lowest_active_over_busy_and_rare_keys(spark):
    rng = random.Random(4)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # a busy key goes over several partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for keys in ([1], [1] * 20 + [2, 3], list(range(40))):
            spans, points = some(rng, 700, keys)
            got = lowest_active(spark.createDataFrame(points, "k long, t long"), spark.createDataFrame(spans, "k long, s long, e long, v long"))
            rows = got.collect()
            assert {(r.k, r.t): r.v for r in rows} == brute(spans, points) and len(rows) == len(brute(spans, points))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_stairs_keep_what_no_lower_value_outlasts():
    rng = random.Random(7)
    for _ in range(200):
        rows = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(0, 12))]
        values, ends = [], []
        for v, e in rows:
            add_to_stairs(values, ends, v, e)
        for t in range(11):
            want = min((v for v, e in rows if e >= t), default=None)
            assert min((v for v, e in zip(values, ends) if e >= t), default=None) == want
        assert values == sorted(set(values)) and ends == sorted(set(ends))


def test_open_ended_rows_stay_one_event(spark):
    left = spark.createDataFrame([(1, dt.datetime(2014, 10, 1, 10)), (1, None), (None, dt.datetime(2014, 10, 1)), (2, dt.datetime(9999, 12, 31))],
                                 "show long, d timestamp_ntz")
    rows = [(5, 1, dt.datetime(2014, 1, 1), dt.datetime(9999, 12, 31)), (4, 2, dt.datetime(2014, 1, 1), dt.datetime(9999, 12, 31)),
            (1, 1, None, dt.datetime(2015, 1, 1)), (2, 1, dt.datetime(2014, 1, 1), None), (None, 1, dt.datetime(2014, 1, 1), dt.datetime(2016, 1, 1)),
            (0, 1, dt.datetime(2014, 10, 2), dt.datetime(2014, 10, 1))]
    table = spark.createDataFrame(rows, "id long, activityid long, s timestamp_ntz, e timestamp_ntz")
    out = range_lookup(left, "show", "d", table, "activityid", "s", "e", "id", "sid")
    assert sorted((r.show or 0, r.d is None, r.sid or 0) for r in out.collect()) == [(0, False, 0), (1, False, 5), (1, True, 0), (2, False, 4)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row is multiplied
