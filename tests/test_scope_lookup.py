from decimal import Decimal as D

from tests.fixtures import HI, LO, T
from turnstile.operators.lookup import first_match, range_lookup, sum_lookup
from turnstile.operators.scope import referenced_rows, ticket_scope
from turnstile.plans.working_set import receipts_by_transaction


def test_scope_bounds_and_sale_shifts(src):
    got = sorted(r.ticode for r in ticket_scope(src, LO, HI).collect())
    # 6: non-sale shift; 8: 23:59:30 is after a 23:59 bound; 103 at 00:00 is in
    assert got == [1, 2, 3, 4, 5, 7, 9]


def test_referenced_rows_is_a_distinct_semi_join(spark, src):
    scope = ticket_scope(src, LO, HI)
    got = sorted(r.cltcode for r in referenced_rows(src["clients"], "cltcode", scope,
                                                    "timailinglist").collect())
    assert got == [1, 2, 4]   # NULL contact of ticket 3 matches nothing


def test_first_receipt_lookups(src):
    got = {r.rcbtransactnum: r for r in receipts_by_transaction(src).collect()}
    # first receipt (50) has no pay type: description from the second, dates from the first
    assert got[1000].ptdescr == "Card"
    assert got[1000].rcbshiftdate == T("2014-10-01 08:05") and got[1000].rcbcachinout == 0
    assert got[1000]._txn_min_rcb == 50 and got[1000]._txn_amount == D("25.0000")
    assert got[1005].ptdescr is None and got[1005].rcbshiftdate is None


def test_first_match_generic(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    right = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 7, "c"), (2, 7, "d")],
                                  "rk long, o int, v string")
    got = {r.k: r.v for r in first_match(left, "k", right, "rk", ["o", "v"], {"v": "v"}).collect()}
    assert got == {1: "a", 2: "c", 3: None}


def test_sum_lookup_is_null_without_rows(src):
    out = sum_lookup(src["tickets"], "ticode", src["calculatedcommission"], "clcticketnum",
                     "clcsum", "fees")
    got = {r.ticode: r.fees for r in out.collect()}
    assert got[1] == D("2.0000") and got[2] is None


def test_range_lookup_lowest_matching_id(spark):
    left = spark.createDataFrame([(1, T("2014-10-01 10:00")), (1, T("2014-12-01 10:00")),
                                  (2, T("2014-10-01 10:00"))], "show long, d timestamp_ntz")
    sched = spark.createDataFrame(
        [(10, 1, T("2014-09-01 00:00"), T("2014-11-01 00:00")),
         (7, 1, T("2014-10-01 10:00"), T("2014-10-01 10:00")),
         (3, 1, T("2015-01-01 00:00"), T("2015-02-01 00:00"))],
        "id long, activityid long, startdate timestamp_ntz, enddate timestamp_ntz")
    out = range_lookup(left, "show", "d", sched, "activityid", "startdate", "enddate", "id", "sid")
    got = sorted((r.show, r.d.month, r.sid) for r in out.collect())
    assert got == [(1, 10, 7), (1, 12, None), (2, 10, None)]


def test_scope_pushes_date_filter_to_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "events.parquet")
    spark.createDataFrame([(1, 1, T("2014-10-01 10:00"), 1)],
                          "evcode long, evshow long, eveventdate timestamp_ntz, evpricelist long"
                          ).write.parquet(path)
    src = {"events": spark.read.parquet(path)}
    from turnstile.operators.scope import in_range
    src["events"].filter(in_range("eveventdate", LO, HI)).select("evcode").explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "GreaterThanOrEqual(eveventdate" in plan
    assert "ReadSchema: struct<evcode:bigint,eveventdate:timestamp_ntz>" in plan


def test_inclusive_bounds_at_minute_precision(spark):
    from turnstile.operators.scope import in_range
    rows = [(T("2014-10-01 00:00"),), (T("2014-10-01 23:59"),), (T("2014-10-01 23:59:30"),),
            (T("2014-09-30 23:59:59"),), (None,)]
    df = spark.createDataFrame(rows, "d timestamp_ntz")
    got = [r.d for r in df.filter(in_range("d", LO, HI)).collect()]
    assert sorted(got) == [T("2014-10-01 00:00"), T("2014-10-01 23:59")]
