"""What the findings of round 3 asked for: pruning only where it prunes, narrow frames, text searched only where it can need it."""

import contextlib
import io
from pathlib import Path

import __spark_entry__ as E
from turnstile.operators.xml import to_xml_rows
from turnstile.plans.working_set import joined_rows
from turnstile.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def frames_of(spark, run):
    """Columns of each frame that ``run`` writes to the checkpoint folder."""
    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.glob("frame-*"))
    run()
    return [spark.read.parquet(str(p)).columns for p in set(root.glob("frame-*")) - before]


def test_numbers_and_times_are_not_searched_for_escapes(spark):
    rows = spark.sql("SELECT 1L AS n, CAST(1.5 AS DECIMAL(9, 4)) AS m, TIMESTAMP_NTZ '2014-10-01 08:00:00' AS t, 'a<b&c' AS s")
    rows = rows.unionByName(spark.sql("SELECT 2L AS n, NULL AS m, NULL AS t, 'x' AS s"))
    out = to_xml_rows(rows, "r", [("n", "N"), ("m", "M"), ("t", "T"), ("s", "S")])
    assert [r.xml for r in out.orderBy("n").collect()] == [
        "<r><N>1</N><M>1.5000</M><T>2014-10-01T08:00:00</T><S>a&lt;b&amp;c</S></r>", "<r><N>2</N><S>x</S></r>"]
    tree = out.select("xml")._jdf.queryExecution().analyzed().toString()
    assert tree.count("\\x0B") == 1  # the one string


def test_a_scope_of_most_tickets_prunes_nothing(spark, src):
    lo, hi = "2000-01-01 00:00:00", "2030-01-01 00:00:00"
    fee = src["calculatedcommission"]
    few = {**src, "calculatedcommission": fee.limit(0)}
    many = {**src, "calculatedcommission": fee.unionByName(spark.range(5000).selectExpr(
        "id + 100000000 AS clcticketnum", "CAST(1 AS DECIMAL(19, 4)) AS clcsum"))}
    assert "LeftSemi" not in plan_of(joined_rows(few, lo, hi, prune_to_scope=True))
    assert "LeftSemi" in plan_of(joined_rows(many, lo, hi, prune_to_scope=True))
    whole, pruned = (sorted(map(repr, joined_rows(many, lo, hi, prune_to_scope=p).collect())) for p in (False, True))
    assert whole == pruned and whole


def test_the_range_lookup_writes_no_second_working_set(spark):
    frames = frames_of(spark, lambda: E.queries()["range_lookup"](spark, SF).collect())
    assert frames and not any("minticode" in f for f in frames)


def test_frames_of_three_products_carry_no_receipt_id(spark):
    frames = frames_of(spark, lambda: E.queries()["record_counts"](spark, SF).collect())
    ids = [f for f in frames if "minticode" in f]
    assert len(ids) == 1 and "_txn_min_rcb" not in ids[0]


def test_small_frames_of_the_joins_are_snappy(spark):
    from turnstile.llm import families

    root = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.glob("frame-*"))
    families.materialize(spark.range(10))
    new, = set(root.glob("frame-*")) - before
    assert list(new.glob("*.snappy.parquet"))
