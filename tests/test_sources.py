from tests.fixtures import ROWS
from turnstile.sources.schemas import SOURCE_SCHEMAS
from turnstile.sources.tables import load_catalog, load_parquet


def test_load_parquet_applies_the_source_schemas(spark, scratch):
    for name in ("tickets", "events"):
        spark.createDataFrame(ROWS[name], SOURCE_SCHEMAS[name]).write.parquet(f"{scratch}/{name}.parquet")
    src = load_parquet(spark, scratch, ["tickets", "events"])
    assert src["tickets"].schema.simpleString() == spark.createDataFrame(
        [], SOURCE_SCHEMAS["tickets"]).schema.simpleString()
    assert src["events"].count() == len(ROWS["events"])


def test_load_catalog_reads_tables_of_another_database(spark):
    # a second "database": the CRM users live in the catalog under another name
    spark.createDataFrame(ROWS["crm_users"], SOURCE_SCHEMAS["crm_users"]) \
        .createOrReplaceTempView("crm_users_elsewhere")
    src = load_catalog(spark, {"crm_users": "crm_users_elsewhere"})
    assert sorted(r.id for r in src["crm_users"].collect()) == ["u5", "u6", "u7"]


def test_receipts_sharing_an_id_are_equal_and_wide_keys_do_not_collide(spark):
    from pyspark.sql import functions as F
    from turnstile.sources.roles import driver_sources, receipt_id

    receipts = driver_sources(spark, "/root/testdata/sf0.001")["recieptbase"]
    picked = receipts.select("rcbcode", "rcbtransactnum", "rcbpaytype", "rcbshiftdate", "rcbcachinout").distinct()
    assert picked.count() == receipts.select("rcbcode").distinct().count()
    lines = spark.createDataFrame(
        [(1, 7, 1, 1), (1, 6, 10001, 1), (600_000_000_000, 20_000_000_000, 999_999_999, 7)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").withColumns(
            {"l_shipdate": F.lit("1996-01-01").cast("timestamp_ntz"), "l_linestatus": F.lit("O"),
             "l_returnflag": F.lit("A")})
    ids = [r[0] for r in lines.select(receipt_id()).collect()]
    assert len(set(ids)) == 3 and None not in ids


def test_the_registered_window_holds_every_event(spark):
    from pyspark.sql import functions as F
    from turnstile.operators.scope import in_range
    from turnstile.registry import HI, LO
    from turnstile.sources.roles import driver_sources

    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        events = driver_sources(spark, f"/root/testdata/{sf}")["events"]
        assert events.filter(~F.coalesce(in_range("eveventdate", LO, HI), F.lit(False))).isEmpty()
