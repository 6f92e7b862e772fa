import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnstile.operators.batch import key_closure, number_batches, number_rows
from turnstile.operators.xml import batch_envelope, entity, to_xml_rows
from turnstile.plans.load import load, xml_batches


def test_number_rows_matches_row_number(spark):
    random.seed(7)
    rows = [(random.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, t long").repartition(7)
    got = {(r.k, r.t): r.rn for r in number_rows(df, ["k", "t"], num_partitions=5).collect()}
    w = Window.orderBy("k", "t")
    want = {(r.k, r.t): r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def test_batches_of_100(spark):
    df = spark.range(250).withColumnRenamed("id", "k")
    sizes = sorted(tuple(r) for r in number_batches(df, ["k"]).groupBy("batch_id").count().collect())
    assert sizes == [(0, 100), (1, 100), (2, 50)]


def test_all_equal_keys_exact_vs_closure(spark):
    df = spark.range(250).select(F.lit(0).cast("long").alias("tickid"), F.col("id").alias("t"))
    exact = number_batches(df, ["tickid", "t"]).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in exact) == [50, 100, 100]
    closure = sorted(tuple(r) for r in key_closure(df, "tickid", ["tickid", "t"]).collect())
    # the original loader re-sends all 250 rows of key 0 in each of the three batches
    assert closure == [(0, 0, 250), (1, 0, 250), (2, 0, 250)]


def test_closure_skips_null_keys_but_counts_their_positions(spark):
    rows = [(None, i) for i in range(150)] + [(1, 1000 + i) for i in range(10)]
    df = spark.createDataFrame(rows, "k long, t long")
    got = sorted(tuple(r) for r in key_closure(df, "k", ["k", "t"]).collect())
    assert got == [(1, 1, 10)]   # NULLs take rows 1..150, key 1 rows 151..160 -> batch 1


def test_xml_rows_escape_and_omit_null(spark):
    df = spark.createDataFrame([(1, "A<B & C>", None, "")], "id long, a string, b string, c string")
    xml = to_xml_rows(df, "contacts", [("id", "Id"), ("a", "A"), ("b", "B"), ("c", "C")]).first().xml
    assert xml == "<contacts><Id>1</Id><A>A&lt;B &amp; C&gt;</A><C></C></contacts>"


def test_envelope_keeps_row_order(spark):
    rows = spark.createDataFrame([(0, 2, "<r>2</r>"), (0, 1, "<r>1</r>"), (1, 3, "<r>3</r>")],
                                 "batch_id long, rn long, xml string")
    got = {r.batch_id: (r.n_rows, r.body) for r in batch_envelope(rows).collect()}
    assert got[0] == (2, "<request><req><r>1</r><r>2</r></req></request>")
    assert got[1] == (1, "<request><req><r>3</r></req></request>")


def test_entity_dispatch():
    assert entity("dbo.tickets").endpoint.endswith("MultiTicket")
    assert entity("contacts").key == "cltcode"
    try:
        entity("dbo.nothing")
    except ValueError:
        pass
    else:
        raise AssertionError("unknown entity accepted")


def echo(endpoint, body, key):
    return 200, f"{endpoint}|{key}|{body}"


def test_load_pushes_every_row_once(spark):
    rows = [(i, f"First{i}", "Sur & Co", f"e{i}@x") for i in range(230)]
    product = spark.createDataFrame(rows, "cltcode long, cltfirstname string, cltSurName string, "
                                          "cltEmail string")
    responses = load(product, "dbo.contacts", echo, run_id="r1").collect()
    assert sorted(r.batch_id for r in responses) == [0, 1, 2]
    assert sum(r.n_rows for r in responses) == 230 and all(r.status == 200 for r in responses)
    ids = [int(x) for r in responses for x in re.findall(r"<ExternalCID__c>(\d+)<", r.response)]
    assert sorted(ids) == list(range(230))
    first = min(responses, key=lambda r: r.batch_id).response
    assert first.startswith("/services/apexrest/MultiContact|r1/contacts/0|<request><req><contacts>")
    assert "<LastName>Sur &amp; Co</LastName>" in first


def test_xml_batches_timestamp_and_decimal_text(spark):
    from decimal import Decimal as D
    import datetime as dt
    product = spark.createDataFrame(
        [(1, 2, D("10.5000"), dt.datetime(2014, 10, 1, 9, 5), 3, 4, 5, 1, "Sale", None, None, None, 9)],
        "tickid long, pricetypeid long, price decimal(19,4), evEventDate timestamp_ntz, "
        "Activity long, userid long, contactid long, qty long, status string, guideid long, "
        "fees decimal(29,4), paymentid long, last_transact_no long")
    body = xml_batches(product, "tickets").first().body
    assert "<Price__c>10.5000</Price__c><Date_Time__c>2014-10-01T09:05:00</Date_Time__c>" in body
    assert "<Guide__c>" not in body and "<Fees__c>" not in body


def test_empty_product_gives_no_batches(spark):
    product = spark.createDataFrame([], "cltcode long, cltfirstname string, cltSurName string, "
                                        "cltEmail string")
    assert number_batches(product, ["cltcode"]).count() == 0
    assert xml_batches(product, "contacts").count() == 0
    assert load(product, "contacts", echo).count() == 0


def test_timestamp_text_shows_milliseconds_only_when_present(spark):
    import datetime as dt
    from turnstile.operators.xml import xml_text
    df = spark.createDataFrame([(dt.datetime(2014, 10, 1, 9, 5),), (dt.datetime(2014, 10, 1, 9, 5, 7, 123000),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(xml_text(df, "t")).collect()] == [
        "2014-10-01T09:05:00", "2014-10-01T09:05:07.123"]
