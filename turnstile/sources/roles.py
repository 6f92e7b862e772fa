"""Present the driver's star-schema tables as ticketing sources.

The staging jobs are written against the ticketing schema
(:mod:`turnstile.sources.schemas`).  The test and bench data are the
driver's ``orders/lineitem/customer/nation/region/part/supplier`` tables, so
this module maps them onto ticketing roles with plain projections and
key-preserving joins.  Every role reads the given tables, so its size grows
with the scale factor; nothing here is sampled or capped.

Role map (one ticket per order line, one receipt per line item)::

    tickets               <- distinct (order, line number) x orders
                             (id = order * 8 + line; all tickets of an order
                             share its price, date, contact and status)
    events                <- orders x customer      (show = customer nation,
                                                     time of day in 15-min slots)
    shows                 <- nation                 (duration 30 + 5*key min;
                                                     nation 24 has none)
    shifts                <- orders x customer x nation  (till = region;
                                                     1-URGENT = not a sale shift)
    till                  <- region
    clients               <- customer  (BUILDING = blank first name,
                                        FURNITURE = NULL first name)
    recieptbase           <- lineitem  (pay type A=1, N=2, R=9: 9 has no paytype)
    paytype               <- region
    recieptcredit         <- lineitem with return flag A (card receipts)
    calculatedcommission  <- lineitem  (extended price x tax, per ticket)
    get_orderguides       <- lineitem with line number 1 (guide of the line-1
                                        ticket = supplier, none when the
                                        discount is 0)
    pricetype             <- distinct order priorities
    pricediscount         <- part
    pricelist             <- nation
    crm_users / crossref / guiders <- supplier
    ordercontacts         <- orders
    clientaddresses / addresses    <- customer (MACHINERY: not a mailing address)
    clientphonenumbers    <- orders (several numbers per client)

The receipt id is a 38-digit number of every column that a receipt's values
depend on (see :func:`receipt_id`), so rows that share an id are equal in all
that "first receipt" picks, and no pick depends on row order.  Production
ticketing sources carry their own ids and do not go through this module.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def _dec(c) -> F.Column:
    return F.col(c).cast("decimal(19,4)")


def receipt_id() -> F.Column:
    """Receipt id of a line item, ``decimal(38,0)``: order (12 digits), ship day
    since 1990 (4), line status and return flag (1), part (11), line number (1)
    and supplier (9).  Larger orders overflow, which ANSI arithmetic reports; days before 1990 or after 2017-05-17 raise."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")).cast("bigint")
    late = F.raise_error(F.lit("a receipt's ship day does not fit the four digits of its id")).cast("bigint")
    day = F.when(day.isNull() | day.between(0, 9999), day).otherwise(late)
    flag = (F.when(F.col("l_linestatus") == "F", 3).otherwise(0)
            + F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2))
    high = (F.col("l_orderkey").cast("bigint") * 10000 + day) * 10 + flag
    low = F.col("l_partkey").cast("bigint") * 10 + F.col("l_linenumber")
    wide = "decimal(38,0)"
    return ((high.cast(wide) * F.lit(Decimal(10) ** 21)).cast(wide)
            + (low.cast("decimal(19,0)") * F.lit(Decimal(10) ** 9)).cast(wide)
            + F.col("l_suppkey").cast(wide)).cast(wide)


def ticket_id() -> F.Column:
    """Ticket id of an (order, line number) pair."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def tickets_from_orders(o: DataFrame, lines: DataFrame) -> DataFrame:
    """The tickets role: one ticket per distinct (order, line number) of
    ``lines`` (a line-item frame), carrying its order's attributes.  Used on
    the whole orders table and on each streamed batch of orders."""
    # dealt by order first: the distinct pairs then lie as their orders do, in one exchange
    pairs = lines.select("l_orderkey", "l_linenumber").repartition("l_orderkey").distinct()
    return o.join(pairs, o.o_orderkey == pairs.l_orderkey).select(
        ticket_id().alias("ticode"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("tipricetype"),
        _dec("o_totalprice").alias("tifullprice"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("timailinglist"),
        F.col("o_orderkey").alias("titransactnum"),
        F.when(F.col("o_orderstatus") == "F", F.lit(9))
         .when(F.col("o_orderstatus") == "O", F.lit(0)).cast("int").alias("tistatus"),
        F.col("o_orderkey").alias("tievent"),
        F.col("o_orderkey").alias("tishift"),
        F.col("o_orderkey").alias("tiorder"),
    )


def driver_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Ticketing source set over ``sf_dir/<table>.parquet``."""
    t = {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in DRIVER_TABLES}
    o, l, c, n, r = t["orders"], t["lineitem"], t["customer"], t["nation"], t["region"]
    p, s = t["part"], t["supplier"]

    tickets = tickets_from_orders(o, l)
    cust_nation = c.select("c_custkey", F.col("c_nationkey").cast("bigint").alias("nk"))
    oc = o.join(cust_nation, o.o_custkey == cust_nation.c_custkey)
    events = oc.select(
        F.col("o_orderkey").alias("evcode"),
        F.col("nk").alias("evshow"),
        F.timestamp_add("MINUTE", (F.col("o_orderkey") % 96) * 15, F.col("o_orderdate"))
         .alias("eveventdate"),
        F.col("nk").alias("evpricelist"),
    )
    shows = n.select(
        F.col("n_nationkey").cast("bigint").alias("shcode"),
        F.col("n_name").alias("shdescr"),
        F.when(F.col("n_nationkey") != 24, 30 + 5 * F.col("n_nationkey")).cast("int")
         .alias("shlongminutes"),
    )
    nation_region = n.select(F.col("n_nationkey").cast("bigint").alias("nk2"),
                             F.col("n_regionkey").cast("bigint").alias("rk"))
    shifts = (oc.join(nation_region, oc.nk == nation_region.nk2)
              .select(F.col("o_orderkey").alias("sfcode"),
                      F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
                       .cast("int").alias("sfactiontype"),
                      F.col("rk").alias("sftill"),
                      F.timestamp_add("DAY", F.lit(-1), F.col("o_orderdate")).alias("sfactiondate")))
    till = r.select(F.col("r_regionkey").cast("bigint").alias("tilcode"),
                    F.col("r_name").alias("tildescr"))
    clients = c.select(
        F.col("c_custkey").alias("cltcode"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  "))
         .when(F.col("c_mktsegment") == "FURNITURE", F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("cltfirstname"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("Smith & <"), _s("c_nationkey"), F.lit(">")))
         .otherwise(F.concat(F.lit("Family "), _s("c_nationkey"))).alias("cltsurname"),
        F.concat(F.lit("c"), _s("c_custkey"), F.lit("@mail.test")).alias("cltemail"),
    )
    recieptbase = l.select(
        receipt_id().alias("rcbcode"),
        F.col("l_orderkey").alias("rcbtransactnum"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .otherwise(9).cast("bigint").alias("rcbpaytype"),
        F.col("l_shipdate").alias("rcbshiftdate"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).cast("int").alias("rcbcachinout"),
        _dec("l_extendedprice").alias("rcbpayamount"),
    )
    paytype = r.select(F.col("r_regionkey").cast("bigint").alias("ptcode"),
                       F.col("r_name").alias("ptdescr"))
    recieptcredit = l.filter(F.col("l_returnflag") == "A").select(
        receipt_id().alias("rcccode"),
        F.when(F.col("l_linenumber") != 1,
               F.concat(F.lit("4000"), F.lpad(_s("l_partkey"), 6, "0"))).alias("rcccreditnum"),
        F.concat(F.lit('<params card_name="Holder '), _s("l_suppkey"),
                 F.lit(' &amp; Co" type="visa"/>')).alias("rccparamsdata"),
    )
    calculatedcommission = l.select(
        ticket_id().alias("clcticketnum"),
        (_dec("l_extendedprice") * _dec("l_tax")).cast("decimal(19,4)").alias("clcsum"),
    )
    get_orderguides = l.filter(F.col("l_linenumber") == 1).select(
        F.col("l_orderkey").alias("gogordernumber"),
        ticket_id().alias("gogticketid"),
        F.when(F.col("l_discount") != 0, F.col("l_suppkey")).alias("gogguidenumber"),
    )
    pricetype = o.select(
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("pctcode"),
        F.col("o_orderpriority").alias("pctdescr"),
    ).distinct()
    pricediscount = p.select(
        (F.col("p_size") % 5 + 1).cast("bigint").alias("pdpricetype"),
        (F.col("p_partkey") % 25).alias("pdpricelist"),
        _dec("p_retailprice").alias("pdcalculatedprice"),
    )
    pricelist = n.select(F.col("n_nationkey").cast("bigint").alias("prlcode"))
    crm_users = s.select(
        F.concat(F.lit("U"), _s("s_suppkey")).alias("id"),
        F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(""))).alias("user_name"),
        F.lit("Guide").alias("first_name"),
        F.concat(F.lit("Nr "), _s("s_suppkey")).alias("last_name"),
    )
    crossref = s.select(
        F.concat(F.lit("U"), _s("s_suppkey")).alias("sugarid"),
        F.when(F.col("s_acctbal") < 0, F.lit("Accounts")).otherwise(F.lit("Users")).alias("sugarmodule"),
        F.col("s_suppkey").alias("pecode"),
    )
    guiders = s.select(F.col("s_suppkey").alias("gdrcode"),
                       F.col("s_suppkey").alias("gdrcontactnoinreltable"))
    ordercontacts = o.select(
        F.col("o_orderkey").alias("orcrecordid"),
        F.col("o_orderkey").alias("orcordernumber"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Buyer "), _s("o_custkey")))
         .otherwise(F.concat(F.lit("Guest "), _s("o_custkey"))).alias("orcfullname"),
    )
    clientaddresses = c.select(
        F.col("c_custkey").alias("claclientcode"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 0).otherwise(1).cast("int").alias("claisformailing"),
        F.col("c_custkey").alias("claaddresscode"),
    )
    addresses = c.select(
        F.col("c_custkey").alias("adrcode"),
        F.concat(_s("c_custkey"), F.lit(" Main St")).alias("adraddress1"),
        F.when(F.col("c_acctbal") < 0, F.lit("Apt 1")).alias("adraddress2"),
        F.concat(F.lit("City "), _s("c_nationkey")).alias("adrcitydesc"),
        F.lit("ST").alias("adrstatedesc"),
        F.lpad(_s("c_custkey"), 8, "0").alias("adrzipcode"),
        F.concat(F.lit("Country "), _s("c_nationkey")).alias("adrcountrydesc"),
    )
    clientphonenumbers = o.select(
        F.col("o_custkey").alias("cpnclientcode"),
        F.concat(F.lit("555-"), F.lpad(_s("o_orderkey"), 8, "0")).alias("cpnphonenumber"),
    )
    return {
        "tickets": tickets, "events": events, "shows": shows, "shifts": shifts, "till": till,
        "clients": clients, "recieptbase": recieptbase, "paytype": paytype,
        "recieptcredit": recieptcredit, "calculatedcommission": calculatedcommission,
        "get_orderguides": get_orderguides, "pricetype": pricetype,
        "pricediscount": pricediscount, "pricelist": pricelist, "crm_users": crm_users,
        "crossref": crossref, "guiders": guiders, "ordercontacts": ordercontacts,
        "clientaddresses": clientaddresses, "addresses": addresses,
        "clientphonenumbers": clientphonenumbers,
    }
