"""DuckDB oracle SQL for the registered driver queries.

Written independently of the Spark code: ranked receipts, window minima for the
two backfills, grouped joins for amounts, cards and prices.  The ``tk_*`` views
present the driver tables in ticketing roles exactly as
:mod:`turnstile.sources.roles` does; ``tests/test_sources.py`` checks the roles
themselves.  Money is compared as DOUBLE (exact decimal sums, then one
conversion), the 38-digit payment ids as text.
"""

from __future__ import annotations

from turnstile.operators.xml import ENTITIES
from turnstile.registry import HI, HWM_NOW, HWM_PREV_HI, LO, PROFILE

_RCB = """(CAST(l_orderkey AS HUGEINT) * 10000 + date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE))) * 10000000000000000000000
           + (CASE WHEN l_linestatus = 'F' THEN 3 ELSE 0 END + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) * 1000000000000000000000
           + (CAST(l_partkey AS HUGEINT) * 10 + l_linenumber) * 1000000000 + l_suppkey"""

ROLES = f"""
tk_tickets AS (
  SELECT lp.l_orderkey * 8 + lp.l_linenumber AS ticode,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS tipricetype,
         CAST(o_totalprice AS DECIMAL(19,4)) AS tifullprice,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS timailinglist,
         o_orderkey AS titransactnum,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 9 WHEN o_orderstatus = 'O' THEN 0 END AS INTEGER) AS tistatus,
         o_orderkey AS tievent, o_orderkey AS tishift, o_orderkey AS tiorder
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) lp
  JOIN orders ON lp.l_orderkey = o_orderkey),
tk_events AS (
  SELECT o.o_orderkey AS evcode, CAST(c.c_nationkey AS BIGINT) AS evshow,
         o.o_orderdate + to_minutes(CAST((o.o_orderkey % 96) * 15 AS BIGINT)) AS eveventdate,
         CAST(c.c_nationkey AS BIGINT) AS evpricelist
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
tk_shows AS (
  SELECT CAST(n_nationkey AS BIGINT) AS shcode, n_name AS shdescr,
         CAST(CASE WHEN n_nationkey <> 24 THEN 30 + 5 * n_nationkey END AS INTEGER) AS shlongminutes
  FROM nation),
tk_shifts AS (
  SELECT o.o_orderkey AS sfcode,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS sfactiontype,
         CAST(n.n_regionkey AS BIGINT) AS sftill, o.o_orderdate - INTERVAL 1 DAY AS sfactiondate
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
tk_till AS (SELECT CAST(r_regionkey AS BIGINT) AS tilcode, r_name AS tildescr FROM region),
tk_clients AS (
  SELECT c_custkey AS cltcode,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' WHEN c_mktsegment = 'FURNITURE' THEN NULL
              ELSE c_name END AS cltfirstname,
         CASE WHEN c_acctbal < 0 THEN 'Smith & <' || CAST(c_nationkey AS VARCHAR) || '>'
              ELSE 'Family ' || CAST(c_nationkey AS VARCHAR) END AS cltsurname,
         'c' || CAST(c_custkey AS VARCHAR) || '@mail.test' AS cltemail
  FROM customer),
tk_recieptbase AS (
  SELECT {_RCB} AS rcbcode, l_orderkey AS rcbtransactnum,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 ELSE 9 END AS BIGINT) AS rcbpaytype,
         l_shipdate AS rcbshiftdate,
         CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS rcbcachinout,
         CAST(l_extendedprice AS DECIMAL(19,4)) AS rcbpayamount
  FROM lineitem),
tk_paytype AS (SELECT CAST(r_regionkey AS BIGINT) AS ptcode, r_name AS ptdescr FROM region),
tk_recieptcredit AS (
  SELECT {_RCB} AS rcccode,
         CASE WHEN l_linenumber <> 1 THEN '4000' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') END AS rcccreditnum,
         '<params card_name="Holder ' || CAST(l_suppkey AS VARCHAR) || ' &amp; Co" type="visa"/>' AS rccparamsdata
  FROM lineitem WHERE l_returnflag = 'A'),
tk_calculatedcommission AS (
  SELECT l_orderkey * 8 + l_linenumber AS clcticketnum,
         CAST(CAST(l_extendedprice AS DECIMAL(19,4)) * CAST(l_tax AS DECIMAL(19,4)) AS DECIMAL(19,4)) AS clcsum
  FROM lineitem),
tk_get_orderguides AS (
  SELECT l_orderkey AS gogordernumber, l_orderkey * 8 + 1 AS gogticketid,
         CASE WHEN l_discount <> 0 THEN l_suppkey END AS gogguidenumber
  FROM lineitem WHERE l_linenumber = 1),
tk_pricetype AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS pctcode, o_orderpriority AS pctdescr
  FROM orders),
tk_pricediscount AS (
  SELECT CAST(p_size % 5 + 1 AS BIGINT) AS pdpricetype, p_partkey % 25 AS pdpricelist,
         CAST(p_retailprice AS DECIMAL(19,4)) AS pdcalculatedprice
  FROM part),
tk_pricelist AS (SELECT CAST(n_nationkey AS BIGINT) AS prlcode FROM nation),
tk_crm_users AS (
  SELECT 'U' || CAST(s_suppkey AS VARCHAR) AS id, lower(replace(s_name, '#', '')) AS user_name,
         'Guide' AS first_name, 'Nr ' || CAST(s_suppkey AS VARCHAR) AS last_name
  FROM supplier),
tk_crossref AS (
  SELECT 'U' || CAST(s_suppkey AS VARCHAR) AS sugarid,
         CASE WHEN s_acctbal < 0 THEN 'Accounts' ELSE 'Users' END AS sugarmodule, s_suppkey AS pecode
  FROM supplier),
tk_guiders AS (SELECT s_suppkey AS gdrcode, s_suppkey AS gdrcontactnoinreltable FROM supplier),
tk_ordercontacts AS (
  SELECT o_orderkey AS orcrecordid, o_orderkey AS orcordernumber,
         CASE WHEN o_orderstatus = 'F' THEN 'Buyer ' ELSE 'Guest ' END || CAST(o_custkey AS VARCHAR) AS orcfullname
  FROM orders),
tk_clientaddresses AS (
  SELECT c_custkey AS claclientcode, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 1 END AS claisformailing,
         c_custkey AS claaddresscode
  FROM customer),
tk_addresses AS (
  SELECT c_custkey AS adrcode, CAST(c_custkey AS VARCHAR) || ' Main St' AS adraddress1,
         CASE WHEN c_acctbal < 0 THEN 'Apt 1' END AS adraddress2,
         'City ' || CAST(c_nationkey AS VARCHAR) AS adrcitydesc, 'ST' AS adrstatedesc,
         lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS adrzipcode,
         'Country ' || CAST(c_nationkey AS VARCHAR) AS adrcountrydesc
  FROM customer),
tk_clientphonenumbers AS (
  SELECT o_custkey AS cpnclientcode, '555-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cpnphonenumber
  FROM orders)"""


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def scope_sql(lo: str, hi: str) -> str:
    """Tickets of shown events in the window that were sold at a known till."""
    return f"""SELECT tk_tickets.*, evcode, evshow, eveventdate, evpricelist, evshow AS shcode,
       sfcode, sftill, sfactiondate, sftill AS tilcode
  FROM (SELECT * FROM tk_shifts SEMI JOIN tk_till ON tilcode = sftill WHERE sfactiontype = 0) sale
  JOIN tk_tickets ON tishift = sfcode
  JOIN (SELECT * FROM tk_events SEMI JOIN tk_shows ON shcode = evshow
        WHERE eveventdate >= {lo} AND eveventdate <= {hi}) occasion ON tievent = evcode"""


def scope_keys(column: str, lo: str, hi: str) -> str:
    return f"SELECT DISTINCT {column} FROM ({scope_sql(lo, hi)}) sk"


def working_set_ctes(p: str, lo: str, hi: str, group_by: str = "show") -> str:
    """CTEs ending in ``{p}ws``: ranked receipts and summed fees joined to the
    scope, class minima as window aggregates."""
    strict = ["tipricetype", "tifullprice", "eveventdate", "shcode" if group_by == "show" else "evcode",
              "tilcode", "timailinglist", "tistatus"]
    loose = ["COALESCE(guideid, 0)", "COALESCE(ptdescr, '')", "COALESCE(rcbshiftdate, TIMESTAMP '2000-01-01 00:00:00')"]
    paid_by = ["timailinglist", "ptdescr", "rcbshiftdate", "rcbcachinout"]

    def lowest(value: str, keys: list[str], more: list[str]) -> str:
        known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        return f"CASE WHEN {known} THEN COALESCE(min({value}) OVER (PARTITION BY {', '.join(keys + more)}), 0) ELSE 0 END"

    return f"""
{p}receipt AS (
  SELECT rcbtransactnum AS txn, rcbshiftdate, rcbcachinout, min(rcbcode) OVER (PARTITION BY rcbtransactnum) AS low_receipt,
         row_number() OVER (PARTITION BY rcbtransactnum ORDER BY rcbcode) AS place
  FROM tk_recieptbase),
{p}paytype AS (
  SELECT rcbtransactnum AS txn, ptdescr, row_number() OVER (PARTITION BY rcbtransactnum ORDER BY rcbcode) AS place
  FROM tk_paytype JOIN tk_recieptbase ON ptcode = rcbpaytype),
{p}fee AS (SELECT clcticketnum AS ticket, sum(clcsum) AS fees FROM tk_calculatedcommission GROUP BY ALL),
{p}joined AS (
  SELECT sc.*, pay.ptdescr, one.rcbshiftdate, one.rcbcachinout, one.low_receipt, fee.fees, gogguidenumber AS guideid
  FROM ({scope_sql(lo, hi)}) sc
  LEFT JOIN {p}receipt one ON one.txn = sc.titransactnum AND one.place = 1
  LEFT JOIN {p}paytype pay ON pay.txn = sc.titransactnum AND pay.place = 1
  LEFT JOIN {p}fee fee ON fee.ticket = sc.ticode
  LEFT JOIN tk_get_orderguides ON gogticketid = sc.ticode AND gogordernumber = sc.tiorder),
{p}ws AS (
  SELECT *, {lowest('ticode', strict, loose)} AS minticode,
         {lowest('low_receipt', paid_by, [])} AS paymentid
  FROM {p}joined)"""


def ws_columns(group_by: str = "show", alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    ev = f"{a}evcode, " if group_by == "event" else ""
    return (f"{a}ticode, {a}tipricetype, CAST({a}tifullprice AS DOUBLE) AS tifullprice, {a}eveventdate, "
            f"{ev}{a}shcode, {a}tilcode, {a}timailinglist, {a}titransactnum, {a}ptdescr, "
            f"{a}rcbshiftdate, {a}rcbcachinout, CAST({a}fees AS DOUBLE) AS fees, {a}guideid, "
            f"{a}tistatus, {a}minticode, CAST({a}paymentid AS VARCHAR) AS paymentid")


def _shown(value: str, kind: str, stored: bool) -> str:
    return value if stored else f"CAST({value} AS {kind})"


def tickets_sql(ws: str, schedule: str | None = None, stored: bool = False) -> str:
    """tickets_temp; ``schedule="min_evcode"`` or the name of a schedule CTE
    for the range lookup; ``stored`` keeps the product's own types."""
    sched = ""
    if schedule == "min_evcode":
        sched = "min(evcode) AS activityscheduleid, "
    elif schedule:
        sched = (f"(SELECT min(s.id) FROM {schedule} s WHERE w.eveventdate BETWEEN s.startdate AND "
                 f"s.enddate AND w.shcode = s.activityid) AS activityscheduleid, ")
    return f"""SELECT minticode AS tickid, {sched}tipricetype AS pricetypeid,
       {_shown('tifullprice', 'DOUBLE', stored)} AS price, eveventdate AS evEventDate, shcode AS Activity,
       tilcode AS userid, timailinglist AS contactid, count(*) AS qty,
       CASE WHEN tistatus = 9 THEN 'Return' ELSE 'Sale' END AS status, guideid + 1000 AS guideid,
       {_shown('fees', 'DOUBLE', stored)} AS fees, {_shown('nullif(paymentid, 0)', 'VARCHAR', stored)} AS paymentid,
       max(titransactnum) AS last_transact_no
FROM {ws} w
GROUP BY minticode, tipricetype, tifullprice, eveventdate, shcode, tilcode, timailinglist, tistatus,
         guideid, fees, paymentid"""


def xml_attr_sql(name: str, text: str) -> str:
    """The attribute's value outside comments, its references resolved piece by piece after each ampersand."""
    body = f"regexp_replace({text}, '(?s)<!--.*?(-->|$)', '', 'g')"
    found = f"""regexp_extract({body}, '[ \\t\\r\\n]{name}[ \\t\\r\\n]*=[ \\t\\r\\n]*("[^"]*"|''[^'']*'')', 1)"""
    inner = f"nullif(substr({found}, 2, length({found}) - 2), '')"
    code = "CASE WHEN p LIKE '#x%' THEN try_cast('0x' || regexp_extract(p, '^#x0*([0-9A-Fa-f]{1,6});', 1) AS INTEGER) " \
           "ELSE try_cast(regexp_extract(p, '^#0*([0-9]{1,7});', 1) AS INTEGER) END"
    named = " ".join(f"WHEN p LIKE '{n};%' THEN {c} || substr(p, {len(n) + 2})" for n, c in
                     (("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("apos", "chr(39)"), ("amp", "'&'")))
    sign = f"({code}) IN (9, 10, 13) OR ({code}) BETWEEN 32 AND 55295 OR ({code}) BETWEEN 57344 AND 65533 OR ({code}) BETWEEN 65536 AND 1114111"
    piece = f"CASE {named} WHEN {sign} THEN chr({code}) || substr(p, strpos(p, ';') + 1) ELSE '&' || p END"
    parts = f"string_split({inner}, '&')"
    return f"array_to_string(list_concat({parts}[1:1], list_transform({parts}[2:], lambda p: {piece})), '')"


def payments_sql(ws: str, card_default: bool = True, stored: bool = False) -> str:
    """payments_temp from three grouped parts: payments, their cards, their amounts."""
    number = "COALESCE(card.number, '')" if card_default else "card.number"
    return f"""SELECT {_shown('pay.paymentid', 'VARCHAR', stored)} AS paymentid, pay.ptdescr AS type, pay.rcbshiftdate AS trandate,
       if(pay.rcbcachinout = 1, 'Refund', 'Receipt') AS mode, pay.last_no AS last_transact_no,
       {number} AS lastCardNum, card.holder AS lastCardName, {_shown('total.amount', 'DOUBLE', stored)} AS amount
FROM (SELECT paymentid, timailinglist, ptdescr, rcbshiftdate, rcbcachinout, max(titransactnum) AS last_no
      FROM {ws} GROUP BY ALL HAVING paymentid > 0) pay
LEFT JOIN (SELECT rcccode, max(rcccreditnum) AS number, max({xml_attr_sql('card_name', 'rccparamsdata')}) AS holder
           FROM tk_recieptcredit GROUP BY rcccode) card ON card.rcccode = pay.paymentid
LEFT JOIN (SELECT paymentid, sum(paid) AS amount
           FROM (SELECT DISTINCT paymentid, titransactnum FROM {ws})
           JOIN (SELECT rcbtransactnum, sum(rcbpayamount) AS paid FROM tk_recieptbase GROUP BY rcbtransactnum)
             ON rcbtransactnum = titransactnum
           GROUP BY paymentid) total ON total.paymentid = pay.paymentid"""


def contacts_sql(lo: str, hi: str) -> str:
    return f"""SELECT cltcode, cltfirstname, cltsurname AS cltSurName, cltemail AS cltEmail
FROM tk_clients WHERE cltcode IN ({scope_keys('timailinglist', lo, hi)})"""


def _slots(lo: str | None = None, hi: str | None = None) -> str:
    """Events with the text of their start and finish times."""
    window = f"WHERE eveventdate BETWEEN {lo} AND {hi}" if lo else ""
    return f"""(SELECT evcode, evshow, evpricelist, eveventdate, strftime(eveventdate, '%H:%M') AS starttime,
       strftime(eveventdate + to_minutes(shlongminutes), '%H:%M') AS finishtime
  FROM tk_events JOIN tk_shows ON shcode = evshow {window})"""


def schedule_sql(lo: str, hi: str, activities: str | None = None) -> str:
    days = ", ".join(f"'True' AS {d}avail" for d in
                     ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"))
    only = f"SEMI JOIN {activities} chosen ON chosen.activityid = slot.evshow" if activities else ""
    return f"""SELECT min(evcode) AS id, evshow AS activityid, {days},
       min(eveventdate) AS startdate, max(eveventdate) AS enddate, starttime, finishtime
FROM {_slots(lo, hi)} slot {only}
GROUP BY ALL"""


def _minute_of(t: str) -> str:
    return f"CAST(hour(strptime({t}, '%H:%M')) * 60 + minute(strptime({t}, '%H:%M')) AS INTEGER)"


def price_sql(lo: str, hi: str, restrict_events: bool) -> str:
    """Lowest event and price of each slot and price type, both reduced by price list first."""
    slots = _slots(lo, hi) if restrict_events else _slots()
    return f"""SELECT min(slot.first_event) AS activityscheduleid, offer.pctcode AS pricetypeid,
       CAST(min(offer.price) AS DOUBLE) AS price
FROM (SELECT evpricelist, evshow, starttime, finishtime, min(evcode) AS first_event FROM {slots} GROUP BY ALL) slot
JOIN (SELECT pdpricelist, pctcode, min(pdcalculatedprice) AS price
      FROM tk_pricediscount JOIN tk_pricetype ON pctcode = pdpricetype
      SEMI JOIN tk_pricelist ON prlcode = pdpricelist
      SEMI JOIN ({scope_keys('tipricetype', lo, hi)}) used ON used.tipricetype = pctcode
      GROUP BY ALL) offer ON offer.pdpricelist = slot.evpricelist
GROUP BY slot.evshow, slot.starttime, slot.finishtime, offer.pctcode"""


_NAMED = "trim(cltfirstname) <> ''"
_ADDRESS = "adraddress1, adraddress2, adrcitydesc, adrstatedesc, adrzipcode, adrcountrydesc"
#: a client's mailing address, and the smallest of the phone numbers
_MAIL = f"""(SELECT claclientcode AS resident, {_ADDRESS}
        FROM tk_addresses JOIN tk_clientaddresses ON claaddresscode = adrcode WHERE claisformailing = 1)"""
_RING = "(SELECT cpnclientcode AS owner, min(cpnphonenumber) AS phone FROM tk_clientphonenumbers GROUP BY ALL)"


def accounts_sql(lo: str, hi: str) -> str:
    """Named clients by order contact, unnamed ones by themselves, from one visitor list."""
    return f"""SELECT DISTINCT * FROM (
  SELECT CASE WHEN named THEN min(contact) OVER (PARTITION BY named, cltcode, cltEmail, fullname, {_ADDRESS}) ELSE cltcode END AS recid,
         cltEmail, CASE WHEN named THEN fullname ELSE cltsurname END AS orcfullname, {_ADDRESS}, phone
  FROM (SELECT cltcode, cltemail AS cltEmail, cltsurname, {_NAMED} AS named, orcrecordid AS contact, orcfullname AS fullname,
               mail.* EXCLUDE (resident), ring.phone
        FROM (SELECT DISTINCT timailinglist AS visitor, tiorder FROM tk_tickets
              SEMI JOIN (SELECT evcode FROM tk_events WHERE eveventdate BETWEEN {lo} AND {hi}) seen ON seen.evcode = tievent)
        JOIN tk_clients ON cltcode = visitor
        JOIN tk_ordercontacts ON orcordernumber = tiorder
        LEFT JOIN {_MAIL} mail ON resident = cltcode
        LEFT JOIN {_RING} ring ON owner = cltcode
        WHERE cltfirstname IS NOT NULL))"""


def contacts_enriched_sql(lo: str, hi: str) -> str:
    return f"""SELECT cltcode, cltfirstname, cltsurname AS cltSurName, cltemail AS cltEmail, {_ADDRESS}, phone
FROM (SELECT * FROM tk_clients SEMI JOIN ({scope_keys('timailinglist', lo, hi)}) guest ON timailinglist = cltcode WHERE {_NAMED})
LEFT JOIN {_RING} ON owner = cltcode
LEFT JOIN {_MAIL} ON resident = cltcode"""


def orders_sql(lo: str, hi: str, accounts: str) -> str:
    """Orders by payer, named and unnamed ones from one list of visits; an unnamed payer is their own account."""
    day = lambda c: f"strftime(min({c}), '%m/%d/%Y')"
    return f"""SELECT ordernumber, accountid, payer AS billingcontactid, {day('seen')} AS visitdate, {day('ordered')} AS orderstartdate
FROM (SELECT ordernumber, seen, ordered, if(named, recid, cltcode) AS accountid, if(named, cltcode, 0) AS payer
      FROM (SELECT tiorder AS ordernumber, cltcode, {_NAMED} AS named, eveventdate AS seen, sfactiondate AS ordered
            FROM tk_clients JOIN tk_tickets ON timailinglist = cltcode
            JOIN (SELECT sfcode, sfactiondate FROM tk_shifts WHERE sfactiontype = 0) ON sfcode = tishift
            JOIN (SELECT evcode, eveventdate FROM tk_events WHERE eveventdate BETWEEN {lo} AND {hi}) ON evcode = tievent
            WHERE cltfirstname IS NOT NULL)
      LEFT JOIN (SELECT orcordernumber, orcrecordid AS recid FROM tk_ordercontacts
                 WHERE orcrecordid IN (SELECT recid FROM {accounts})) ON named AND orcordernumber = ordernumber
      WHERE recid IS NOT NULL OR NOT named)
GROUP BY ordernumber, accountid, payer"""


def users_sql(lo: str, hi: str, tickets: str) -> str:
    """Guides on sold tickets and tills in scope as one list of logins, dressed with the profile's constants once."""
    f = PROFILE
    return f"""SELECT login || '{f.email_suffix}' AS username, first_name, last_name, email, externalid,
       last_name || '{f.nickname_suffix}' AS communityNickname, '{f.time_zone}' AS TimeZoneSidKey, '{f.locale}' AS LocaleSidKey,
       '{f.email_encoding}' AS EmailEncodingKey, '{f.language}' AS LanguageLocaleKey, last_name || '{f.nickname_suffix}' AS Alias,
       '{f.profile_id}' AS ProfileId
FROM (SELECT user_name AS login, first_name, last_name, cltemail || '{f.email_tag}' AS email, gdrcode AS externalid
      FROM tk_guiders JOIN tk_clients ON cltcode = gdrcontactnoinreltable
      JOIN (SELECT * FROM tk_crossref JOIN tk_crm_users ON sugarid = id WHERE sugarmodule = 'Users') ON pecode = gdrcode
      SEMI JOIN (SELECT DISTINCT guideid FROM {tickets}) sold ON guideid = gdrcode + 1000
      UNION ALL
      SELECT name, '', name, name || '{f.email_suffix}', tilcode
      FROM (SELECT tilcode, translate(tildescr, ' ', '_') AS name FROM tk_till)
      SEMI JOIN ({scope_keys('tilcode AS used', lo, hi)}) scope ON used = tilcode)"""


def _esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


#: columns serialized as timestamps
_TIMES = {"evEventDate", "trandate"}


def xml_payload_sql(rows: str, product: str) -> str:
    """Request bodies of a product: rows in key order, 100 to a batch."""
    ent = ENTITIES[product]

    def text(c: str) -> str:
        return f"strftime({c}, '%Y-%m-%dT%H:%M:%S')" if c in _TIMES else f"CAST({c} AS VARCHAR)"

    columns = [c for c, _ in ent.fields]
    order = ", ".join(f"{c} NULLS FIRST" for c in [ent.key, *(c for c in columns if c != ent.key)])
    parts = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN '<{f}>' || {_esc(text(c))} || '</{f}>' END"
                      for c, f in ent.fields)
    return f"""numbered AS (
  SELECT row_number() OVER (ORDER BY {order}) AS rn,
         '<{ent.element}>' || concat_ws('', {parts}) || '</{ent.element}>' AS xml
  FROM {rows})
SELECT (rn - 1) // 100 AS batch_id, count(*) AS n_rows,
       '<request><req>' || string_agg(xml, '' ORDER BY rn) || '</req></request>' AS body
FROM numbered GROUP BY (rn - 1) // 100"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in (ROLES, *ctes) if c.strip())


def build() -> dict[str, str]:
    lo, hi = ts(LO), ts(HI)
    ws_show = working_set_ctes("s_", lo, hi, "show")
    ws_event = working_set_ctes("e_", lo, hi, "event")
    q: dict[str, str] = {}
    q["contacts_semi"] = f"{_with()}\n{contacts_sql(lo, hi)}"
    q["dim_pricetypes"] = (f"{_with()}\nSELECT pctcode AS pricetypeid, pctdescr AS description "
                           f"FROM tk_pricetype WHERE pctcode IN ({scope_keys('tipricetype', lo, hi)})")
    q["dim_activities"] = (f"{_with()}\nSELECT shcode AS activityid, shdescr AS description "
                           f"FROM tk_shows WHERE shcode IN ({scope_keys('shcode', lo, hi)})")
    q["ticket_scope"] = (f"{_with()}\nSELECT ticode, evcode, eveventdate, shcode, tilcode, timailinglist, "
                         f"sfactiondate FROM ({scope_sql(lo, hi)}) q")
    q["guide_left_join"] = (f"{_with()}\nSELECT sc.ticode, g.gogguidenumber AS guideid "
                            f"FROM ({scope_sql(lo, hi)}) sc LEFT JOIN tk_get_orderguides g "
                            f"ON g.gogordernumber = sc.tiorder AND g.gogticketid = sc.ticode")
    q["first_match"] = f"""{_with()}
SELECT rcbtransactnum, arg_min(ptdescr, rcbcode) AS ptdescr, arg_min_null(rcbshiftdate, rcbcode) AS rcbshiftdate,
       arg_min_null(rcbcachinout, rcbcode) AS rcbcachinout
FROM tk_recieptbase LEFT JOIN tk_paytype ON ptcode = rcbpaytype
GROUP BY ALL"""
    q["fees_lookup"] = f"""{_with()}
SELECT t.ticode, CAST((SELECT sum(cc.clcsum) FROM tk_calculatedcommission cc
                      WHERE cc.clcticketnum = t.ticode) AS DOUBLE) AS fees
FROM tk_tickets t"""
    q["group_min_backfill"] = """WITH d AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS prio FROM orders),
g AS (SELECT min(o_orderkey) AS m, o_custkey, status, prio FROM d GROUP BY o_custkey, status, prio)
SELECT d.o_orderkey, d.o_custkey, d.status, d.prio,
       COALESCE((SELECT min(g.m) FROM g WHERE d.o_custkey = g.o_custkey AND d.status = g.status
                 AND COALESCE(d.prio, '5-LOW') = COALESCE(g.prio, '5-LOW')), 0) AS minkey
FROM d"""
    q["payment_backfill"] = (f"{_with(ws_show)}\nSELECT ticode, timailinglist, ptdescr, rcbshiftdate, "
                             f"rcbcachinout, CAST(paymentid AS VARCHAR) AS paymentid FROM s_ws")
    q["working_set"] = f"{_with(ws_show)}\nSELECT {ws_columns('show')} FROM s_ws"
    q["staged_working_set"] = q["working_set"]
    q["ticket_rollup"] = f"{_with(ws_show)}\n{tickets_sql('s_ws')}"
    # one micro-batch holding every order: the streamed ticket product is the
    # batch roll-up
    q["sync_stream"] = q["ticket_rollup"]
    # tickets that arrive in several batches or runs end with the ids of one run
    q["stream_tickets"] = q["ticket_rollup"]
    q["ids_across_runs"] = f"{_with(ws_show)}\nSELECT ticode, minticode, CAST(paymentid AS VARCHAR) AS paymentid FROM s_ws"
    q["payment_rollup"] = f"{_with(ws_show)}\n{payments_sql('s_ws', True)}"
    q["stream_payments"] = q["payment_rollup"]
    q["dump_working_set"] = f"{_with(ws_event)}\nSELECT {ws_columns('event')} FROM e_ws"
    q["dump_tickets"] = f"{_with(ws_event)}\n{tickets_sql('e_ws', 'min_evcode')}"
    q["dump_payments"] = f"{_with(ws_event)}\n{payments_sql('e_ws', False)}"
    acts = (f"acts AS (SELECT shcode AS activityid FROM tk_shows "
            f"WHERE shcode IN ({scope_keys('shcode', lo, hi)}))")
    day_sched = f"dsched AS ({schedule_sql(lo, hi, 'acts')})"
    q["range_lookup"] = f"{_with(ws_event, acts, day_sched)}\n{tickets_sql('e_ws', 'dsched')}"
    q["activity_schedule"] = f"{_with()}\n{schedule_sql(lo, hi)}"
    q["day_activity_schedule"] = f"{_with(acts)}\n{schedule_sql(lo, hi, 'acts')}"
    q["price_schedule"] = f"{_with()}\n{price_sql(lo, hi, False)}"
    q["day_price_schedule"] = f"{_with()}\n{price_sql(lo, hi, True)}"
    sched = f"sched AS ({schedule_sql(lo, hi)})"
    q["lookup_times"] = f"""{_with(sched)}
SELECT starttime AS timevalue, {_minute_of('starttime')} AS min FROM sched
UNION
SELECT finishtime, {_minute_of('finishtime')} FROM sched"""
    tix = f"tix AS ({tickets_sql('s_ws')})"
    q["users_union"] = f"{_with(ws_show, tix)}\n{users_sql(lo, hi, 'tix')}"
    q["accounts_union"] = f"{_with()}\n{accounts_sql(lo, hi)}"
    q["contacts_enriched"] = f"{_with()}\n{contacts_enriched_sql(lo, hi)}"
    q["orders_visit"] = f"{_with(f'acc AS ({accounts_sql(lo, hi)})')}\n{orders_sql(lo, hi, 'acc')}"
    q["batch_number"] = f"""{_with()}
SELECT ticode, row_number() OVER (ORDER BY ticode) AS rn,
       (row_number() OVER (ORDER BY ticode) - 1) // 100 AS batch_id
FROM tk_tickets"""
    q["batch_key_closure"] = f"""{_with()},
nb AS (SELECT timailinglist,
              (row_number() OVER (ORDER BY timailinglist NULLS FIRST, ticode) - 1) // 100 AS batch_id
       FROM tk_tickets),
kc AS (SELECT timailinglist, count(*) AS n_rows FROM tk_tickets
       WHERE timailinglist IS NOT NULL GROUP BY timailinglist)
SELECT DISTINCT nb.batch_id, nb.timailinglist, kc.n_rows
FROM nb JOIN kc ON nb.timailinglist = kc.timailinglist"""
    con = f"con AS ({contacts_sql(lo, hi)})"
    q["xml_payload"] = f"{_with(con)},\n{xml_payload_sql('con', 'contacts')}"
    plain_tickets = f"tk AS ({tickets_sql('s_ws', stored=True)})"
    q["xml_tickets"] = f"{_with(ws_show, plain_tickets)},\n{xml_payload_sql('tk', 'tickets')}"
    plain_payments = f"pay AS ({payments_sql('s_ws', stored=True)})"
    q["xml_payments"] = f"{_with(ws_show, plain_payments)},\n{xml_payload_sql('pay', 'payments')}"
    coded = "replace(replace(replace(replace(replace(url, '/', '&#47;'), ':', '&#x3A;'), '.', '&amp;#46;'), 'e', '&#x065;'), 's', '&s;')"
    tag = f"""'<!-- a t="no" --><a t="' || {coded} || '&#0;&#xD800;&#39;&#x27;&#128512;"/>'"""
    q["xml_attribute"] = f"SELECT page_id, {xml_attr_sql('lang', 'html')} AS lang, {xml_attr_sql('t', tag)} AS t FROM pages"
    dims = [f"SELECT '{name}' AS product, {key} AS id, {text} AS description FROM {table} WHERE {key} IN ({scope_keys(used, lo, hi)})"
            for name, key, text, table, used in (("pricetypes", "pctcode", "pctdescr", "tk_pricetype", "tipricetype"),
                                                 ("activities", "shcode", "shdescr", "tk_shows", "shcode"))]
    q["published_dimensions"] = f"{_with()}\n{dims[0]}\nUNION ALL\n{dims[1]}"
    payload = xml_payload_sql("con", "contacts")
    q["push_receipts"] = (f"{_with(con)},\n" + payload.replace("\nSELECT (rn - 1) // 100", ",\nsent AS (SELECT (rn - 1) // 100", 1) + ")\n"
                          "SELECT 'contacts' AS entity, batch_id, n_rows, CAST(200 AS INTEGER) AS status, "
                          "'run/contacts/' || batch_id || ' ' || length(body) AS response FROM sent")
    q["planned_scan"] = """SELECT l_linenumber, count(*) AS n_rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
       min(l_orderkey) AS first_order, max(l_orderkey) AS last_order FROM lineitem WHERE l_quantity > 30 GROUP BY l_linenumber"""
    past = working_set_ctes("o_", lo, ts(HWM_PREV_HI), "show")
    late = working_set_ctes("n_", lo, ts(HWM_NOW), "show")
    q["ticket_changes"] = f"""{_with(past, late, f"past AS ({tickets_sql('o_ws')})", f"late AS ({tickets_sql('n_ws')})")},
bag AS (
  SELECT * EXCLUDE (sign), sum(sign) AS d FROM (SELECT *, 1 AS sign FROM late UNION ALL SELECT *, -1 FROM past) GROUP BY ALL
  HAVING sum(sign) <> 0)
SELECT CAST(tickid AS VARCHAR) AS tickid,
       CASE WHEN d > 0 THEN if(tickid IN (SELECT tickid FROM past), 'change', 'insert')
            ELSE if(tickid IN (SELECT tickid FROM late), 'replaced', 'tombstone') END AS kind,
       CAST(sum(abs(d)) AS BIGINT) AS n_rows
FROM bag GROUP BY ALL"""
    prev = working_set_ctes("p_", lo, ts(HWM_PREV_HI), "show")
    mark = "mark AS (SELECT COALESCE(max(eveventdate), TIMESTAMP '2016-02-01 00:00:00') AS m FROM p_ws)"
    inc = working_set_ctes("i_", "(SELECT m FROM mark)", ts(HWM_NOW), "show")
    q["hwm_increment"] = f"{_with(prev, mark, inc)}\nSELECT {ws_columns('show')} FROM i_ws"
    q["hwm_contacts"] = f"{_with(prev, mark, inc)}\n{contacts_sql('(SELECT m FROM mark)', ts(HWM_NOW))}"
    q["hwm_tickets"] = f"{_with(prev, mark, inc)}\n{tickets_sql('i_ws')}"
    q["hwm_payments"] = f"{_with(prev, mark, inc)}\n{payments_sql('i_ws', True)}"
    tk = f"tk AS ({tickets_sql('s_ws')})"
    pay = f"pay AS ({payments_sql('s_ws', True)})"
    q["record_counts"] = f"""{_with(ws_show, con, tk, pay)}
SELECT 'contacts' AS entity, count(*) AS n_rows, count(*) > 0 AS should_load FROM con
UNION ALL SELECT 'payments', count(*), count(*) > 0 FROM pay
UNION ALL SELECT 'tickets', count(*), count(*) > 0 FROM tk"""
    return q
