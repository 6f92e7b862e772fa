from decimal import Decimal as D

from tests.fixtures import HI, LO
from turnstile.operators.schedule import activity_schedule, lookup_times, price_schedule
from turnstile.operators.scope import ticket_scope
from turnstile.plans import accounts as A
from turnstile.plans import products as P
from turnstile.plans.working_set import build_working_set

PROFILE = P.UserProfile(email_suffix="@crm.test", profile_id="P1")


def ws_of(src, group_by="show"):
    return build_working_set(src, LO, HI, group_by=group_by, keep_internal=True)


def test_ticket_rollup(src):
    rows = P.tickets(ws_of(src)).collect()
    got = sorted(((r.tickid, r.guideid, r.fees, r.qty, r.paymentid, r.status, r.last_transact_no)
                  for r in rows), key=repr)
    assert got == sorted([
        (1, None, D("2.0000"), 1, 50, "Sale", 1000),
        (1, 1000, None, 1, 50, "Sale", 1000),
        (0, None, None, 1, None, "Sale", 1001),
        (4, 1005, D("2.0000"), 2, 53, "Return", 1003),
        (4, 1006, D("2.0000"), 1, 53, "Return", 1002),
        (7, None, None, 1, None, "Sale", 1005),
        (0, None, None, 1, None, "Sale", 1007),       # NULL status -> Sale
    ], key=repr)
    assert sum(r.qty for r in rows) == ws_of(src).count()


def test_payment_rollup_procedure_and_dump_forms(src):
    ws = ws_of(src)
    proc = {r.paymentid: r for r in P.payments(ws, src, card_default="").collect()}
    assert set(proc) == {50, 53}
    assert proc[50].amount == D("25.0000") and proc[50].mode == "Receipt"
    assert proc[50].lastCardNum == "" and proc[50].lastCardName == "Ann & Co"
    # a transaction shared by tickets counts once; two transactions both count
    assert proc[53].amount == D("40.0000") and proc[53].mode == "Refund"
    assert proc[53].lastCardNum == "4222" and proc[53].lastCardName == "Bob"
    assert proc[53].last_transact_no == 1003 and proc[53].type == "Cash"
    dump = {r.paymentid: r for r in P.payments(ws, src, card_default=None).collect()}
    assert dump[50].lastCardNum is None


def test_dimension_products(src):
    scope = ticket_scope(src, LO, HI)
    assert sorted(r.cltcode for r in P.contacts(src, scope).collect()) == [1, 2, 4]
    assert sorted(r.pricetypeid for r in P.pricetypes(src, scope).collect()) == [1, 2, 3]
    assert sorted(r.activityid for r in P.activities(src, scope).collect()) == [1, 3]


def test_schedule_and_lookup_times(src):
    sched = activity_schedule(src, LO, HI)
    got = sorted((r.id, r.activityid, r.starttime, r.finishtime) for r in sched.collect())
    assert got == [(100, 1, "10:00", "10:45"), (101, 1, "23:50", "00:35"), (103, 3, "00:00", "00:30")]
    times = sorted((r.timevalue, r.min) for r in lookup_times(sched).collect())
    assert times == [("00:00", 0), ("00:30", 30), ("00:35", 35), ("10:00", 600), ("10:45", 645),
                     ("23:50", 1430)]


def test_range_lookup_tickets(src):
    sched = activity_schedule(src, LO, HI)
    rows = P.tickets(ws_of(src, "event"), sched, schedule_id="range").collect()
    got = {(r.tickid, r.Activity): r.activityscheduleid for r in rows if r.tickid}
    assert got == {(1, 1): 100, (4, 1): 101, (7, 3): 103}
    full = P.tickets(ws_of(src, "event"), schedule_id="min_evcode").collect()
    assert {r.activityscheduleid for r in full} == {100, 101, 103}


def test_price_schedule_full_and_day(src):
    types = P.pricetypes(src, ticket_scope(src, LO, HI)).withColumnRenamed("pricetypeid", "pctcode")
    full = sorted((r.activityscheduleid, r.pricetypeid, r.price)
                  for r in price_schedule(src, types).collect())
    assert full == sorted([(100, 1, D("8.0000")), (100, 2, D("5.0000")), (101, 1, D("8.0000")),
                           (101, 2, D("5.0000")), (102, 3, D("4.0000")), (103, 1, D("8.0000")),
                           (103, 2, D("5.0000"))])
    day = price_schedule(src, types, LO, HI).collect()
    assert len(day) == 6 and all(r.activityscheduleid != 102 for r in day)


def test_users(src):
    ws = ws_of(src)
    out = P.users(src, ticket_scope(src, LO, HI), ws, PROFILE).collect()
    got = sorted((r.username, r.externalid, r.email, r.first_name) for r in out)
    assert got == sorted([("guide5@crm.test", 5, "ann@x.test.test", "Gina"),
                          ("Main_Desk@crm.test", 1, "Main_Desk@crm.test", ""),
                          ("Kiosk@crm.test", 2, "Kiosk@crm.test", "")])


def test_accounts_contacts_orders(src):
    acc = A.accounts(src, LO, HI)
    got = sorted((r.recid, r.orcfullname, r.adraddress1, r.phone) for r in acc.collect())
    assert got == [(2, "Blank & <Co>", "2 Side", None),   # blank name: client code, surname
                   (900, "Ann Smith", "1 Main", "555-1"),  # lowest order contact, first phone
                   (902, "Bob J", None, "555-9")]          # non-mailing address -> NULL
    con = A.contacts_enriched(src, ticket_scope(src, LO, HI)).collect()
    assert sorted((r.cltcode, r.adraddress1, r.phone) for r in con) == [
        (1, "1 Main", "555-1"), (4, None, "555-9")]
    orders = sorted(tuple(r) for r in A.orders(src, LO, HI, acc).collect())
    assert orders == [(7000, 900, 1, "10/01/2014", "09/30/2014"),
                      (7002, 902, 4, "10/01/2014", "10/01/2014"),
                      (7004, 2, 0, "10/01/2014", "09/30/2014")]


def test_id_kind_option(src):
    acc = {r.recid: r.id_kind for r in A.accounts(src, LO, HI, with_id_kind=True).collect()}
    assert acc == {2: "client", 900: "order_contact", 902: "order_contact"}
    out = P.users(src, ticket_scope(src, LO, HI), ws_of(src), PROFILE, with_id_kind=True)
    assert sorted((r.externalid, r.id_kind) for r in out.collect()) == [
        (1, "till"), (2, "till"), (5, "guide")]
    assert "id_kind" not in A.accounts(src, LO, HI).columns


def test_card_pruning_gives_the_same_payments(src):
    ws = ws_of(src)
    a = P.payments(ws, src, prune_cards=False).collect()
    b = P.payments(ws, src, prune_cards=True).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))
