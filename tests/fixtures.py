"""A small ticketing database holding the edge rows every operator must handle.

Window used by the tests: 2014-10-01 00:00 .. 2014-10-01 23:59.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from turnstile.sources.schemas import SOURCE_SCHEMAS

LO = "2014-10-01 00:00:00"
HI = "2014-10-01 23:59:00"


def T(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


ROWS: dict[str, list[tuple]] = {
    "shows": [(1, "Battlefield Tour", 45), (2, "Film", None), (3, "Late Show", 30)],
    "till": [(1, "Main Desk"), (2, "Kiosk")],
    "shifts": [(10, 0, 1, T("2014-09-30 08:00")), (11, 1, 1, T("2014-10-01 08:00")),
               (12, 0, 2, T("2014-10-01 09:00"))],
    "events": [
        (100, 1, T("2014-10-01 10:00"), 500),
        (101, 1, T("2014-10-01 23:50"), 500),      # finish wraps past midnight
        (102, 2, T("2014-10-01 23:59:30"), 501),   # after a 23:59 bound: out
        (103, 3, T("2014-10-01 00:00"), 500),      # exactly on the lower bound: in
        (104, 1, T("2014-10-02 10:00"), 500),      # next day: out
    ],
    "clients": [(1, "Ann", "Smith", "ann@x.test"), (2, "   ", "Blank & <Co>", "b@x.test"),
                (3, None, "Nul", "n@x.test"), (4, "Bob", "Jones", "bob@x.test")],
    "tickets": [
        # ticode, pricetype, price, contact, txn, status, event, shift, order
        (1, 1, D("10.00"), 1, 1000, 0, 100, 10, 7000),
        (2, 1, D("10.00"), 1, 1000, 0, 100, 10, 7000),      # same as 1, guide 0 vs NULL
        (3, 1, D("10.00"), None, 1001, 0, 100, 10, 7001),   # no contact: ids stay 0
        (4, 2, D("20.00"), 4, 1002, 9, 101, 12, 7002),      # return, two guides
        (5, 2, D("20.00"), 4, 1003, 9, 101, 12, 7002),      # same class as 4
        (6, 1, D("10.00"), 1, 1004, None, 100, 11, 7003),   # non-sale shift: out
        (7, 1, D("15.00"), 2, 1005, 0, 103, 10, 7004),      # lower bound, blank name
        (8, 1, D("15.00"), 3, 1006, 0, 102, 10, 7005),      # 23:59:30: out
        (9, 3, D("12.00"), 1, 1007, None, 100, 10, 7006),   # NULL status; no receipts/fees
    ],
    "get_orderguides": [(7000, 1, None), (7000, 2, 0), (7002, 4, 5), (7002, 4, 6), (7002, 5, 5)],
    "paytype": [(1, "Cash"), (2, "Card")],
    "recieptbase": [
        (50, 1000, 99, T("2014-10-01 08:05"), 0, D("20.00")),  # first, no pay type
        (51, 1000, 2, T("2014-10-01 08:06"), 1, D("5.00")),
        (52, 1001, 1, T("2014-10-01 08:10"), 0, D("10.00")),
        (53, 1002, 1, T("2014-10-01 09:00"), 1, D("20.00")),
        (54, 1003, 1, T("2014-10-01 09:00"), 1, D("20.00")),
        (55, 1005, None, None, None, D("7.00")),
    ],
    "recieptcredit": [(50, None, '<p card_name="Ann &amp; Co"/>'), (51, "4111", '<p x="1"/>'),
                      (53, None, '<p card_name="Bob"/>'), (53, "4222", "not xml")],
    "calculatedcommission": [(1, D("1.50")), (1, D("0.50")), (4, D("2.00")), (5, D("2.00"))],
    "pricetype": [(1, "Adult"), (2, "Child"), (3, "Senior"), (4, "Unsold")],
    "pricediscount": [(1, 500, D("9.00")), (1, 500, D("8.00")), (2, 500, D("5.00")),
                      (3, 501, D("4.00")), (4, 500, D("1.00"))],
    "pricelist": [(500,), (501,)],
    "crm_users": [("u5", "guide5", "Gina", "Five"), ("u6", "guide6", "Gus", "Six"),
                  ("u7", "guide7", "Gil", "Seven")],
    "crossref": [("u5", "Users", 5), ("u6", "Accounts", 6), ("u7", "Users", 7)],
    "guiders": [(5, 1), (6, 4), (7, 4)],
    "ordercontacts": [(900, 7000, "Ann Smith"), (901, 7000, "Ann Smith"), (902, 7002, "Bob J"),
                      (903, 7004, "Blank Co"), (904, 7001, "Walk In")],
    "clientaddresses": [(1, 1, 300), (2, 1, 301), (4, 0, 302)],
    "addresses": [(300, "1 Main", None, "Gettys", "PA", "17325", "US"),
                  (301, "2 Side", "Apt 3", "Town", "MD", "21701", "US"),
                  (302, "9 Elm", None, "City", "VA", "22101", "US")],
    "clientphonenumbers": [(1, "555-2"), (1, "555-1"), (4, "555-9")],
}


def ticketing_sources(spark):
    return {name: spark.createDataFrame(rows, SOURCE_SCHEMAS[name]) for name, rows in ROWS.items()}
