"""Full and day dumps: every staging product for a date range (X3 + D1-D10).

``variant="full"``: tickets carry ``activityscheduleid = min(evcode)``, the
price schedule covers all events, the activity schedule covers all shows.
``variant="day"``: the activity schedule is restricted to in-scope
activities, tickets look their schedule id up by date range, and the price
schedule only uses events of the range.  Both dumps build the working set
with the event (not show) as equivalence key and keep ``evcode``.
The card number stays NULL without a card row (dump form).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from turnstile.operators.schedule import activity_schedule, lookup_times, price_schedule
from turnstile.plans import products as P
from turnstile.plans.working_set import build_working_set, published
from turnstile.session import materialize


def dump(src: Mapping[str, DataFrame], lo, hi, profile: P.UserProfile,
         variant: str = "full", reuse: bool = True) -> dict[str, DataFrame]:
    """All products of a dump as DataFrames.

    ``reuse`` checkpoints the working set, which every product reads.  The
    dimension products only need the distinct contacts, price types, shows
    and tills of the scope; the working set has those columns with the same
    value sets (it only adds left-join fan-out), so the scope itself is not
    computed or stored a second time.  Receipts, commissions and cards are cut
    to the window's tickets and payments before they are aggregated.
    """
    if variant not in ("full", "day"):
        raise ValueError("variant must be 'full' or 'day'")
    ws = build_working_set(src, lo, hi, group_by="event", keep_internal=True, prune_to_scope=True)
    if reuse:
        ws = materialize(ws)
    scope = ws
    out: dict[str, DataFrame] = {
        "contacts": P.contacts(src, scope),
        "pricetypes": P.pricetypes(src, scope),
        "activities": P.activities(src, scope),
        "temptickets": published(ws),
    }
    if variant == "full":
        schedule = activity_schedule(src, lo, hi)
        tickets = P.tickets(ws, schedule_id="min_evcode")
        prices = price_schedule(src, out["pricetypes"].withColumnRenamed("pricetypeid", "pctcode"))
    else:
        schedule = activity_schedule(src, lo, hi, activities=out["activities"])
        tickets = P.tickets(ws, schedule, schedule_id="range")
        prices = price_schedule(src, out["pricetypes"].withColumnRenamed("pricetypeid", "pctcode"),
                                lo, hi)
    out["activityschedule"] = schedule
    out["tickets"] = tickets
    out["payments"] = P.payments(ws, src, card_default=None, prune_cards=True)
    out["activitypriceschedule"] = prices
    out["users"] = P.users(src, scope, ws, profile)
    out["lookuptimes"] = lookup_times(schedule)
    return out
