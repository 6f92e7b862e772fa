"""Staging products built from the scope and the working set.

Each function returns a lazy DataFrame; callers materialize what they reuse.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import plus_concat, spaces_to_underscores
from turnstile.operators.lookup import range_lookup
from turnstile.operators.rollup import payment_rollup, ticket_rollup
from turnstile.operators.scope import referenced_rows
from turnstile.plans.working_set import Parts


def contacts(src: Mapping[str, DataFrame], scope: DataFrame) -> DataFrame:
    """Clients referenced by an in-scope ticket (cltcode, cltfirstname,
    cltSurName, cltEmail)."""
    return referenced_rows(src["clients"], "cltcode", scope, "timailinglist").select(
        "cltcode", "cltfirstname", F.col("cltsurname").alias("cltSurName"),
        F.col("cltemail").alias("cltEmail"))


def pricetypes(src: Mapping[str, DataFrame], scope: DataFrame) -> DataFrame:
    """Price types sold in scope (pricetypeid, description)."""
    return referenced_rows(src["pricetype"], "pctcode", scope, "tipricetype").select(
        F.col("pctcode").alias("pricetypeid"), F.col("pctdescr").alias("description"))


def activities(src: Mapping[str, DataFrame], scope: DataFrame) -> DataFrame:
    """D3: shows with an in-scope ticket (activityid, description)."""
    return referenced_rows(src["shows"], "shcode", scope, "shcode").select(
        F.col("shcode").alias("activityid"), F.col("shdescr").alias("description"))


def _rolled(ws: DataFrame | Parts, schedule_id: str | None = None) -> DataFrame:
    """The roll-up; its groups are of one contact, so those of parts are all groups."""
    if isinstance(ws, Parts):
        return reduce(DataFrame.unionByName, [ticket_rollup(part, schedule_id) for part in ws.parts])
    return ticket_rollup(ws, schedule_id)


def tickets(ws: DataFrame | Parts, schedule: DataFrame | None = None,
            schedule_id: str | None = None) -> DataFrame:
    """Ticket roll-up.

    ``schedule_id=None``: procedure form (no schedule column).
    ``"min_evcode"``: full-dump form, ``activityscheduleid = min(evcode)``.
    ``"range"``: day-dump form, the lowest schedule id of the same show whose
    ``[startdate, enddate]`` holds the event date (``schedule`` required).
    """
    if schedule_id == "range":
        if schedule is None:
            raise ValueError("schedule_id='range' needs the activity schedule")
        rolled = _rolled(ws)
        # the rows' shows and times are those of the roll-up, which isn't built for the probes as well
        probes = (ws.rows if isinstance(ws, Parts) else ws).select(F.col("shcode").alias("Activity"), F.col("eveventdate").alias("evEventDate"))
        with_id = range_lookup(rolled, "Activity", "evEventDate", schedule, "activityid",
                               "startdate", "enddate", "id", "activityscheduleid", probes)
        cols = rolled.columns
        return with_id.select(cols[0], "activityscheduleid", *cols[1:])
    return _rolled(ws, schedule_id)


def payments(ws: DataFrame | Parts, src: Mapping[str, DataFrame], card_default: str | None = "",
             mask_card: bool = False, prune_cards: bool = False) -> DataFrame:
    """Payment roll-up; ``ws`` must carry the internal transaction columns
    (``build_working_set(..., keep_internal=True)``).  ``prune_cards`` as in
    :func:`turnstile.operators.rollup.payment_rollup` (use it for small windows)."""
    return payment_rollup(ws.parts if isinstance(ws, Parts) else ws, src["recieptcredit"], card_default,
                          mask=mask_card, prune_cards=prune_cards)


@dataclass(frozen=True)
class UserProfile:
    """Constants written into CRM user rows.  No organisation-specific
    defaults: the e-mail suffix and profile id come from the caller."""
    email_suffix: str
    profile_id: str
    email_tag: str = ".test"
    nickname_suffix: str = ".crm.test"
    time_zone: str = "America/Los_Angeles"
    locale: str = "en_US"
    email_encoding: str = "ISO-8859-1"
    language: str = "en_US"


USER_COLUMNS = ["username", "first_name", "last_name", "email", "externalid",
                "communityNickname", "TimeZoneSidKey", "LocaleSidKey", "EmailEncodingKey",
                "LanguageLocaleKey", "Alias", "ProfileId"]


def users(src: Mapping[str, DataFrame], scope: DataFrame, working_set: DataFrame,
          profile: UserProfile, with_id_kind: bool = False) -> DataFrame:
    """Guides with a CRM user that appear in the working set (the ticket
    roll-up groups by guide, so on a published ticket too), plus one
    pseudo-user per till used in scope (bag union, as the INSERT appends).

    ``externalid`` holds guide codes and till codes; ``with_id_kind=True``
    adds ``id_kind`` ('guide' / 'till').  The default output is the original."""
    def constants():
        return [F.lit(profile.time_zone).alias("TimeZoneSidKey"),
                F.lit(profile.locale).alias("LocaleSidKey"),
                F.lit(profile.email_encoding).alias("EmailEncodingKey"),
                F.lit(profile.language).alias("LanguageLocaleKey")]

    xref = src["crossref"].filter(F.col("sugarmodule") == "Users")
    guides = (src["crm_users"]
              .join(xref, F.col("id") == F.col("sugarid"))
              .join(src["guiders"], F.col("gdrcode") == F.col("pecode"))
              .join(src["clients"].select("cltcode", "cltemail"),
                    F.col("gdrcontactnoinreltable") == F.col("cltcode")))
    guides = referenced_rows(guides, "pecode", working_set,
                             F.col("guideid"))
    part1 = guides.select(
        plus_concat(F.col("user_name"), profile.email_suffix).alias("username"),
        "first_name", "last_name",
        plus_concat(F.col("cltemail"), profile.email_tag).alias("email"),
        F.col("pecode").alias("externalid"),
        plus_concat(F.col("last_name"), profile.nickname_suffix).alias("communityNickname"),
        *constants(),
        plus_concat(F.col("last_name"), profile.nickname_suffix).alias("Alias"),
        F.lit(profile.profile_id).alias("ProfileId"),
        *([F.lit("guide").alias("id_kind")] if with_id_kind else []))
    tills = referenced_rows(src["till"], "tilcode", scope, "tilcode")
    name = spaces_to_underscores("tildescr")
    part2 = tills.select(
        plus_concat(name, profile.email_suffix).alias("username"),
        F.lit("").alias("first_name"),
        name.alias("last_name"),
        plus_concat(name, profile.email_suffix).alias("email"),
        F.col("tilcode").alias("externalid"),
        plus_concat(name, profile.nickname_suffix).alias("communityNickname"),
        *constants(),
        plus_concat(name, profile.nickname_suffix).alias("Alias"),
        F.lit(profile.profile_id).alias("ProfileId"),
        *([F.lit("till").alias("id_kind")] if with_id_kind else []))
    return part1.unionByName(part2)
