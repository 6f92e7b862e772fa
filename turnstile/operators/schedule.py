"""Activity schedule, price schedule and time lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.functions.scalar import add_minutes, hhmm, minutes_of_day
from turnstile.operators.scope import in_range

# Availability flag columns of the schedule, all set to 'True'.
DAY_FLAGS = ["sundayavail", "mondayavail", "tuesdayavail", "wednesdayavail",
             "thursdayavail", "fridayavail", "saturdayavail"]


def _timed_events(src: Mapping[str, DataFrame], lo=None, hi=None) -> DataFrame:
    ev = src["events"]
    if lo is not None:
        ev = ev.filter(in_range("eveventdate", lo, hi))
    return (ev.join(src["shows"].select("shcode", "shlongminutes"),
                    F.col("evshow") == F.col("shcode"))
            .withColumn("starttime", hhmm("eveventdate"))
            .withColumn("finishtime", hhmm(add_minutes("eveventdate", "shlongminutes"))))


def activity_schedule(src: Mapping[str, DataFrame], lo, hi,
                      activities: DataFrame | None = None) -> DataFrame:
    """Events of the range grouped by show and start/finish time of day.

    ``finishtime`` wraps past midnight (23:50 + 45 min -> 00:35) and is NULL
    when the show has no duration.  ``activities`` (a frame with
    ``activityid``) restricts the shows, as the day dump does.
    """
    ev = _timed_events(src, lo, hi)
    if activities is not None:
        ev = ev.join(activities.select(F.col("activityid").alias("__act")),
                     F.col("evshow") == F.col("__act"), "left_semi")
    g = ev.groupBy("evshow", "starttime", "finishtime").agg(
        F.min("evcode").alias("id"), F.min("eveventdate").alias("startdate"),
        F.max("eveventdate").alias("enddate"))
    return g.select("id", F.col("evshow").alias("activityid"),
                    *[F.lit("True").alias(d) for d in DAY_FLAGS],
                    "startdate", "enddate", "starttime", "finishtime")


def lookup_times(schedule: DataFrame) -> DataFrame:
    """Distinct start and finish times with their minute of the day."""
    starts = schedule.select(F.col("starttime").alias("timevalue"))
    ends = schedule.select(F.col("finishtime").alias("timevalue"))
    return (starts.union(ends).distinct()
            .select("timevalue", minutes_of_day("timevalue").alias("min")))


def price_schedule(src: Mapping[str, DataFrame], price_types: DataFrame,
                   lo=None, hi=None) -> DataFrame:
    """Per show, start/finish time of day and in-scope price type: the lowest
    event code and the lowest discounted price.

    Reference shape: PriceType x PriceDiscount x PriceList x events x shows,
    grouped.  The discount and event sides only meet through the price list,
    a many-to-many join; both sides are reduced *before* it (MIN distributes
    over the join), so the join sees one row per (list, type) and one per
    (list, show, start, finish) instead of every discount x every event.
    ``price_types`` is a frame of in-scope ``pctcode``; ``lo/hi`` restrict
    the events (day dump), ``None`` keeps all events (full dump).
    """
    lists = src["pricelist"].select(F.col("prlcode").alias("__pl")).distinct()
    types = (src["pricetype"].select(F.col("pctcode").alias("__pt"))
             .join(price_types.select(F.col("pctcode").alias("__ps")),
                   F.col("__pt") == F.col("__ps"), "left_semi").distinct())
    disc = (src["pricediscount"]
            .join(types, F.col("pdpricetype") == F.col("__pt"), "left_semi")
            .join(lists, F.col("pdpricelist") == F.col("__pl"), "left_semi")
            .groupBy("pdpricelist", "pdpricetype")
            .agg(F.min("pdcalculatedprice").alias("__price")))
    ev = (_timed_events(src, lo, hi)
          .groupBy("evpricelist", "evshow", "starttime", "finishtime")
          .agg(F.min("evcode").alias("__ev")))
    j = ev.join(disc, F.col("evpricelist") == F.col("pdpricelist"))
    g = j.groupBy("evshow", "starttime", "finishtime", "pdpricetype").agg(
        F.min("__ev").alias("activityscheduleid"), F.min("__price").alias("price"))
    return g.select("activityscheduleid", F.col("pdpricetype").alias("pricetypeid"), "price")
