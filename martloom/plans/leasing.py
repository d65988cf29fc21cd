"""Leasing reports: lead funnel, pipeline, properties, search traffic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.scalars import (
    days_before,
    growth_pct,
    jst_date,
    jst_midnight,
    mean_of,
    pct,
    ratio,
    round_at,
    stamp,
    week_start,
)

# ---- fixed values ----
WON, LOST = "CONTRACTED", "LOST"
STAGES = ("INQUIRY", "VIEWING_PLANNED", "VIEWED", "APPLIED", "SCREENING", "CONTRACTING")
VIEWING = "VIEWING"
WEB_SOURCES = ("web", "search", "seo", "hp")
# ---- end of fixed values ----


def _open_deal() -> Column:
    return ~F.col("status").isin(WON, LOST)


def _age_days(as_of: dt.date, ts: str) -> Column:
    return F.date_diff(F.lit(as_of), jst_date(F.col(ts))).cast("long")


def re_case_pipeline(
    deals: DataFrame, as_of: dt.date, generated_at: dt.datetime | None = None, sort: bool = False
) -> DataFrame:
    """Open deals per stage."""
    stages = (
        deals.filter(_open_deal())
        # per stage and assignee first: what the second step gathers is one entry per member of staff
        .groupBy("status", "assigned_user_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.coalesce(F.col("proposed_rent"), F.lit(0))).alias("rent"),
            F.sum(_age_days(as_of, "created_at")).alias("days"),
            F.count("created_at").alias("aged"),
        )
        .groupBy("status")
        .agg(
            F.sum("n").alias("deal_count"),
            F.sum("rent").alias("total_proposed_rent_yen"),
            round_at(mean_of(F.sum("days"), F.sum("aged")), 1).alias("avg_age_days"),
            F.count("assigned_user_id").alias("distinct_assignees"),
            F.array_sort(F.collect_set(F.col("assigned_user_id").cast("string"))).alias("ids"),
        )
    )
    if sort:
        # stages are numbered in their natural order, anything else comes last
        place = F.array_position(F.array(*map(F.lit, STAGES)), F.col("status"))
        stages = stages.orderBy(F.when(place > 0, place).otherwise(99), "status")
    return stages.select(
        "status",
        "deal_count",
        "total_proposed_rent_yen",
        "avg_age_days",
        "distinct_assignees",
        # no assignee at all gives null, as a string aggregate does
        F.when(F.size("ids") > 0, F.array_join("ids", ",")).alias("assigned_user_ids"),
        *stamp(generated_at),
    )


def re_lead_funnel(
    search_console: DataFrame,
    tenants: DataFrame,
    deals: DataFrame,
    as_of: dt.date,
    days: int = 365,
    generated_at: dt.datetime | None = None,
    sort: bool = False,
) -> DataFrame:
    """One row per day of the last year: search clicks, inquiries, new, won and lost deals.

    Each source is cut to the span by a literal time bound the scan can use, then counted per day; the
    gap-free calendar meets at most one row per day and source. Deals are read once for all their events.
    """
    first = as_of - dt.timedelta(days=days)
    begin, end = jst_midnight(first), jst_midnight(as_of + dt.timedelta(days=1))
    inside = lambda c: (F.col(c) >= begin) & (F.col(c) < end)

    calendar = tenants.sparkSession.range(days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )
    clicks = (
        search_console.filter(F.col("date").between(F.lit(first), F.lit(as_of)))
        .groupBy("date")
        .agg(F.sum("clicks").alias("organic_clicks"), F.sum("impressions").alias("organic_impressions"))
    )
    inquiries = (
        tenants.filter(inside("created_at"))
        .groupBy(jst_date(F.col("created_at")).alias("date"))
        .agg(F.count(F.lit(1)).alias("inquiry_count"))
    )
    outcome = F.when(F.col("status") == WON, "won").when(F.col("status") == LOST, "lost")
    deal_events = (
        deals.filter(inside("created_at") | inside("updated_at"))
        .select(
            F.explode(
                F.array(
                    F.struct(jst_date(F.col("created_at")).alias("date"), F.lit("new").alias("what")),
                    F.struct(jst_date(F.col("updated_at")).alias("date"), outcome.alias("what")),
                )
            ).alias("e")
        )
        .groupBy("e.date")
        .agg(*[F.count_if(F.col("e.what") == w).alias(f"{w}_count") for w in ("new", "won", "lost")])
        .withColumnRenamed("new_count", "new_deal_count")
    )
    measures = [
        "organic_clicks", "organic_impressions", "inquiry_count", "new_deal_count", "won_count", "lost_count",
    ]
    daily = reduce(lambda left, right: left.join(right, "date", "left"), (clicks, inquiries, deal_events), calendar)
    funnel = daily.select("date", *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
    report = funnel.select(
        "*",
        pct(F.col("inquiry_count"), F.col("organic_clicks"), 2).alias("click_to_inquiry_pct"),
        pct(F.col("new_deal_count"), F.col("inquiry_count"), 2).alias("inquiry_to_deal_pct"),
        pct(F.col("won_count"), F.col("new_deal_count"), 2).alias("deal_win_pct"),
        *stamp(generated_at),
    )
    return report.orderBy("date") if sort else report


def re_property_performance(
    properties: DataFrame,
    deals: DataFrame,
    activities: DataFrame,
    as_of: dt.date,
    generated_at: dt.datetime | None = None,
    sort: bool = False,
) -> DataFrame:
    """Deals, viewings and time on the market per property. Lead times count UTC days, the listing age
    counts Tokyo days."""
    lead = F.when(
        F.col("status") == WON, F.date_diff(F.to_date("updated_at"), F.to_date("created_at")).cast("long")
    )
    deal_stats = deals.groupBy(F.col("property_id").alias("id")).agg(
        F.count(F.lit(1)).alias("total_deals"),
        F.count_if(F.col("status") == WON).alias("won_deals"),
        F.count_if(F.col("status") == LOST).alias("lost_deals"),
        F.count_if(_open_deal()).alias("active_deals"),
        round_at(mean_of(F.sum(lead), F.count(lead)), 1).alias("avg_lead_time_days"),
    )
    viewings = (
        activities.filter(F.col("activity_type") == VIEWING)
        .groupBy(F.col("property_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("total_viewings"))
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    result = (
        properties.join(deal_stats, "id", "left")
        .join(viewings, "id", "left")
        .select(
            F.col("id").alias("property_id"),
            "property_name",
            "property_type",
            "listing_status",
            "rent_amount",
            "owner_id",
            *map(zero, ("total_deals", "won_deals", "lost_deals", "active_deals")),
            "avg_lead_time_days",
            zero("total_viewings"),
            pct(F.col("won_deals"), F.col("total_deals")).alias("win_rate_pct"),
            _age_days(as_of, "created_at").alias("days_listed"),
            *stamp(generated_at),
        )
    )
    return result.orderBy(F.desc("total_deals"), F.desc("days_listed"), "property_id") if sort else result


def re_seo_inquiry_attribution(
    search_console: DataFrame,
    tenants: DataFrame,
    as_of: dt.datetime,
    site_names: Sequence[str] = (),
    top: int = 200,
    generated_at: dt.datetime | None = None,
) -> DataFrame:
    """The top pages and queries by clicks of the last 30 days beside the number of web inquiries.

    as_of is the UTC instant of the run; the search days count back from the Tokyo day of that instant,
    the inquiries from the instant itself. site_names adds the own site's names to the sources that
    count as web.
    """
    today = (as_of + dt.timedelta(hours=9)).date()
    source = F.lower(F.coalesce(F.col("source"), F.lit("")))
    from_web = reduce(lambda a, b: a | b, [source.contains(w) for w in (*WEB_SOURCES, *site_names)])
    since = F.lit((as_of - dt.timedelta(days=30)).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    inquiries = tenants.filter((F.col("created_at") >= since) & from_web).agg(F.count(F.lit(1))).scalar()
    return (
        search_console.filter(F.col("date") >= days_before(today, 30))
        .groupBy("page", "query")
        .agg(
            F.sum("clicks").alias("sc_clicks_30d"),
            F.sum("impressions").alias("sc_impressions_30d"),
            ratio(F.sum(F.col("clicks") * F.col("position")), F.sum("clicks")).alias("position"),
        )
        .filter(F.col("sc_clicks_30d") > 0)
        .orderBy(F.desc("sc_clicks_30d"), "page", "query")
        .limit(top)
        .select(
            "page",
            "query",
            "sc_clicks_30d",
            "sc_impressions_30d",
            round_at(F.col("position"), 1).alias("avg_position"),
            inquiries.alias("total_web_inquiries_30d"),
            *stamp(generated_at),
        )
    )


def re_weekly_summary(lead_funnel: DataFrame, generated_at: dt.datetime | None = None, sort: bool = False) -> DataFrame:
    """The funnel per week with the change against the week before."""
    sums = {
        "organic_clicks": "organic_clicks",
        "inquiries": "inquiry_count",
        "new_deals": "new_deal_count",
        "won": "won_count",
        "lost": "lost_count",
    }
    weekly = lead_funnel.groupBy(week_start(F.col("date")).alias("week_start")).agg(
        *[F.sum(src).alias(out) for out, src in sums.items()]
    )
    # unpartitioned, but over one row per week of the funnel (54 for a year)
    order = Window.orderBy("week_start")
    compared = {"organic_clicks": "clicks", "inquiries": "inquiries", "new_deals": "new_deals", "won": "won"}
    report = weekly.select(
        "week_start",
        *sums,
        *[growth_pct(F.col(c), F.lag(c).over(order)).alias(f"{name}_wow_pct") for c, name in compared.items()],
        *stamp(generated_at),
    )
    return report.orderBy("week_start") if sort else report
