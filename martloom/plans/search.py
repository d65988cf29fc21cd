"""Search reports: queries against purchases, keyword opportunities, and the analyses of a click decline."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.scalars import (
    before_query,
    days_before,
    mean_of,
    month_start,
    pct,
    ratio,
    round_at,
    stamp,
    url_path,
)
from martloom.operators.joins import prefix_totals
from martloom.operators.skew import SALT, spread_hot_keys

# ---- fixed values ----
CONVERSION_RATE = 0.015
TOP3_CLICK_RATE = 0.10
LOW_CLICK_SHARE = 0.02
LOSS_MAJOR, LOSS_MINOR = 100, 30
GAP_VOLUME = (100, 30000)
GAP_MIN_COMPETITORS = 2
# ---- end of fixed values ----


def _weighted(position: str, weight: str) -> Column:
    return ratio(F.sum(F.col(position) * F.col(weight)), F.sum(weight))


def _recent_order_value(orders: DataFrame, as_of: dt.date) -> Column:
    """Rounded average of total_price over the last 30 days, as a scalar subquery."""
    recent = orders.filter(F.col("order_date") >= days_before(as_of, 30))
    return recent.agg(round_at(mean_of(F.sum("total_price"), F.count("total_price")))).scalar()


# ------------------------------------------------------------------ reports


def ec_search_to_purchase(
    sc_history: DataFrame, orders: DataFrame, generated_at: dt.datetime | None = None
) -> DataFrame:
    """Search clicks per month, query and page next to the orders that landed under that page's path."""
    searched = (
        sc_history.filter(F.col("query").isNotNull() & F.col("url").isNotNull())
        .groupBy(
            month_start(F.col("data_date")).alias("year_month"),
            F.col("query").alias("sc_query"),
            url_path(F.col("url")).alias("sc_path"),
        )
        .agg(
            F.sum("clicks").alias("sc_clicks"),
            F.sum("impressions").alias("sc_impressions"),
            _weighted("position", "impressions").alias("sc_avg_position"),
        )
    )
    landed = (
        orders.filter(F.col("landing_site").isNotNull())
        .groupBy(month_start(F.col("order_date")).alias("year_month"), before_query(F.col("landing_site")).alias("path"))
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("total_price").alias("revenue"))
    )
    # lengths are collected per month from the plain history: a path's length does not need the sums above
    paths = sc_history.filter(F.col("query").isNotNull() & F.col("url").isNotNull()).select(
        month_start(F.col("data_date")).alias("year_month"), url_path(F.col("url")).alias("sc_path")
    )
    under = prefix_totals(
        landed, "path", paths, "sc_path", "year_month", {"matched_orders": "orders", "matched_revenue": "revenue"}
    )
    matched_orders = F.coalesce(F.col("matched_orders"), F.lit(0))
    matched_revenue = F.coalesce(F.col("matched_revenue"), F.lit(0))
    # the queries of one page may be a large share of the history; page totals come out of an aggregation
    keys = ["year_month", "sc_path"]
    spread, totals = spread_hot_keys(searched, under, keys, ["sc_query"], key_source=paths)
    return spread.join(totals, [*keys, SALT], "left").select(
        "year_month",
        "sc_query",
        "sc_path",
        "sc_clicks",
        "sc_impressions",
        round_at(F.col("sc_avg_position"), 1).alias("sc_avg_position"),
        matched_orders.alias("matched_orders"),
        matched_revenue.alias("matched_revenue"),
        pct(matched_orders, F.col("sc_clicks"), 2).alias("conversion_rate_pct"),
        round_at(ratio(matched_revenue, F.col("sc_clicks"))).alias("revenue_per_click"),
        *stamp(generated_at),
    )


def ec_seo_opportunity(
    sc_history: DataFrame,
    keywords: DataFrame,
    orders: DataFrame,
    as_of: dt.date,
    own_url: str,
    cv_rate: float = CONVERSION_RATE,
    generated_at: dt.datetime | None = None,
) -> DataFrame:
    """Clicks per keyword now and a year ago, with the yen a decline costs.

    Both periods are summed in one pass over the history. A keyword seen only a year ago keeps its row
    but has no name unless the keyword tool knows it (the reports are defined that way).
    """
    day = F.col("data_date")
    now = day >= days_before(as_of, 30)
    year_ago = day.between(days_before(as_of, 365), days_before(as_of, 335))
    in_now = lambda c: F.sum(F.when(now, c))
    in_old = lambda c: F.sum(F.when(year_ago, c))
    pos_weight = F.col("position") * F.col("impressions")
    searched = (
        sc_history.filter((now | year_ago) & F.col("query").isNotNull())
        .groupBy("query")
        .agg(
            F.count_if(now).alias("recent_rows"),
            in_now(F.col("clicks")).alias("recent_clicks"),
            ratio(in_now(pos_weight), in_now(F.col("impressions"))).alias("recent_position"),
            in_old(F.col("clicks")).alias("old_clicks"),
            ratio(in_old(pos_weight), in_old(F.col("impressions"))).alias("old_position"),
        )
    )
    tool = (
        keywords.filter((F.col("target_url") == own_url) & (F.col("fetched_date") >= days_before(as_of, 30)))
        .groupBy(F.col("keyword").alias("tool_keyword"))
        .agg(*[F.max(c).alias(c) for c in ("search_volume", "seo_difficulty", "cpc")])
    )
    clicks, before = F.col("recent_clicks"), F.coalesce(F.col("old_clicks"), F.lit(0))
    decline = before - F.coalesce(clicks, F.lit(0))
    kind = (
        F.when(clicks.isNull() & (F.col("search_volume") > 0), "new_opportunity")
        .when(decline >= LOSS_MAJOR, "declining_loss")
        .when(decline >= LOSS_MINOR, "declining_minor")
        .when(
            (F.col("recent_position") <= 3) & (clicks < F.col("search_volume") * F.lit(LOW_CLICK_SHARE)), "top3_low_ctr"
        )
        .when(clicks > before, "growing")
        .otherwise("stable")
    )
    loss = F.greatest(decline, F.lit(0)) * F.lit(cv_rate) * _recent_order_value(orders, as_of)
    return searched.join(tool, F.col("query") == F.col("tool_keyword"), "left").select(
        F.coalesce(F.when(F.col("recent_rows") > 0, F.col("query")), F.col("tool_keyword")).alias("keyword"),
        "search_volume",
        "seo_difficulty",
        "cpc",
        F.coalesce(clicks, F.lit(0)).alias("sc_recent_clicks"),
        before.alias("sc_baseline_clicks"),
        decline.alias("click_decline"),
        round_at(F.col("recent_position"), 1).alias("sc_recent_position"),
        round_at(F.col("old_position"), 1).alias("sc_baseline_position"),
        kind.alias("opportunity_type"),
        round_at(loss).alias("estimated_monthly_loss_yen"),
        *stamp(generated_at),
    )


def ec_competitor_gap(
    keywords: DataFrame,
    orders: DataFrame,
    as_of: dt.date,
    own_url: str,
    generated_at: dt.datetime | None = None,
    sort: bool = False,
) -> DataFrame:
    """Keywords of the latest fetch that at least two competitors hold and the own site does not.

    Own and competitor rows of a keyword meet in one aggregation, so no anti join is needed.
    """
    latest = keywords.agg(F.max("fetched_date")).scalar()
    rows = keywords.filter(
        (F.col("fetched_date") == latest) & F.col("keyword").isNotNull() & (F.col("keyword") != "")
    )
    other = F.col("target_url") != own_url
    of_others = lambda c: F.when(other, F.col(c))
    held = (
        # one row per keyword and domain before the names are gathered
        rows.groupBy("keyword", "domain")
        .agg(
            F.count_if(F.col("target_url") == own_url).alias("own_rows"),
            F.count_if(other).alias("other_rows"),
            *[F.max(of_others(c)).alias(c) for c in ("search_volume", "seo_difficulty", "cpc")],
        )
        .groupBy("keyword")
        .agg(
            F.sum("own_rows").alias("own_rows"),
            *[F.max(c).alias(c) for c in ("search_volume", "seo_difficulty", "cpc")],
            F.array_sort(F.collect_set(F.when(F.col("other_rows") > 0, F.col("domain")))).alias("domains"),
        )
    )
    low, high = GAP_VOLUME
    gap = held.filter(
        (F.col("own_rows") == 0)
        & F.col("search_volume").between(low, high)
        & (F.size("domains") >= GAP_MIN_COMPETITORS)
        & F.col("seo_difficulty").isNotNull()
    )
    worth = (
        F.col("search_volume") * F.lit(TOP3_CLICK_RATE) * F.lit(CONVERSION_RATE) * _recent_order_value(orders, as_of)
    )
    result = gap.select(
        "keyword",
        "search_volume",
        "seo_difficulty",
        "cpc",
        F.size("domains").cast("long").alias("competitor_count"),
        F.array_join("domains", ",").alias("competitors"),
        round_at(worth).alias("estimated_monthly_opportunity_yen"),
        *stamp(generated_at),
    )
    return result.orderBy(F.desc("search_volume"), F.desc("competitor_count"), "keyword") if sort else result


# ------------------------------------------------------------------ analyses of the history


def monthly_trend(sc_history: DataFrame) -> DataFrame:
    return (
        sc_history.groupBy(month_start(F.col("data_date")).alias("month"))
        .agg(
            F.sum("clicks").alias("clicks"),
            F.sum("impressions").alias("impressions"),
            _weighted("position", "impressions").alias("position"),
            F.count_distinct("query").alias("unique_queries"),
        )
        .select(
            "month",
            "clicks",
            "impressions",
            pct(F.col("clicks"), F.col("impressions"), 2).alias("ctr_pct"),
            round_at(F.col("position"), 1).alias("avg_position"),
            "unique_queries",
        )
    )


def ctr_by_position_band(sc_history: DataFrame) -> DataFrame:
    """Click rate in positions up to 3, up to 10 and below, and the impressions of the first band."""
    p = F.col("position")
    bands = {"top3": p <= 3, "pos4_10": (p > 3) & (p <= 10), "pos11_plus": p > 10}
    sums = [
        F.sum(F.when(inside, F.col(c))).alias(f"{name}_{c}")
        for name, inside in bands.items()
        for c in ("clicks", "impressions")
    ]
    monthly = sc_history.groupBy(month_start(F.col("data_date")).alias("month")).agg(*sums)
    return monthly.select(
        "month",
        *[pct(F.col(f"{b}_clicks"), F.col(f"{b}_impressions"), 2).alias(f"{b}_ctr_pct") for b in bands],
        F.coalesce(F.col("top3_impressions"), F.lit(0)).alias("top3_impressions"),
    )


def brand_share(sc_history: DataFrame, brand_names: Sequence[str]) -> DataFrame:
    """Clicks of queries that contain one of the brand names (regular expressions) against the rest."""
    is_brand = F.coalesce(F.col("query").rlike("|".join(brand_names)), F.lit(False))
    clicks = lambda cond: F.sum(F.when(cond, F.col("clicks")).otherwise(0))
    return (
        sc_history.groupBy(month_start(F.col("data_date")).alias("month"))
        .agg(clicks(is_brand).alias("brand_clicks"), clicks(~is_brand).alias("non_brand_clicks"))
        .withColumn(
            "brand_share_pct", pct(F.col("brand_clicks"), F.col("brand_clicks") + F.col("non_brand_clicks"))
        )
    )


Period = tuple[dt.date, dt.date]


def _two_periods(sc_history: DataFrame, by: Column, old: Period, new: Period) -> DataFrame:
    """Clicks and weighted position in two inclusive periods, read in one filtered pass."""
    day = F.col("data_date")
    parts = {"old": day.between(*map(F.lit, old)), "new": day.between(*map(F.lit, new))}
    aggs = []
    for name, inside in parts.items():
        picked = lambda c, i=inside: F.sum(F.when(i, c))
        aggs += [
            F.coalesce(picked(F.col("clicks")), F.lit(0)).alias(f"{name}_clicks"),
            ratio(picked(F.col("position") * F.col("impressions")), picked(F.col("impressions"))).alias(
                f"{name}_position"
            ),
        ]
    return sc_history.filter(parts["old"] | parts["new"]).groupBy(by.alias("item")).agg(*aggs)


def query_decline(sc_history: DataFrame, old: Period, new: Period, top: int = 20) -> DataFrame:
    """The queries that lost most clicks between two periods."""
    both = _two_periods(sc_history.filter(F.col("query").isNotNull()), F.col("query"), old, new)
    return (
        both.select(
            F.col("item").alias("query"),
            "old_clicks",
            "new_clicks",
            (F.col("new_clicks") - F.col("old_clicks")).alias("click_diff"),
            round_at(F.col("old_position"), 1).alias("old_position"),
            round_at(F.col("new_position"), 1).alias("new_position"),
        )
        .orderBy("click_diff", "query")
        .limit(top)
    )


def page_decline(sc_history: DataFrame, old: Period, new: Period, top: int = 15) -> DataFrame:
    """The pages that lost most clicks between two periods, with the change in percent."""
    paged = sc_history.withColumn("page", url_path(F.col("url"))).filter(F.col("page").isNotNull())
    change = F.col("new_clicks") - F.col("old_clicks")
    return (
        _two_periods(paged, F.col("page"), old, new)
        .select(
            F.col("item").alias("page"),
            "old_clicks",
            "new_clicks",
            pct(change, F.col("old_clicks"), 0).alias("change_pct"),
        )
        .orderBy(F.col("new_clicks") - F.col("old_clicks"), "page")
        .limit(top)
    )


def query_survival(sc_history: DataFrame, old: Period, new: Period) -> DataFrame:
    """How many queries lost, kept or gained their clicks between two periods."""
    both = _two_periods(sc_history.filter(F.col("query").isNotNull()), F.col("query"), old, new)
    was, now = F.col("old_clicks"), F.col("new_clicks")
    return both.agg(
        F.count_if((was >= 50) & (now < 5)).alias("lost_50_to_5"),
        F.count_if((was >= 100) & (now < 10)).alias("lost_100_to_10"),
        F.count_if((was >= 500) & (now < 50)).alias("lost_500_to_50"),
        F.count_if((was >= 50) & (now * 2 >= was)).alias("kept_half"),
        F.count_if((was == 0) & (now >= 50)).alias("gained_50"),
    )
