"""Shop reports: profit, channels, customers, email, SKUs, stock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.channels import with_channel
from martloom.functions.scalars import (
    days_before,
    growth_pct,
    mean_of,
    month_start,
    months_between_starts,
    pct,
    ratio,
    round_at,
    stamp,
    week_start,
)
from martloom.functions.utm import resolved
from martloom.operators.joins import list_days, point_in_time, valid_on
from martloom.operators.keyed import latest_wins
from martloom.operators.periods import value_periods
from martloom.operators.quantiles import histogram_quartiles
from martloom.operators.skew import SALT, spread_hot_keys

# ---- fixed values ----
COST_EPOCH = dt.date(2020, 1, 1)
COST_HORIZON = dt.date(2099, 12, 31)
GIFT_TAG = "ギフト設定"
DORMANT_DAYS = 180
AD_CHANNELS = ("google_paid", "meta_paid", "yahoo_paid", "microsoft_paid")
RISING, DECLINING = 1.20, 0.80
# ---- end of fixed values ----


def one_row_per_order(orders: DataFrame) -> DataFrame:
    """Order-level view of the line table, for revenue that counts each order once.

    Every order is one of its own rows: of those landed last, a refunded one if there is any, then by the other
    columns. An order that landed twice with changed values never becomes a mixture.
    """
    level = [c for c in orders.columns if c not in _LINE_COLUMNS and c != "order_id"]
    newest = "inserted_at" if "inserted_at" in orders.columns else "order_id"
    refunded_first = sorted(level, key=lambda c: c != "is_refunded")
    return latest_wins(orders.select("order_id", *level, *({"inserted_at"} & {newest})), ["order_id"], newest, refunded_first).select("order_id", *level)


_LINE_COLUMNS = {
    "line_item_id", "product_id", "variant_id", "sku", "sku_title", "variant_title",
    "quantity", "unit_price", "line_discount", "inserted_at",
}


def _basis(orders: DataFrame, revenue_basis: str, columns: list[str]) -> DataFrame:
    """line: total_price counts on every line of its order, as the reports are defined; order: once."""
    if revenue_basis == "line":
        return orders.select(*columns)
    if revenue_basis == "order":
        return one_row_per_order(orders).select(*columns)
    raise ValueError(f"revenue_basis is 'line' or 'order', not {revenue_basis!r}")


def _has_sku() -> Column:
    return F.col("sku").isNotNull() & (F.col("sku") != "")


def _has_email() -> Column:
    return F.col("customer_email").isNotNull()


# ------------------------------------------------------------------ costs and profit


def ec_cost_master(
    products_daily: DataFrame, epoch: dt.date = COST_EPOCH, horizon: dt.date = COST_HORIZON
) -> DataFrame:
    """Cost price periods per SKU out of the daily product snapshot.

    Several rows of a SKU on one day are settled first (last insert wins, then the higher price), which
    also bounds the window partitions by the number of days.
    """
    known = products_daily.filter(F.col("cost_price").isNotNull() & _has_sku())
    daily = known.groupBy("sku", "fetched_date").agg(
        F.max(F.struct("inserted_at", "cost_price")).getField("cost_price").alias("cost_price")
    )
    return value_periods(daily, "sku", "cost_price", "fetched_date", epoch, horizon)


def ec_daily_pnl(orders: DataFrame, cost_master: DataFrame, shipping_rules: DataFrame) -> DataFrame:
    """Profit per order line with the cost and shipping fee valid on the order date."""
    lines = orders.select(
        "order_date", "order_id", "sku", "quantity", "unit_price", "total_price", "is_refunded", "refund_amount"
    )
    costed = point_in_time(lines, cost_master, "sku", "order_date", ["cost_price"], spread=["order_id"])
    charged = valid_on(costed, shipping_rules, "order_date", ["shipping_fee_per_order"])
    total_cost = F.col("cost_price") * F.col("quantity")
    gross = F.col("total_price") - total_cost
    net = gross - F.col("shipping_fee_per_order")
    return charged.select(
        "order_date",
        "order_id",
        "sku",
        "quantity",
        "unit_price",
        F.col("total_price").alias("revenue"),
        "cost_price",
        total_cost.alias("total_cost"),
        gross.alias("gross_profit"),
        "shipping_fee_per_order",
        net.alias("actual_gross_profit"),
        pct(net, F.col("total_price")).alias("actual_margin_pct"),
        "is_refunded",
        "refund_amount",
    )


# ------------------------------------------------------------------ channels


def ad_cost_feed(google: DataFrame, meta: DataFrame, yahoo: DataFrame, microsoft: DataFrame) -> DataFrame:
    """Advertising cost per day and paid channel."""
    tagged = [
        ads.select("date", F.lit(label).alias("channel"), "cost")
        for label, ads in zip(AD_CHANNELS, (google, meta, yahoo, microsoft))
    ]
    feed = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).unionByName(tagged[3])
    return feed.groupBy("date", "channel").agg(F.sum("cost").alias("ad_cost"))


def ec_channel_roi(
    orders: DataFrame,
    google_ads: DataFrame,
    meta_ads: DataFrame,
    yahoo_ads: DataFrame,
    microsoft_ads: DataFrame,
    revenue_basis: str = "line",
) -> DataFrame:
    """Orders, revenue and refunds per day and channel next to what the channel cost that day."""
    columns = [
        "order_id", "customer_email", "order_date", "total_price", "is_refunded",
        "utm_source", "utm_medium", "landing_site", "referring_site",
    ]
    sales = (
        with_channel(_basis(orders, revenue_basis, columns), "roi")
        .groupBy(F.col("order_date").alias("date"), "channel")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_email").alias("unique_customers"),
            F.sum("total_price").alias("revenue"),
            F.count_if("is_refunded").alias("refund_count"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    costs = ad_cost_feed(google_ads, meta_ads, yahoo_ads, microsoft_ads)
    return sales.join(costs, ["date", "channel"], "full").select(
        "date",
        "channel",
        "orders",
        "unique_customers",
        "revenue",
        "ad_cost",
        round_at(ratio(F.col("revenue"), F.col("ad_cost")), 2).alias("roas"),
        round_at(ratio(F.col("ad_cost"), F.col("orders"))).alias("cpa"),
        "refund_count",
        pct(F.col("refund_count"), F.col("_rows")).alias("refund_rate_pct"),
        ratio(F.col("revenue"), F.col("unique_customers")).alias("ltv"),
    )


def ec_customer_profile(
    orders: DataFrame, as_of: dt.date, generated_at: dt.datetime | None = None, revenue_basis: str = "line"
) -> DataFrame:
    """One row per customer. First and last channel of a day with several orders go by order id, equally
    frequent SKUs by name."""
    favorite = (
        orders.filter(_has_email() & F.col("sku").isNotNull())
        .groupBy("customer_email", "sku")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("customer_email")
        .agg(F.min(F.struct(-F.col("n"), "sku")).getField("sku").alias("favorite_sku"))
    )
    per_line = with_channel(orders.filter(_has_email()), "profile")
    touch = F.struct("order_date", "order_id", "channel")
    customers = per_line.groupBy("customer_email").agg(
        F.max("customer_id").alias("customer_id"),
        F.min(touch).alias("first"),
        F.max(touch).alias("last"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("total_price").alias("total_revenue"),
        F.count("total_price").alias("_priced"),
        F.count_if(F.col("tags").contains(GIFT_TAG)).alias("gift_purchase_count"),
    )
    if revenue_basis == "order":
        once = one_row_per_order(orders.select("order_id", "customer_email", "total_price"))
        totals = once.groupBy("customer_email").agg(
            F.sum("total_price").alias("total_revenue"), F.count("total_price").alias("_priced")
        )
        customers = customers.drop("total_revenue", "_priced").join(totals, "customer_email", "left")
    elif revenue_basis != "line":
        raise ValueError(f"revenue_basis is 'line' or 'order', not {revenue_basis!r}")
    idle = F.date_diff(F.lit(as_of), F.col("last.order_date")).cast("long")
    return customers.join(favorite, "customer_email", "left").select(
        "customer_email",
        "customer_id",
        F.col("first.order_date").alias("first_order_date"),
        F.col("last.order_date").alias("last_order_date"),
        "total_orders",
        "total_revenue",
        round_at(mean_of(F.col("total_revenue"), F.col("_priced"))).alias("avg_order_value"),
        idle.alias("days_since_last_order"),
        month_start(F.col("first.order_date")).alias("cohort_month"),
        (idle >= DORMANT_DAYS).alias("is_dormant"),
        (F.col("total_orders") >= 2).alias("is_repeater"),
        F.col("first.channel").alias("first_channel"),
        F.col("last.channel").alias("last_channel"),
        "favorite_sku",
        "gift_purchase_count",
        *stamp(generated_at),
    )


def ec_attribution_first_last(orders: DataFrame, generated_at: dt.datetime | None = None) -> DataFrame:
    """First against last channel of each customer. Campaigns are the first and last known ones."""
    touch = F.struct("order_date", "order_id", "channel")
    tagged = F.when(F.col("campaign").isNotNull(), F.struct("order_date", "order_id", "campaign"))
    customers = (
        with_channel(orders.filter(_has_email()), "attribution")
        .withColumn("campaign", resolved("utm_campaign"))
        .groupBy("customer_email")
        .agg(
            F.min(touch).alias("first"),
            F.max(touch).alias("last"),
            F.min(tagged).getField("campaign").alias("first_utm_campaign"),
            F.max(tagged).getField("campaign").alias("last_utm_campaign"),
            F.count_distinct("order_id").alias("total_orders"),
        )
    )
    same = F.col("first.channel") == F.col("last.channel")
    return customers.select(
        "customer_email",
        F.col("first.order_date").alias("first_order_date"),
        F.col("first.channel").alias("first_channel"),
        "first_utm_campaign",
        F.col("last.order_date").alias("last_order_date"),
        F.col("last.channel").alias("last_channel"),
        "last_utm_campaign",
        "total_orders",
        same.alias("is_same_channel"),
        F.when(F.col("total_orders") == 1, "one_time")
        .when(same, "loyal_same_channel")
        .otherwise("cross_channel")
        .alias("journey_type"),
        *stamp(generated_at),
    )


# ------------------------------------------------------------------ cohorts and repeat purchases


def ec_cohort_ltv(
    orders: DataFrame, generated_at: dt.datetime | None = None, revenue_basis: str = "line"
) -> DataFrame:
    """Retention and cumulative revenue per month of first purchase. Months without orders are absent."""
    bought = _basis(orders, revenue_basis, ["customer_email", "order_date", "order_id", "total_price"]).filter(
        _has_email()
    )
    monthly = bought.groupBy("customer_email", month_start(F.col("order_date")).alias("month"), "order_id").agg(
        F.sum("total_price").alias("revenue")
    )
    joined = bought.groupBy("customer_email").agg(month_start(F.min("order_date")).alias("cohort_month"))
    # a customer may hold a large share of the orders; both sides come out of aggregations
    spread, cohorts = spread_hot_keys(monthly, joined, ["customer_email"], ["order_id"], key_source=orders)
    cells = (
        spread.join(cohorts, ["customer_email", SALT])
        .groupBy(
            "cohort_month",
            months_between_starts(F.col("month"), F.col("cohort_month")).alias("months_since_first"),
        )
        .agg(
            F.count_distinct("customer_email").alias("active_customers"),
            F.count_distinct("order_id").alias("month_orders"),
            F.sum("revenue").alias("month_revenue"),
        )
    )
    # from here on one row per pair of months
    cohort = Window.partitionBy("cohort_month")
    so_far = cohort.orderBy("months_since_first")
    at_start = F.when(F.col("months_since_first") == 0, F.col("active_customers"))
    return (
        cells.withColumn("cumulative_orders", F.sum("month_orders").over(so_far))
        .withColumn("cumulative_revenue", F.sum("month_revenue").over(so_far))
        # everybody of a cohort buys in its first month
        .withColumn("cohort_size", F.max(at_start).over(cohort))
        .select(
            "cohort_month",
            "months_since_first",
            "cohort_size",
            "active_customers",
            pct(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
            "month_orders",
            "month_revenue",
            "cumulative_orders",
            "cumulative_revenue",
            round_at(ratio(F.col("cumulative_revenue"), F.col("cohort_size"))).alias("cumulative_ltv"),
            *stamp(generated_at),
        )
    )


def ec_repeat_pattern(
    orders: DataFrame, generated_at: dt.datetime | None = None, max_index: int = 10, sort: bool = False
) -> DataFrame:
    """Days from the n-th to the next purchase day. Orders of one day are one purchase.

    All figures come from the histogram of gaps, so they are exact at any number of customers.
    """
    # a customer has at most one row per day here, which bounds the window partitions
    days = orders.filter(_has_email()).select("customer_email", "order_date").distinct()
    w = Window.partitionBy("customer_email").orderBy("order_date")
    gaps = (
        days.select(
            F.row_number().over(w).cast("long").alias("order_index"),
            F.date_diff(F.lead("order_date").over(w), F.col("order_date")).cast("long").alias("gap"),
        )
        .filter(F.col("gap").isNotNull() & (F.col("order_index") <= max_index))
        .groupBy("order_index", "gap")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    within = lambda d: F.sum(F.when(F.col("gap") <= d, F.col("n")).otherwise(0))
    totals = gaps.groupBy("order_index").agg(
        F.sum("n").alias("customer_count"),
        F.sum(F.col("gap") * F.col("n")).alias("_days"),
        *[within(d).alias(f"_within_{d}") for d in (30, 60, 90, 180)],
    )
    report = totals.join(histogram_quartiles(gaps, "order_index", "gap", "n"), "order_index").select(
        "order_index",
        "customer_count",
        round_at(mean_of(F.col("_days"), F.col("customer_count"))).alias("avg_days_to_next"),
        F.col("p25").alias("p25_days"),
        F.col("p50").alias("median_days"),
        F.col("p75").alias("p75_days"),
        *[
            pct(F.col(f"_within_{d}"), F.col("customer_count")).alias(f"pct_within_{d}d")
            for d in (30, 60, 90, 180)
        ],
        *stamp(generated_at),
    )
    return report.orderBy("order_index") if sort else report


# ------------------------------------------------------------------ email campaigns


def ec_klaviyo_conversion(
    campaigns: DataFrame, profiles: DataFrame, orders: DataFrame, window_days: int = 7
) -> DataFrame:
    """Orders of known email profiles from the day a campaign was sent to window_days later.

    Orders are summed per day before they meet the campaigns, so the join is campaign days against
    calendar days whatever the number of orders. An order id on several days counts once per campaign: on the first of
    them that the campaign's window holds. That is told by the days since the id was last seen, so a day has a row for
    each such distance within the window, and one for all others.
    """
    keys = ["campaign_id", "campaign_name", "sent_at", "recipients", "open_rate", "click_rate", "revenue"]
    known = profiles.select(F.col("email").alias("customer_email"))
    per_order_day = (
        orders.select("customer_email", "order_id", "order_date", "total_price")
        .join(known, "customer_email", "left_semi")
        .groupBy("order_id", "order_date")
        .agg(F.sum("total_price").alias("revenue"))
    )
    since = F.date_diff("order_date", F.lag("order_date").over(Window.partitionBy("order_id").orderBy("order_date")))
    per_day = (
        per_order_day.withColumn("since", F.when(since <= window_days, since))
        .groupBy("order_date", "since")
        .agg(F.count(F.lit(1)).alias("day_orders"), F.sum("revenue").alias("day_revenue"))
    )
    # a campaign loaded several times is one row, but its revenue repeats per copy
    sent = campaigns.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    campaign_days = list_days(sent, F.to_date("sent_at"), window_days, "order_date")
    seen_before = F.col("since") <= F.date_diff("order_date", F.to_date("sent_at"))
    return (
        campaign_days.join(per_day, "order_date", "left")
        .withColumn("first_orders", F.when(F.coalesce(seen_before, F.lit(False)), 0).otherwise(F.col("day_orders")))
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("first_orders"), F.lit(0)).alias("shopify_orders"),
            F.sum(F.col("day_revenue") * F.col("copies")).alias("shopify_revenue"),
        )
        .select(
            *keys[:-1],
            F.col("revenue").alias("klaviyo_revenue"),
            "shopify_orders",
            "shopify_revenue",
            pct(F.col("shopify_orders"), F.col("recipients"), 2).alias("purchase_rate_pct"),
        )
    )


# ------------------------------------------------------------------ SKUs and stock


def ec_sku_trend(orders: DataFrame, cost_master: DataFrame, generated_at: dt.datetime | None = None) -> DataFrame:
    """Monthly sales per SKU with growth against the previous row and the row twelve before.

    Lines are summed per SKU and day before the cost lookup: a best seller then brings at most one row
    per day and title into the join and the windows.
    """
    lines = orders.filter(_has_sku())
    daily = lines.groupBy("sku", "sku_title", "order_date").agg(
        F.sum("quantity").alias("units"), F.sum("total_price").alias("revenue")
    )
    year_month = month_start(F.col("order_date")).alias("year_month")
    monthly = (
        point_in_time(daily, cost_master, "sku", "order_date", ["cost_price"])
        # with the title in the key this stays a hash aggregation; the few rows left decide the title
        .groupBy(year_month, "sku", "sku_title")
        .agg(
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
            F.sum(F.coalesce(F.col("cost_price"), F.lit(0)) * F.col("units")).alias("cost"),
        )
        .groupBy("year_month", "sku")
        .agg(
            F.min("sku_title").alias("sku_title"),
            F.sum("units").alias("units_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum("cost").alias("total_cost"),
        )
    )
    # windows before the next join: the rows are still together by SKU
    w = Window.partitionBy("sku").orderBy("year_month")
    last3 = w.rowsBetween(-3, -1)
    buyers = lines.groupBy(year_month, "sku").agg(F.count_distinct("customer_email").alias("unique_customers"))
    grown = (
        monthly.withColumn("previous", F.lag("revenue").over(w))
        .withColumn("year_ago", F.lag("revenue", 12).over(w))
        .withColumn("usual", mean_of(F.sum("revenue").over(last3), F.count("revenue").over(last3)))
        .join(buyers, ["sku", "year_month"])
    )
    return grown.select(
        "year_month",
        "sku",
        "sku_title",
        "units_sold",
        "revenue",
        "unique_customers",
        "total_cost",
        F.when(F.col("total_cost") > 0, F.col("revenue") - F.col("total_cost")).alias("gross_profit"),
        growth_pct(F.col("revenue"), F.col("previous")).alias("mom_growth_pct"),
        growth_pct(F.col("revenue"), F.col("year_ago")).alias("yoy_growth_pct"),
        F.when(F.col("usual").isNull(), "unknown")
        .when(F.col("revenue") >= F.col("usual") * F.lit(RISING), "rising")
        .when(F.col("revenue") <= F.col("usual") * F.lit(DECLINING), "declining")
        .otherwise("stable")
        .alias("trend_class"),
        *stamp(generated_at),
    )


def ec_inventory_health(
    inventory: DataFrame, orders: DataFrame, as_of: dt.date, generated_at: dt.datetime | None = None, sort: bool = False
) -> DataFrame:
    """Latest stock against the sales of the last 7, 30 and 90 days, read in one pass."""
    latest = inventory.agg(F.max("snapshot_date")).scalar()
    stock = inventory.filter((F.col("snapshot_date") == latest) & F.col("sku").isNotNull())
    since = lambda n: F.sum(F.when(F.col("order_date") >= days_before(as_of, n), F.col("quantity")))
    sales = (
        orders.filter((F.col("order_date") >= days_before(as_of, 90)) & _has_sku())
        .groupBy("sku")
        .agg(since(7).alias("s7"), since(30).alias("s30"), since(90).alias("s90"))
    )
    available = F.col("available")
    days_left = ratio(available, F.nullif(F.col("s7"), F.lit(0)) / F.lit(7.0))
    out_of_stock = available.isNull() | (available <= 0)
    status = (
        F.when(out_of_stock, "stockout")
        .when(F.coalesce(F.col("s90"), F.lit(0)) == 0, "no_recent_sales")
        .when(days_left < 7, "at_risk_7d")
        .when(days_left < 14, "at_risk_14d")
        .when(days_left >= 90, "overstock")
        .otherwise("healthy")
    )
    urgency = F.when(out_of_stock, 1).when(days_left < 7, 2).when(days_left < 14, 3).otherwise(99)
    joined = stock.join(sales, "sku", "left")
    if sort:
        joined = joined.orderBy(urgency, F.coalesce(F.col("s30"), F.lit(0)).desc(), "sku")
    return joined.select(
        "snapshot_date",
        "sku",
        "item_name",
        F.col("quantity").alias("total_quantity"),
        "available",
        "backordered",
        "processing",
        "shipping",
        *[F.coalesce(F.col(f"s{n}"), F.lit(0)).alias(f"sold_{n}d") for n in (7, 30, 90)],
        round_at(days_left, 1).alias("days_of_stock"),
        pct(F.col("s30"), available).alias("turnover_30d_pct"),
        status.alias("status"),
        *stamp(generated_at),
    )


def ec_storage_cost_estimated(
    inventory: DataFrame,
    size_map: DataFrame,
    storage_rate: DataFrame,
    generated_at: dt.datetime | None = None,
    sort: bool = False,
) -> DataFrame:
    """Storage fee of each stock row by the size class and rate valid on the snapshot day."""
    stock = inventory.filter(F.col("sku").isNotNull()).select("snapshot_date", "sku", "item_name", "quantity")
    sized = point_in_time(stock, size_map, "sku", "snapshot_date", ["size_category"])
    rated = point_in_time(
        sized, storage_rate, "size_category", "snapshot_date", ["daily_rate_yen", "monthly_rate_yen"]
    )
    result = rated.select(
        "snapshot_date",
        "sku",
        "item_name",
        F.col("quantity").alias("stock_qty"),
        "size_category",
        "daily_rate_yen",
        "monthly_rate_yen",
        round_at(F.col("quantity") * F.col("daily_rate_yen"), 2).alias("estimated_daily_cost_yen"),
        (F.col("quantity") * F.col("monthly_rate_yen")).cast("double").alias("estimated_monthly_cost_yen"),
        *stamp(generated_at),
    )
    if sort:
        result = result.orderBy(F.desc("snapshot_date"), F.desc_nulls_last("estimated_daily_cost_yen"), "sku")
    return result


def ec_weekly_summary(orders: DataFrame, revenue_basis: str = "line", sort: bool = False) -> DataFrame:
    """Revenue, orders, customers and refunds per week starting on Monday."""
    weekly = (
        _basis(orders, revenue_basis, ["order_id", "customer_email", "order_date", "total_price", "is_refunded"])
        .groupBy(week_start(F.col("order_date")).alias("week_start"))
        .agg(
            F.sum("total_price").alias("weekly_revenue"),
            F.count_distinct("order_id").alias("weekly_orders"),
            F.count_distinct("customer_email").alias("weekly_customers"),
            F.count("total_price").alias("_priced"),
            F.count_if("is_refunded").alias("refund_count"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    result = weekly.select(
        "week_start",
        "weekly_revenue",
        "weekly_orders",
        "weekly_customers",
        round_at(mean_of(F.col("weekly_revenue"), F.col("_priced"))).alias("avg_order_value"),
        "refund_count",
        pct(F.col("refund_count"), F.col("_rows")).alias("refund_rate_pct"),
    )
    return result.orderBy(F.desc("week_start")) if sort else result
