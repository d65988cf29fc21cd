"""Every job over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.functions.channels import with_channel
from martloom.plans import central, leasing, quality, search, shop
from martloom.session import partition_by_size, use_utc
from martloom.sources.given import BRANDS, EPOCH, OWN_URL, SHOP_DAY, SHOP_NOW, Given
from martloom.sources.io import last_days, shipping_seed

Query = Callable[[SparkSession, str], DataFrame]

OLD_PERIOD = (dt.date(2000, 7, 1), dt.date(2000, 12, 31))
NEW_PERIOD = (dt.date(2001, 2, 1), dt.date(2001, 7, 31))

QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        g = Given(use_utc(spark), sf_dir)
        partition_by_size(spark, g.size)
        return fn(g)

    QUERIES[fn.__name__] = run
    return fn


# ------------------------------------------------------------------ shop


@query
def ec_weekly_summary(g: Given) -> DataFrame:
    return shop.ec_weekly_summary(g.orders, sort=True)


@query
def ec_weekly_summary_per_order(g: Given) -> DataFrame:
    # the given lines are refunded one by one; an order counts as refunded when a line of it is
    refunded = F.max("is_refunded").over(Window.partitionBy("order_id"))
    return shop.ec_weekly_summary(g.orders.withColumn("is_refunded", refunded), revenue_basis="order", sort=True)


@query
def ec_cost_master(g: Given) -> DataFrame:
    return shop.ec_cost_master(g.products_daily, epoch=EPOCH)


@query
def ec_daily_pnl(g: Given) -> DataFrame:
    return shop.ec_daily_pnl(g.orders, ec_cost_master(g), g.shipping_rules)


@query
def ad_cost_feed(g: Given) -> DataFrame:
    return shop.ad_cost_feed(*g.ad_sources)


@query
def ec_channel_roi(g: Given) -> DataFrame:
    return shop.ec_channel_roi(g.orders, *g.ad_sources)


def _channels(g: Given, variant: str) -> DataFrame:
    return (
        with_channel(g.orders, variant)
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("order_id").alias("orders"))
    )


@query
def channel_rules_roi(g: Given) -> DataFrame:
    return _channels(g, "roi")


@query
def channel_rules_profile(g: Given) -> DataFrame:
    return _channels(g, "profile")


@query
def channel_rules_attribution(g: Given) -> DataFrame:
    return _channels(g, "attribution")


@query
def channel_rules_basic(g: Given) -> DataFrame:
    return _channels(g, "basic")


@query
def ec_channel_roi_per_order(g: Given) -> DataFrame:
    return shop.ec_channel_roi(g.orders, *g.ad_sources, revenue_basis="order")


@query
def ec_cohort_ltv_per_order(g: Given) -> DataFrame:
    return shop.ec_cohort_ltv(g.orders, revenue_basis="order")


@query
def ec_customer_profile_per_order(g: Given) -> DataFrame:
    return shop.ec_customer_profile(g.orders, SHOP_DAY, revenue_basis="order")


@query
def ec_cohort_ltv(g: Given) -> DataFrame:
    return shop.ec_cohort_ltv(g.orders, generated_at=SHOP_NOW)


@query
def ec_repeat_pattern(g: Given) -> DataFrame:
    return shop.ec_repeat_pattern(g.orders, generated_at=SHOP_NOW, sort=True)


@query
def ec_customer_profile(g: Given) -> DataFrame:
    return shop.ec_customer_profile(g.orders, SHOP_DAY, generated_at=SHOP_NOW)


@query
def ec_attribution_first_last(g: Given) -> DataFrame:
    return shop.ec_attribution_first_last(g.orders, generated_at=SHOP_NOW)


@query
def ec_klaviyo_conversion(g: Given) -> DataFrame:
    return shop.ec_klaviyo_conversion(g.campaigns, g.profiles, g.orders)


@query
def ec_sku_trend(g: Given) -> DataFrame:
    return shop.ec_sku_trend(g.orders, ec_cost_master(g), generated_at=SHOP_NOW)


@query
def ec_inventory_health(g: Given) -> DataFrame:
    return shop.ec_inventory_health(g.inventory, g.orders, SHOP_DAY, generated_at=SHOP_NOW, sort=True)


@query
def ec_storage_cost_estimated(g: Given) -> DataFrame:
    return shop.ec_storage_cost_estimated(g.inventory, g.size_map, g.storage_rate, generated_at=SHOP_NOW, sort=True)


# ------------------------------------------------------------------ search


@query
def ec_search_to_purchase(g: Given) -> DataFrame:
    return search.ec_search_to_purchase(g.sc_history, g.orders, generated_at=SHOP_NOW)


@query
def ec_seo_opportunity(g: Given) -> DataFrame:
    return search.ec_seo_opportunity(g.sc_history, g.keywords, g.orders, SHOP_DAY, OWN_URL, generated_at=SHOP_NOW)


@query
def ec_competitor_gap(g: Given) -> DataFrame:
    return search.ec_competitor_gap(g.keywords, g.orders, SHOP_DAY, OWN_URL, generated_at=SHOP_NOW, sort=True)


@query
def search_monthly_trend(g: Given) -> DataFrame:
    return search.monthly_trend(g.sc_history)


@query
def search_ctr_by_position_band(g: Given) -> DataFrame:
    return search.ctr_by_position_band(g.sc_history)


@query
def search_brand_share(g: Given) -> DataFrame:
    return search.brand_share(g.sc_history, BRANDS)


@query
def search_query_decline(g: Given) -> DataFrame:
    return search.query_decline(g.sc_history, OLD_PERIOD, NEW_PERIOD)


@query
def search_page_decline(g: Given) -> DataFrame:
    return search.page_decline(g.sc_history, OLD_PERIOD, NEW_PERIOD)


@query
def search_query_survival(g: Given) -> DataFrame:
    return search.query_survival(g.sc_history, OLD_PERIOD, NEW_PERIOD)


# ------------------------------------------------------------------ leasing


def _leasing_traffic(g: Given) -> DataFrame:
    from martloom.ingest.marketing import search_console_view

    return search_console_view(g.url_impressions, SHOP_NOW)


@query
def re_case_pipeline(g: Given) -> DataFrame:
    return leasing.re_case_pipeline(g.deals, SHOP_DAY, generated_at=SHOP_NOW, sort=True)


@query
def re_lead_funnel(g: Given) -> DataFrame:
    return leasing.re_lead_funnel(_leasing_traffic(g), g.tenants, g.deals, SHOP_DAY, generated_at=SHOP_NOW, sort=True)


@query
def re_property_performance(g: Given) -> DataFrame:
    return leasing.re_property_performance(g.properties, g.deals, g.activities, SHOP_DAY, generated_at=SHOP_NOW, sort=True)


@query
def re_seo_inquiry_attribution(g: Given) -> DataFrame:
    return leasing.re_seo_inquiry_attribution(_leasing_traffic(g), g.tenants, SHOP_NOW, generated_at=SHOP_NOW)


@query
def re_weekly_summary(g: Given) -> DataFrame:
    return leasing.re_weekly_summary(re_lead_funnel(g), generated_at=SHOP_NOW, sort=True)


# ------------------------------------------------------------------ both businesses, planned reports


@query
def all_revenue_summary(g: Given) -> DataFrame:
    return central.all_revenue_summary(shop.ec_weekly_summary(g.orders), re_weekly_summary(g).drop("generated_at"))


@query
def ec_ad_performance(g: Given) -> DataFrame:
    return central.ec_ad_performance(*g.ad_sources, ec_channel_roi(g))


@query
def ec_refund_analysis_by_sku(g: Given) -> DataFrame:
    return central.refunds_by_channel_and_sku(g.orders)


@query
def ec_refund_analysis_roas(g: Given) -> DataFrame:
    return central.effective_roas(g.orders, *g.ad_sources)


# ------------------------------------------------------------------ quality


@query
def quality_duplicate_keys(g: Given) -> DataFrame:
    return quality.duplicate_keys(g.orders, ["order_id", "line_item_id"])


@query
def quality_overlapping_periods(g: Given) -> DataFrame:
    """Weekly price tags that stay valid for thirty days overlap wherever a SKU is seen twice within them."""
    tags = (
        g.products_daily.select("sku", F.col("fetched_date").alias("valid_from"))
        .distinct()
        .withColumn("valid_to", F.date_add("valid_from", 29))
    )
    return quality.overlapping_periods(tags, ["sku"])


@query
def quality_missing_required(g: Given) -> DataFrame:
    from martloom.sources.schemas import struct

    declared = struct("order_id S!, landing_site S!, referring_site S!, utm_source S!, utm_medium S, refund_amount I!")
    return quality.missing_required(g.orders, declared)


@query
def quality_skus_without_size(g: Given) -> DataFrame:
    return quality.skus_without_master(g.orders, g.size_map)


@query
def quality_stock_without_cost(g: Given) -> DataFrame:
    """Stocked SKUs that no cost master knows when it is built from the last sixty days of sightings."""
    recent = last_days(g.products_daily, "fetched_date", SHOP_DAY, 60)
    return quality.skus_without_master(g.inventory, shop.ec_cost_master(recent, epoch=EPOCH))


@query
def quality_overlapping_rules(g: Given) -> DataFrame:
    """Shipping rules without a key: the seeded one, one per nation, and every fifth of those delivered twice."""
    k = F.col("n_nationkey")
    start = F.date_add(F.lit(dt.date(2015, 1, 1)), (k * 90).cast("int"))
    nations = g.table("nation").select(
        start.alias("valid_from"), F.date_add(start, (k % 7 * 30).cast("int")).alias("valid_to"), (900 + k * 10).cast("long").alias("shipping_fee_per_order")
    )
    twice = nations.filter(F.col("shipping_fee_per_order") % 50 == 0)
    return quality.overlapping_periods(shipping_seed(g.spark).unionByName(nations).unionByName(twice))


@query
def yearly_orders(g: Given) -> DataFrame:
    return quality.yearly_orders(g.orders)
