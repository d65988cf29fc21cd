"""Reports across both businesses, and shop reports by medium."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.channels import with_channel
from martloom.functions.scalars import pct, ratio, round_at, week_start
from martloom.plans.shop import AD_CHANNELS, ad_cost_feed


def all_revenue_summary(shop_weekly: DataFrame, leasing_weekly: DataFrame) -> DataFrame:
    """The weekly figures of both businesses under one another, by column name."""
    tag = lambda df, name: df.withColumn("business", F.lit(name))
    return tag(shop_weekly, "ec").unionByName(tag(leasing_weekly, "re"), allowMissingColumns=True)


def ec_ad_performance(
    google: DataFrame, meta: DataFrame, yahoo: DataFrame, microsoft: DataFrame, channel_roi: DataFrame
) -> DataFrame:
    """Per paid channel and week: what the ads delivered, cost and returned in shop revenue."""
    cols = ["date", "impressions", "clicks", "cost", "conversions"]
    feeds = [
        ads.select(F.lit(label).alias("channel"), *cols)
        for label, ads in zip(AD_CHANNELS, (google, meta, yahoo, microsoft))
    ]
    ads = feeds[0].unionByName(feeds[1]).unionByName(feeds[2]).unionByName(feeds[3])
    week = week_start(F.col("date")).alias("week_start")
    delivered = ads.groupBy("channel", week).agg(*[F.sum(c).alias(c) for c in cols[1:]])
    earned = (
        channel_roi.filter(F.col("channel").isin(*AD_CHANNELS))
        .groupBy("channel", week)
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    )
    return delivered.join(earned, ["channel", "week_start"], "full").select(
        "channel",
        "week_start",
        "impressions",
        "clicks",
        "cost",
        "conversions",
        "orders",
        "revenue",
        pct(F.col("clicks"), F.col("impressions"), 2).alias("ctr_pct"),
        round_at(ratio(F.col("revenue"), F.col("cost")), 2).alias("roas"),
    )


def refunds_by_channel_and_sku(orders: DataFrame) -> DataFrame:
    """Lines, refunded lines and refund rate per channel and SKU."""
    return (
        with_channel(orders, "roi")
        .groupBy("channel", "sku")
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if("is_refunded").alias("refunds"))
        .withColumn("refund_rate_pct", pct(F.col("refunds"), F.col("lines")))
    )


def effective_roas(
    orders: DataFrame, google: DataFrame, meta: DataFrame, yahoo: DataFrame, microsoft: DataFrame
) -> DataFrame:
    """Return on ad cost per channel after refunds."""
    sales = (
        with_channel(orders, "roi")
        .groupBy("channel")
        .agg(
            F.sum("total_price").alias("revenue"),
            F.coalesce(F.sum("refund_amount"), F.lit(0)).alias("refund_amount"),
        )
    )
    costs = (
        ad_cost_feed(google, meta, yahoo, microsoft).groupBy("channel").agg(F.sum("ad_cost").alias("ad_cost"))
    )
    net = F.col("revenue") - F.col("refund_amount")
    return sales.join(costs, "channel", "full").select(
        "channel", "revenue", "refund_amount", "ad_cost", round_at(ratio(net, F.col("ad_cost")), 2).alias("effective_roas")
    )
