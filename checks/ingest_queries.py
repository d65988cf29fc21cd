"""Ingest jobs, loads and streams. Payloads are built from the given tables by Spark, so that the jobs read
as many payloads as there are rows."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checks import queries as leasing_queries
from checks.queries import query
from martloom.functions import utm
from martloom.functions.scalars import url_host, url_path
from martloom.ingest import entities, marketing, payloads, shop
from martloom.operators import keyed, sketches
from martloom.plans import central, leasing, search
from martloom.plans import shop as reports
from martloom.sources import io
from martloom.sources.given import EPOCH, OWN_URL, SHOP_DAY, SHOP_NOW, Given
from martloom.sources.schemas import struct
from martloom.streaming import landing

RUN = SHOP_NOW


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop("inserted_at")


# ------------------------------------------------------------------ orders


def order_payloads(g: Given) -> DataFrame:
    """An order document per given line: the line, and a gift box for taxed lines."""
    raw = g.table("lineitem").join(g.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("o_orderkey")
    from martloom.sources.given import VISITS

    pages = F.array(*[F.lit(v[0]).cast("string") for v in VISITS])
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))
    discount = F.array(
        F.struct(_s(F.floor(F.col("l_extendedprice") * F.col("l_discount"))).alias("amount")),
        F.struct(F.lit("0.5").alias("amount")),
    )
    line = lambda no, sku, off: F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", F.lit(no)).alias("id"),
        _s("l_partkey").alias("product_id"),
        F.concat("l_partkey", F.lit("v")).alias("variant_id"),
        sku.alias("sku"),
        F.concat(F.lit("Part "), "l_partkey").alias("title"),
        F.when(F.col("l_linestatus") == "O", "open").otherwise("").alias("variant_title"),
        F.col("l_quantity").cast("long").alias("quantity"),
        _s("l_extendedprice").alias("price"),
        off.alias("discount_allocations"),
    )
    none = F.filter(discount, lambda _: F.lit(False))
    lines = F.array(
        line("a", _s("l_partkey"), F.when(F.col("l_discount") > 0, discount).otherwise(none)),
        line("b", F.lit(None).cast("string"), none),
    )
    refund = lambda note, a, b: F.struct(
        iso("l_shipdate").alias("created_at"),
        F.lit(note).alias("note"),
        F.array(F.struct(a.alias("amount")), F.struct(b.alias("amount"))).alias("transactions"),
    )
    refunds = F.array(
        refund("damaged", _s(F.floor("l_extendedprice")), F.lit("0.5")), refund("second", F.lit("1"), F.lit("2"))
    )
    email = F.concat(F.lit("customer"), "o_custkey", F.lit("@example.com"))
    urgency = F.substring("o_orderpriority", 1, 1)
    return raw.select(
        F.to_json(
            F.struct(
                _s(key).alias("id"),
                F.concat(F.lit("#"), key).alias("name"),
                iso("o_orderdate").alias("created_at"),
                F.when(urgency == "4", F.concat(F.lit("guest-"), email)).alias("email"),
                F.when(urgency < "4", F.struct(_s("o_custkey").alias("id"), email.alias("email"))).alias("customer"),
                F.lower("o_orderstatus").alias("financial_status"),
                _s("o_totalprice").alias("total_price"),
                _s(F.floor("o_totalprice") + 0.5).alias("subtotal_price"),
                F.when(urgency != "2", _s(F.floor(F.col("o_totalprice") / 10))).alias("total_discounts"),
                F.when(urgency == "3", "n/a").otherwise(_s(F.floor(F.col("o_totalprice") / 20))).alias("total_tax"),
                F.when(urgency != "1", "web").otherwise("").alias("source_name"),
                F.concat(F.lit("https://ref.example.org/"), key % 9).alias("referring_site"),
                F.get(pages, F.pmod(key, F.lit(len(VISITS))).cast("int")).alias("landing_site"),
                F.lit("").alias("tags"),
                F.when(F.col("l_returnflag") == "R", refunds).alias("refunds"),
                F.slice(lines, 1, F.when(F.col("l_tax") > 0.04, 2).otherwise(1)).alias("line_items"),
            )
        ).alias("body")
    )


ORDER_COLUMNS = (
    "order_id", "order_name", "created_at", "order_date", "customer_id", "customer_email", "financial_status", "total_price",
    "subtotal_price", "total_discounts", "total_tax", "line_item_id", "product_id", "variant_id", "sku", "sku_title",
    "variant_title", "quantity", "unit_price", "line_discount", "is_refunded", "refund_date", "refund_amount",
    "refund_reason", "source_name", "landing_site", "referring_site", "utm_source", "utm_medium", "utm_campaign", "tags",
)


@query
def ingest_orders_rest(g: Given) -> DataFrame:
    return shop.orders_from_rest(payloads.parse(order_payloads(g), payloads.ORDER), RUN).select(*ORDER_COLUMNS)


def bulk_documents(g: Given) -> DataFrame:
    """The mixed export: every order, line and refund is a document of its own."""
    gid = lambda kind, k: F.concat(F.lit(f"gid://shop/{kind}/"), k)
    yen = lambda c: F.struct(F.struct(_s(c).alias("amount")).alias("shopMoney"))
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    at = lambda kind, row: F.struct(F.lit(kind).alias("file"), F.lit(0).cast("long").alias("block"), row.alias("row"))
    o, li = g.table("orders"), g.table("lineitem")
    email = F.concat(F.lit("customer"), "o_custkey", F.lit("@example.com"))
    heads = o.select(
        at("o", F.col("o_orderkey")).alias("seq"),
        F.to_json(
            F.struct(
                gid("Order", "o_orderkey").alias("id"),
                F.concat(F.lit("#"), "o_orderkey").alias("name"),
                iso("o_orderdate").alias("createdAt"),
                F.when(F.col("o_orderpriority") != "5-LOW", email).alias("email"),
                F.struct(gid("Customer", "o_custkey").alias("id")).alias("customer"),
                F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("displayFinancialStatus"),
                yen(F.floor("o_totalprice") + 0.5).alias("totalPriceSet"),
                yen(F.floor(F.col("o_totalprice") / 2)).alias("totalRefundedSet"),
                yen(F.floor(F.col("o_totalprice") / 3)).alias("subtotalPriceSet"),
                yen(F.floor(F.col("o_totalprice") / 10)).alias("totalDiscountsSet"),
                F.when(F.col("o_orderstatus") != "F", yen(F.floor(F.col("o_totalprice") / 20))).alias("totalTaxSet"),
                F.concat(F.lit("/p/"), F.col("o_custkey") % 9, F.lit("?utm_source=news&utm_medium=email")).alias("landingPageUrl"),
                F.lit("https://ref.example.org/").alias("referrerUrl"),
                F.lit("web").alias("sourceName"),
                F.array(F.lit("a"), F.lit("b")).alias("tags"),
            )
        ).alias("body"),
    )
    lines = li.select(
        at("l", F.col("l_partkey")).alias("seq"),
        F.to_json(
            F.struct(
                gid("LineItem", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")).alias("id"),
                gid("Order", "l_orderkey").alias("__parentId"),
                _s("l_partkey").alias("sku"),
                F.col("l_quantity").cast("long").alias("quantity"),
                yen("l_extendedprice").alias("originalUnitPriceSet"),
                F.concat(F.lit("Part "), "l_partkey").alias("title"),
                F.when(F.col("l_linestatus") == "O", "open").alias("variantTitle"),
                F.struct(gid("Product", "l_partkey").alias("id")).alias("product"),
                F.struct(gid("ProductVariant", F.concat("l_partkey", F.lit("v"))).alias("id")).alias("variant"),
                F.array(
                    F.struct(yen(F.floor(F.col("l_discount") * 100 + 0.5)).alias("allocatedAmountSet")),
                    F.struct(yen(F.lit("0.5")).alias("allocatedAmountSet")),
                ).alias("discountAllocations"),
            )
        ).alias("body"),
    )
    refunds = li.filter(F.col("l_returnflag") == "R").select(
        at("r", F.col("l_linenumber").cast("long")).alias("seq"),
        F.to_json(
            F.struct(
                gid("Refund", F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("id"),
                gid("Order", "l_orderkey").alias("__parentId"),
                iso("l_shipdate").alias("createdAt"),
                F.concat(F.lit("part "), "l_partkey").alias("note"),
            )
        ).alias("body"),
    )
    return heads.unionByName(lines).unionByName(refunds)


@query
def ingest_orders_bulk(g: Given) -> DataFrame:
    rows = payloads.staged_bulk(payloads.parse(bulk_documents(g), payloads.BULK), io.shared_dir(g.spark, "bulk"))
    return shop.orders_from_bulk(rows, RUN).select(*ORDER_COLUMNS)


# ------------------------------------------------------------------ snapshots


@query
def ingest_product_snapshot(g: Given) -> DataFrame:
    k = F.col("p_partkey")
    cost = F.struct(
        F.struct(_s(F.floor("p_retailprice") + 0.5).alias("amount"), F.lit("USD").alias("currencyCode")).alias("unitCost"),
        F.concat(F.lit(shop.STOCK_ID), k).alias("id"),
    )
    free = F.struct(
        F.lit(None).cast("struct<amount: string, currencyCode: string>").alias("unitCost"),
        F.concat(F.lit(shop.STOCK_ID), k, F.lit("x")).alias("id"),
    )
    variant = lambda end, sku, inv: F.struct(
        F.struct(
            F.concat(F.lit(shop.VARIANT_ID), k, F.lit(end)).alias("id"),
            sku.alias("sku"),
            F.col("p_type").alias("title"),
            _s("p_retailprice").alias("price"),
            inv.alias("inventoryItem"),
        ).alias("node")
    )
    node = F.struct(
        F.concat(F.lit(shop.PRODUCT_ID), k).alias("id"),
        F.col("p_name").alias("title"),
        F.struct(F.array(variant("a", _s(k), cost), variant("b", F.lit(""), free)).alias("edges")).alias("variants"),
    )
    body = F.to_json(F.struct(F.struct(F.struct(F.array(F.struct(node.alias("node"))).alias("edges")).alias("products")).alias("data")))
    pages = payloads.parse(g.table("part").select(body.alias("body")), payloads.PRODUCTS)
    return _unstamped(shop.product_snapshot(pages, SHOP_DAY, RUN))


@query
def ingest_stock_snapshot(g: Given) -> DataFrame:
    item = F.concat(
        F.lit('{"id":'), "p_partkey", F.lit(',"code":"'), "p_brand", F.lit('","name":"'), "p_name",
        F.lit('","stock":{"quantity":'), "p_size", F.lit(',"available":"'), F.col("p_size") - 5, F.lit('"}}'),
    )
    wrapped = F.concat(F.lit('{"items":['), item, F.lit("]}"))
    bare = F.concat(F.lit(" ["), item, F.lit("]"))
    bodies = g.table("part").select(F.when(F.col("p_type") == "PROMO", bare).otherwise(wrapped).alias("body"))
    return _unstamped(shop.stock_snapshot(bodies, SHOP_DAY, RUN))


# ------------------------------------------------------------------ marketing


@query
def ingest_keywords(g: Given) -> DataFrame:
    metrics = F.struct(
        F.col("user_id").cast("double").alias("searchVolume"),
        F.when(F.col("event_type") != "view", F.col("user_id") % 9).cast("double").alias("seoDifficulty"),
        F.col("value").alias("cpc"),
    )
    item = lambda kw, m: F.struct(kw.alias("keyword"), m.alias("metrics"))
    items = F.array(
        item(F.concat(F.lit("kw "), "event_id"), metrics),
        item(F.lit(None).cast("string"), F.when(F.lit(False), metrics)),
    )
    pages = g.table("events").select(
        F.concat(F.lit("https://site"), F.col("user_id") % 7, F.lit(".example.net/shop/")).alias("target_url"),
        F.lit("sub_domain").alias("match_type"),
        F.to_json(F.struct(F.struct(items.alias("items")).alias("data"))).alias("body"),
    )
    return _unstamped(marketing.keyword_rows(payloads.parse(pages, payloads.KEYWORDS), SHOP_DAY, RUN))


@query
def ingest_email_campaigns(g: Given) -> DataFrame:
    """Two rounds of figures per campaign; the second one counts."""
    k = F.col("s_suppkey")
    when = F.concat(
        F.date_format(F.date_add(F.lit(dt.date(2001, 1, 1)), (k % 200).cast("int")), "yyyy-MM-dd"),
        F.lit("T"), F.lpad(_s(k % 24), 2, "0"), F.lit(":30:00+00:00"),
    )
    meta = F.struct(
        F.concat(F.lit("c"), k).alias("id"),
        F.struct(
            F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") > 0, when).alias("send_time"),
            F.when(F.col("s_nationkey") > 5, when).alias("scheduled_at"),
        ).alias("attributes"),
    )
    figures = lambda times: F.struct(
        (k * times).cast("double").alias("recipients"),
        F.when(k % 2 == 0, k * times).cast("double").alias("opens_unique"),
        (k * 3).cast("double").alias("opens"),
        (k % 4 / 4.0).alias("open_rate"),
        (k * times + 0.5).alias("conversion_value"),
    )
    result = lambda times: F.struct(
        F.struct(F.concat(F.lit("c"), k).alias("campaign_id")).alias("groupings"), figures(times).alias("statistics")
    )
    page = lambda times: F.to_json(
        F.struct(F.struct(F.struct(F.array(result(times), result(times + 1)).alias("results")).alias("attributes")).alias("data"))
    )
    suppliers = g.table("supplier")
    campaigns = payloads.parse(
        suppliers.select(F.to_json(F.struct(F.array(meta).alias("data"))).alias("body")), payloads.CAMPAIGNS
    )
    known = suppliers.filter(F.col("s_nationkey") < 20)
    stats = known.select(F.lit(2).alias("seq"), page(5).alias("body")).unionByName(
        known.select(F.lit(1).alias("seq"), page(7).alias("body"))
    )
    return _unstamped(marketing.email_campaigns(campaigns, payloads.parse(stats, payloads.CAMPAIGN_STATS), RUN))


@query
def ingest_email_profiles(g: Given) -> DataFrame:
    k = F.col("c_custkey")
    day = F.concat(F.date_format(F.date_add(F.lit(dt.date(2000, 1, 1)), (k % 500).cast("int")), "yyyy-MM-dd"), F.lit("T01:02:03Z"))
    profile = F.struct(
        _s(k).alias("id"),
        F.struct(
            F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.col("c_name"), F.lit("@example.com"))).alias("email"),
            F.lit("").alias("first_name"),
            F.col("c_name").alias("last_name"),
            day.alias("created"),
            F.when(F.col("c_nationkey") > 10, F.lit("2001-01-01T00:00:00Z")).alias("updated"),
            F.when(F.col("c_nationkey") > 20, F.lit("2001-02-01T00:00:00Z")).alias("updated_at"),
            F.when(F.col("c_nationkey") > 5, F.lit("2001-03-01T00:00:00Z")).alias("last_event_date"),
            F.struct(F.col("c_acctbal").alias("historic_clv")).alias("predictive_analytics"),
        ).alias("attributes"),
    )
    pages = g.table("customer").select(F.to_json(F.struct(F.array(profile).alias("data"))).alias("body"))
    return _unstamped(marketing.email_profiles(payloads.parse(pages, payloads.PROFILES), RUN))


@query
def ingest_social_posts(g: Given) -> DataFrame:
    k = F.col("p_partkey")
    post = F.struct(
        _s(k).alias("id"),
        F.concat(F.lit("https://social.example.com/"), k).alias("permalink"),
        F.col("p_type").alias("media_type"),
        F.lit("2001-07-30T10:00:00+0000").alias("timestamp"),
        F.col("p_size").cast("long").alias("like_count"),
    )
    metric = lambda name, value: F.struct(F.lit(name).alias("name"), F.array(F.struct(_s(value).alias("value"))).alias("values"))
    metrics = F.array(
        metric("impressions", k + 7),
        metric("reach", k % 50),
        metric("saved", F.when(F.col("p_size") > 10, F.col("p_size"))),
        metric("total_interactions", F.col("p_size")),
    )
    parts = g.table("part")
    media = payloads.parse(parts.select(F.to_json(F.struct(F.array(post).alias("data"))).alias("body")), payloads.MEDIA)
    insights = payloads.parse(
        parts.filter(F.col("p_type") != "LARGE").select(
            _s(k).alias("post_id"), F.to_json(F.struct(metrics.alias("data"))).alias("body")
        ),
        payloads.INSIGHTS,
    )
    return _unstamped(marketing.social_posts(media, insights, SHOP_DAY, RUN))


@query
def ingest_search_rows(g: Given) -> DataFrame:
    keys = F.array(F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lit(OWN_URL), F.lit("p/"), _s("user_id")), F.col("props"))
    full = F.struct(
        keys.alias("keys"),
        F.when(F.col("event_type") == "click", 1.0).alias("clicks"),
        F.col("user_id").cast("double").alias("impressions"),
        F.col("value").alias("position"),
    )
    short = F.struct(
        F.slice(keys, 1, 2).alias("keys"),
        F.lit(1.0).alias("clicks"),
        F.lit(1.0).alias("impressions"),
        F.lit(1.0).alias("position"),
    )
    pages = g.table("events").select(
        F.lit(OWN_URL).alias("site_url"), F.to_json(F.struct(F.array(full, short).alias("rows"))).alias("body")
    )
    return marketing.search_rows(payloads.parse(pages, payloads.SEARCH_ROWS))


@query
def ingest_ad_report(g: Given) -> DataFrame:
    rows = g.table("lineitem")
    report = rows.select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("Daily"),
        F.when(F.col("l_returnflag") == "A", "--").otherwise(_s("l_suppkey")).alias("Campaign ID"),
        F.concat(F.lit(" camp, "), "l_suppkey").alias("Campaign Name"),
        _s(F.col("l_quantity").cast("long")).alias("Impressions"),
        F.concat(F.lit("1,"), F.lpad(_s("l_linenumber"), 3, "0")).alias("Clicks"),
        _s(F.floor("l_extendedprice") + 0.5).alias("Cost"),
        F.when(F.col("l_discount") > 0.02, _s("l_discount")).otherwise("").alias("Conversions"),
        _s("l_extendedprice").alias("Conv. value"),
    )
    totals = report.withColumn("Daily", F.lit("Total"))
    return _unstamped(marketing.ad_report(report.unionByName(totals), "display", RUN))


@query
def ingest_ad_report_with_preamble(g: Given) -> DataFrame:
    file = lambda c: F.concat(F.lit("report-"), c)
    header = (
        '"TimePeriod","CampaignId","CampaignName","CampaignType","Impressions","Clicks","Spend","Conversions","Revenue"'
    )
    texts = {0: '"Report Name: x","a, b"', 1: "", 2: header, 10**12: '"Copyright, all rights reserved"'}
    numbered = F.create_map(*[F.lit(x).cast(t) for pos, line in texts.items() for x, t in ((pos, "long"), (line, "string"))])
    around = g.table("supplier").select(file("s_suppkey").alias("file"), F.explode(numbered).alias("pos", "line"))
    body = g.table("lineitem").select(
        file("l_suppkey").alias("file"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 3).alias("pos"),
        F.concat(
            F.lit('"'), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit('",'), "l_suppkey", F.lit(',"Name, '), "l_partkey",
            F.lit('",Search,"'), F.col("l_quantity").cast("long"), F.lit('",'), "l_linenumber", F.lit(","),
            F.floor("l_extendedprice") + 0.5, F.lit(","), "l_discount", F.lit(","),
        ).alias("line"),
    )
    return _unstamped(marketing.ad_report_with_preamble(around.unionByName(body), RUN))


@query
def google_ads_view(g: Given) -> DataFrame:
    stats = g.table("lineitem").select(
        F.col("l_shipdate").cast("date").alias("_DATA_DATE"),
        F.col("l_suppkey").alias("campaign_id"),
        (F.col("l_quantity") * 10).cast("long").alias("metrics_impressions"),
        F.col("l_quantity").cast("long").alias("metrics_clicks"),
        (F.floor("l_extendedprice") * 1000000 + 500000).cast("long").alias("metrics_cost_micros"),
        F.col("l_discount").alias("metrics_conversions"),
        F.col("l_extendedprice").alias("metrics_conversions_value"),
    )
    loads = g.table("supplier").select(
        F.explode(
            F.expr("sequence(date'1995-01-01', date'2001-12-01', make_interval(0, cast(1 + s_suppkey % 5 as int)))")
        ).alias("_DATA_DATE"),
        F.col("s_suppkey").alias("campaign_id"),
        "s_name",
    )
    campaigns = loads.select(
        "_DATA_DATE",
        "campaign_id",
        F.concat_ws(" ", "s_name", _s("_DATA_DATE")).alias("campaign_name"),
        F.lit("SEARCH").alias("campaign_advertising_channel_type"),
    )
    return _unstamped(marketing.google_ads_view(stats, campaigns, RUN))


@query
def meta_ads_view(g: Given) -> DataFrame:
    rows = g.table("lineitem")
    insights = rows.select(
        F.col("l_shipdate").cast("date").alias("DateStart"),
        _s("l_suppkey").alias("CampaignId"),
        F.concat(F.lit("camp "), "l_suppkey").alias("CampaignName"),
        _s("l_linenumber").alias("AdSetId"),
        _s("l_suppkey").alias("AdId"),
        F.when(F.col("l_linestatus") == "O", _s(F.col("l_quantity").cast("long"))).otherwise("n/a").alias("Impressions"),
        _s("l_linenumber").alias("Clicks"),
        F.concat(F.floor("l_extendedprice"), F.lit(".5")).alias("Spend"),
    )
    actions = rows.select(
        F.col("l_shipdate").cast("date").alias("DateStart"),
        _s("l_suppkey").alias("AdId"),
        F.when(F.col("l_linestatus") == "O", _s("l_linenumber")).otherwise("").alias("Action1dClick"),
    )
    return _unstamped(marketing.meta_ads_view(insights, actions, RUN))


@query
def search_console_view(g: Given) -> DataFrame:
    return _unstamped(marketing.search_console_view(g.url_impressions, RUN))


@query
def ingest_entities(g: Given) -> DataFrame:
    rows = g.table("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("company_name"),
        F.col("c_acctbal").alias("budget"),
        (F.col("c_acctbal") > 0).alias("contact_opened"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("extra"),
        F.array("c_nationkey", F.lit(7)).alias("areas"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), "c_nationkey").alias("since"),
    )
    return _unstamped(entities.flat_rows(rows, RUN))


def _drifting_documents(g: Given) -> DataFrame:
    """Customer documents whose fields come and go and change their types; one in eleven is cut off."""
    k = F.col("c_custkey")
    nation = F.col("c_nationkey")
    only = lambda n, x: F.when(k % 4 == n, x)
    numbers = F.to_json(
        F.struct(
            k.alias("id"), only(0, F.floor("c_acctbal")).alias("budget"), only(1, F.struct(nation.alias("nation"), F.lit("x").alias("note"))).alias("extra"),
            only(2, k % 8 == 2).alias("contact opened"), only(2, F.array(nation, F.lit(7))).alias("areas"),
            only(3, F.lit("2020-01-01")).alias("since"), only(3, F.concat(nation, F.lit(".25")).cast("decimal(10,2)")).alias("rate"),
        )
    )
    # the same fields with values of another type: a text for the number, a text for the list, a whole number for the rate
    texts = F.to_json(F.struct(k.alias("id"), F.lit("n/a").alias("budget"), F.lit("none").alias("areas"), nation.alias("rate")))
    whole = F.when(k % 8 == 5, texts).otherwise(numbers)
    texts_of = g.table("customer").select(k.alias("source_row"), whole.alias("b"))
    cut = F.when(F.col("source_row") % 11 == 0, F.expr("left(b, length(b) - 1)")).otherwise(F.col("b"))
    return texts_of.select("source_row", cut.alias("body"))


@query
def entities_of_any_shape(g: Given) -> DataFrame:
    """A table of documents nobody declared: the union of their fields, typed where all agree; the cut-off ones by name."""
    good, bad = entities.read_or_reject(_drifting_documents(g))
    wide = _unstamped(entities.wide_rows(good, entities.shape_of(good), RUN))
    return wide.unionByName(bad.select("source_row", F.col("body").alias("rejected")), allowMissingColumns=True)


@query
def entity_fields(g: Given) -> DataFrame:
    """Which field holds which kinds of values how often, of the same documents."""
    good, _ = entities.read_or_reject(_drifting_documents(g))
    return entities.long_rows(good).groupBy("field", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest")
    )


# ------------------------------------------------------------------ summaries kept with a table


@query
def price_quartiles_from_sketches(g: Given) -> DataFrame:
    """Quartiles of line prices per year from the sketches of its days; every estimate has to be within 2 % of its rank."""
    lines = g.orders.select("order_date", "unit_price", "sku")
    year = F.year("order_date").alias("year")
    names, at = ("low", "mid", "high"), (0.25, 0.5, 0.75)
    found = sketches.merged_quantiles(sketches.day_summaries(lines, "order_date", "unit_price", "sku"), [year], at, names)
    ranked = lines.withColumn("year", year).join(found, "year").groupBy("year", "n").agg(
        *[F.count_if(F.col("unit_price") < F.col(c)).alias(f"{c}_below") for c in names],
        *[F.count_if(F.col("unit_price") <= F.col(c)).alias(f"{c}_up_to") for c in names],
    )
    near = [(F.col(f"{c}_below") <= F.col("n") * (p + 0.02)) & (F.col(f"{c}_up_to") >= F.col("n") * (p - 0.02)) for c, p in zip(names, at, strict=True)]
    return ranked.select("year", "n", reduce(lambda a, b: a & b, near).alias("all_near"))


@query
def heavy_suppliers_from_sketches(g: Given) -> DataFrame:
    """Suppliers with more lines than the average one, from the counts of all suppliers kept per ship date."""
    lines = g.table("lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_quantity", F.col("l_suppkey").alias("supplier"))
    summaries = sketches.day_summaries(lines, "day", "l_quantity", "supplier")
    every = sketches.heavy_keys(summaries, "supplier")
    average = every.agg(F.avg("n")).scalar()
    return every.filter(F.col("n") > average)


# ------------------------------------------------------------------ increments and keyed state


def _order_heads(g: Given) -> DataFrame:
    return g.table("orders").select(
        F.col("o_orderkey").alias("order_id"), "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("created_at")
    )


@query
def increment_from_mark(g: Given) -> DataFrame:
    """Open orders at or after the newest finished one."""
    heads = _order_heads(g)
    done = heads.filter(F.col("o_orderstatus") == "F").filter(F.col("created_at") < "2001-01-01")
    return keyed.since_mark(heads, done, "created_at", "2020-01-01", inclusive=True)


@query
def increment_after_mark(g: Given) -> DataFrame:
    heads = _order_heads(g)
    done = heads.filter(F.col("o_orderstatus") == "F").filter(F.col("created_at") < "2001-01-01")
    return keyed.since_mark(heads, done, "created_at", "1970-01-01", inclusive=False)


@query
def backfill_chunk(g: Given) -> DataFrame:
    stamp = lambda s: F.lit(s).cast("timestamp")
    return keyed.between_stamps(_order_heads(g), "created_at", stamp("1997-01-01"), stamp("1998-01-01"))


@query
def latest_wins(g: Given) -> DataFrame:
    lines = g.orders.select("order_id", "line_item_id", "inserted_at", "sku", "quantity", "unit_price")
    return keyed.latest_wins(lines, ["order_id", "line_item_id"], "inserted_at")


@query
def keyed_upsert(g: Given) -> DataFrame:
    current = g.table("customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_mktsegment").alias("value"),
        F.lit(1).cast("long").alias("version"),
        F.lit("1990-01-01").cast("timestamp").alias("updated_at"),
    )
    changes = g.table("orders").select(
        (F.col("o_custkey") + 100).alias("key"),
        F.col("o_orderpriority").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )
    return keyed.upsert(current, changes, ["key"], ["value"], "version", "updated_at")


@query
def utm_from_url(g: Given) -> DataFrame:
    url = F.col("url")
    return g.table("pages").select(
        "page_id",
        *[utm.raw_param(url, f).alias(f"{f}_raw") for f in utm.FIELDS],
        *[utm.decoded_param(url, f).alias(f) for f in utm.FIELDS],
        url_host(url).alias("host"),
        url_path(url).alias("path"),
    )


# ------------------------------------------------------------------ files written and read back


@query
def documents_and_rejects(g: Given) -> DataFrame:
    """Order documents, some cut off and some with a text where a number belongs: fields of the good ones, the rest named."""
    bodies = _cut_documents(g).select("body")
    good, bad = payloads.parse_or_reject(bodies, "id bigint, price bigint")
    named = bad.select(F.regexp_extract("body", r'"id":(\d+)', 1).cast("long").alias("id"), F.lit(None).cast("long").alias("price"), F.lit(True).alias("rejected"))
    return good.select("id", "price", F.lit(False).alias("rejected")).unionByName(named)


@query
def ndjson_append_and_load(g: Given) -> DataFrame:
    """Two appended loads of newline-delimited rows, read back with the declared types."""
    out = io.shared_dir(g.spark, "ndjson")
    rows = g.deals.select(
        "id", F.concat(F.lit("D-"), "id").alias("deal_number"), "tenant_id", "property_id", "status",
        F.when(F.col("id") % 3 == 0, "high").alias("priority"), "proposed_rent", F.to_date("updated_at").alias("desired_move_in"),
        F.when(F.col("status") == "LOST", 'said "no", again').alias("lost_reason"), "assigned_user_id", "created_at", "updated_at",
        F.col("updated_at").alias("inserted_at"),
    )
    rows.write.mode("append").json(out)
    rows.filter(F.col("status") == "LOST").write.mode("append").json(out)
    return io.load_ndjson(g.spark, "re_deals", out)


@query
def csv_master_load(g: Given) -> DataFrame:
    out = io.shared_dir(g.spark, "sizes")
    g.size_map.select("sku", "size_category", "valid_from", "valid_to", F.lit("").alias("notes")).write.csv(out, header=True)
    return io.load_csv(g.spark, "ec_openlogi_sku_size_map", out)


@query
def day_partitions_restated(g: Given) -> DataFrame:
    """A history partitioned by day whose last week is delivered again with corrected clicks."""
    out = io.shared_dir(g.spark, "history")
    io.write_by_day(g.sc_history, out, "data_date", ["query"])
    corrected = io.last_days(g.sc_history, "data_date", SHOP_DAY, 7).withColumn("clicks", F.col("clicks") + 1)
    gone = F.col("data_date") == F.lit(SHOP_DAY - dt.timedelta(days=2))  # a day that is empty when delivered again
    io.restate_days(corrected.filter(~gone), out, "data_date", ["query"], (SHOP_DAY - dt.timedelta(days=6), SHOP_DAY))
    stored = g.spark.read.schema(io.SCHEMAS["sc_history"]).parquet(out)
    return stored.groupBy("data_date").agg(F.sum("clicks").alias("clicks"), F.count(F.lit(1)).alias("n"))


@query
def backfill_resumed(g: Given) -> DataFrame:
    """A history loaded again in chunks of 90 days with corrected clicks. The second chunk fails when it is first fetched; the
    run is started again and goes on from there. A day that is empty when fetched again loses its rows."""
    out = io.shared_dir(g.spark, "backfill")
    io.write_by_day(g.sc_history, f"{out}/history", "data_date", ["query"])
    gone = F.col("data_date") == F.lit(SHOP_DAY - dt.timedelta(days=100))
    failures = iter([False, True])

    def fetch(first: dt.date, last: dt.date) -> DataFrame:
        if next(failures, False):
            raise ConnectionError("cut off")
        days = g.sc_history.filter(F.col("data_date").between(F.lit(first), F.lit(last)) & ~gone)
        return days.withColumn("clicks", F.col("clicks") + 1)

    chunks = io.chunks_of(SHOP_DAY - dt.timedelta(days=250), SHOP_DAY, 90)
    loaded = []
    for _ in range(2):
        try:
            loaded.append(io.backfill(fetch, chunks, f"{out}/history", "data_date", f"{out}/log", g.spark, ["query"]))
        except ConnectionError:
            loaded.append(-io.chunks_done(g.spark, f"{out}/log").count())
    stored = g.spark.read.schema(io.SCHEMAS["sc_history"]).parquet(f"{out}/history")
    days = stored.groupBy("data_date").agg(F.sum("clicks").alias("clicks"), F.count(F.lit(1)).alias("n"))
    return days.withColumn("loaded", F.lit(",".join(map(str, loaded))))


@query
def profile_from_buckets(g: Given) -> DataFrame:
    """The customer profile over order lines stored in buckets of customers: nothing is shuffled."""
    out = io.shared_dir(g.spark, "buckets")
    name = f"lines_{uuid.uuid4().hex}"
    io.write_bucketed(g.orders, name, "customer_email", io.buckets_for(g.size), out)
    return reports.ec_customer_profile(g.spark.table(name), SHOP_DAY, generated_at=SHOP_NOW)


@query
def stream_append(g: Given) -> DataFrame:
    """Landed order documents streamed into rows; a second run finds nothing new."""
    base = io.shared_dir(g.spark, "stream")
    order_payloads(g).write.text(f"{base}/landed", compression="gzip")
    transform = lambda df: shop.orders_from_rest(df, RUN).select(*ORDER_COLUMNS)
    for _ in range(2):
        source = landing.landed(g.spark, f"{base}/landed", payloads.ORDER)
        landing.append_stream(source, transform, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return g.spark.read.parquet(f"{base}/rows")


@query
def stream_append_once(g: Given) -> DataFrame:
    """Order heads fetched in three increments, each from the newest stored one on, and landed as files: the orders of the
    mark's day arrive twice and are appended once."""
    base = io.shared_dir(g.spark, "once")
    heads = _order_heads(g)
    schema = struct("order_id I!, o_orderstatus S, created_at T")
    g.spark.createDataFrame([], schema).write.parquet(f"{base}/rows")
    for reached in ("1994-06-30", "1996-06-30", "2100-01-01"):
        stored = g.spark.read.schema(schema).parquet(f"{base}/rows")
        new = keyed.since_mark(heads.filter(F.col("created_at") <= F.lit(reached).cast("timestamp")), stored, "created_at", "1900-01-01", inclusive=True)
        new.write.mode("append").json(f"{base}/landed")
        source = landing.landed(g.spark, f"{base}/landed", schema)
        landing.append_once_stream(source, lambda df: df, ["order_id"], "2 days", f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return g.spark.read.schema(schema).parquet(f"{base}/rows")


def _cut_documents(g: Given) -> DataFrame:
    """Order documents of which one in seven is cut off and one in seven has a text where a number belongs."""
    key = F.col("o_orderkey")
    whole = F.to_json(F.struct(key.alias("id"), F.when(key % 7 == 1, "many").otherwise(F.floor("o_totalprice").cast("string")).alias("price")))
    unquoted = F.regexp_replace(whole, r'"price":"(\d+)"', r'"price":$1')
    texts = g.table("orders").select("o_orderkey", unquoted.alias("b"))
    return texts.select("o_orderkey", F.when(key % 7 == 0, F.expr("left(b, length(b) - 1)")).otherwise(F.col("b")).alias("body"))


@query
def stream_two_sides(g: Given) -> DataFrame:
    """Documents landed in two parts, good and bad ones mixed: rows of the good, the bad ones by name, and the log."""
    base = io.shared_dir(g.spark, "sides")
    schema = struct("id I, price I")
    for part in (F.col("o_orderkey") < 1000, F.col("o_orderkey") >= 1000):
        _cut_documents(g).filter(part).select("body").write.mode("append").text(f"{base}/landed")
        texts = landing.landed_texts(g.spark, f"{base}/landed")
        landing.two_sided_stream(texts, "id bigint, price bigint", lambda df: df.select("id", "price"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    v = F.col("_version").alias("v")
    side = lambda name, shape: landing.read_side(g.spark, f"{base}/out", name, shape)
    good = side("rows", schema).select(v, F.lit("row").alias("kind"), "id", "price")
    named = F.regexp_extract("body", r'"id":(\d+)', 1).cast("long").alias("id")
    bad = side("rejected", landing.TEXTS).select(v, F.lit("rejected").alias("kind"), named, F.lit(None).cast("long").alias("price"))
    log = side("log", landing.LOG).select(v, F.lit("log").alias("kind"), F.col("landed").alias("id"), F.col("accepted").alias("price"))
    return good.unionByName(bad).unionByName(log)


@query
def stream_latest_state(g: Given) -> DataFrame:
    """Price sightings landed in files, folded batch by batch into the newest price per SKU."""
    base = io.shared_dir(g.spark, "state")
    schema = struct("sku S!, inserted_at T!, cost_price I")
    g.products_daily.select(*schema.fieldNames()).repartition(3).write.json(f"{base}/landed")
    source = landing.landed(g.spark, f"{base}/landed", schema, files_per_batch=2)
    landing.latest_state_stream(
        source, lambda df: df, ["sku"], "inserted_at", schema, f"{base}/state", f"{base}/checkpoint"
    ).awaitTermination()
    return landing.read_state(g.spark, f"{base}/state", schema, ["sku"])


@query
def stream_state_compacted(g: Given) -> DataFrame:
    """The same state when it is compacted between two runs; the second brings the sightings of the last year only."""
    base = io.shared_dir(g.spark, "compacted")
    schema = struct("sku S!, inserted_at T!, cost_price I")
    rows = g.products_daily.select(*schema.fieldNames())
    late = F.col("inserted_at") >= F.lit("1998-01-01").cast("timestamp")
    for part in (~late, late):
        rows.filter(part).write.mode("append").json(f"{base}/landed")
        source = landing.landed(g.spark, f"{base}/landed", schema)
        landing.latest_state_stream(
            source, lambda df: df, ["sku"], "inserted_at", schema, f"{base}/state", f"{base}/checkpoint"
        ).awaitTermination()
        landing.compact_state(g.spark, f"{base}/state", schema, ["sku"])
    return landing.read_state(g.spark, f"{base}/state", schema, ["sku"])


@query
def declared_scan_rebuilt(g: Given) -> DataFrame:
    """A table written as a part of itself, replaced as a whole, and scanned by its declaration (ctr was never written)."""
    out = io.shared_dir(g.spark, "rebuilt")
    io.rebuild(g.sc_history.filter("clicks > 0"), out)
    io.rebuild(g.sc_history, out)
    return io.scan(g.spark, "sc_history", out)


@query
def report_rebuilt_as_table(g: Given) -> DataFrame:
    name = f"weekly_{uuid.uuid4().hex}"
    io.rebuild_table(reports.ec_weekly_summary(g.orders.filter("is_refunded")), name)
    io.rebuild_table(reports.ec_weekly_summary(g.orders), name)
    return g.spark.table(name)


@query
def table_created_if_missing(g: Given) -> DataFrame:
    """A declared table is created once; asking again leaves it alone."""
    name = f"ec_cost_master_{uuid.uuid4().hex}"
    first = io.create_if_missing(g.spark, "ec_cost_master", name)
    masters = reports.ec_cost_master(g.products_daily, epoch=EPOCH)
    masters.select(*io.SCHEMAS["ec_cost_master"].fieldNames()).write.insertInto(name)
    again = io.create_if_missing(g.spark, "ec_cost_master", name)
    return g.spark.table(name).withColumn("created", F.lit(first)).withColumn("created_again", F.lit(again))


@query
def append_with_stamp(g: Given) -> DataFrame:
    """Two loads of a table; every row carries the stamp of its run."""
    out = io.shared_dir(g.spark, "appended")
    rows = g.deals.select("id", "status", "proposed_rent")
    io.append(rows.filter(F.col("status") == "LOST"), out, RUN - dt.timedelta(days=1))
    io.append(rows, out, RUN)
    return g.spark.read.parquet(out)


@query
def view_recomputed(g: Given) -> DataFrame:
    """A view over a table that grows after the view was made: the sightings of half the SKUs, then those of the others."""
    out = io.shared_dir(g.spark, "sightings")
    early = F.crc32("sku") % 2 == 0
    g.products_daily.filter(early).write.parquet(out)
    stored = g.spark.read.schema(g.products_daily.schema).parquet(out)
    io.as_view(reports.ec_cost_master(stored, epoch=EPOCH), "martloom_cost_master")
    before = g.spark.sql("SELECT count(DISTINCT sku) AS n FROM martloom_cost_master").first()["n"]
    g.products_daily.filter(~early).write.mode("append").parquet(out)
    io.refresh_view(g.spark, "martloom_cost_master")
    now = g.spark.sql("SELECT sku, count(*) AS periods, max(cost_price) AS highest FROM martloom_cost_master GROUP BY sku")
    return now.withColumn("grew", F.lit(before) < F.count(F.lit(1)).over(Window.partitionBy()))


@query
def high_water_mark_text(g: Given) -> DataFrame:
    """The mark of each status as text for a fetcher; a status that was never stored starts at the default."""
    heads = _order_heads(g)
    marks = [
        keyed.high_water_mark(heads.filter(F.col("o_orderstatus") == status), "created_at", "2020-01-01").withColumn("status", F.lit(status))
        for status in ("F", "O", "P", "never")
    ]
    return reduce(DataFrame.unionByName, marks)


def _attempts(g: Given) -> tuple[DataFrame, DataFrame]:
    current = g.table("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"), F.lit(1).cast("long").alias("version"),
        F.lit("1990-01-01").cast("timestamp").alias("updated_at"), F.lit("old error").alias("error"),
    )
    failed = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("refused "), "o_orderpriority"))
    attempts = g.table("orders").select(
        (F.col("o_custkey") + 100).alias("key"), F.col("o_orderpriority").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"), failed.alias("error"),
    )
    return current, attempts


@query
def keyed_upsert_state(g: Given) -> DataFrame:
    return keyed.upsert_with_history(*_attempts(g), ["key"], ["value"], "version", "updated_at", "error")[0]


@query
def keyed_upsert_history(g: Given) -> DataFrame:
    return keyed.upsert_with_history(*_attempts(g), ["key"], ["value"], "version", "updated_at", "error")[1]


# ------------------------------------------------------------------ order of rows


def in_order(df: DataFrame, name: str) -> DataFrame:
    """The rows with the place they have in a sorted result, from the place in their file and the rows before it."""
    spark = df.sparkSession
    out = io.shared_dir(spark, name)
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(out)
    rows = spark.read.parquet(out).withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of the sort
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_at") - F.shiftleft("_part", 33) + 1
    return rows.join(before, "_part").select(*df.columns, position.alias("position"))


@query
def ordered_repeat_pattern(g: Given) -> DataFrame:
    return in_order(reports.ec_repeat_pattern(g.orders, sort=True), "repeat")


@query
def ordered_storage_cost(g: Given) -> DataFrame:
    """Newest day first, dearest first, unknown cost last."""
    return in_order(reports.ec_storage_cost_estimated(g.inventory, g.size_map, g.storage_rate, sort=True), "storage")


@query
def ordered_case_pipeline(g: Given) -> DataFrame:
    """Stages in the order of the pipeline."""
    return in_order(leasing.re_case_pipeline(g.deals, SHOP_DAY, sort=True), "cases")


@query
def ordered_weekly_summaries(g: Given) -> DataFrame:
    """Shop weeks, newest first."""
    return in_order(reports.ec_weekly_summary(g.orders, sort=True), "weeks")


@query
def ordered_competitor_gap(g: Given) -> DataFrame:
    """Most searched first, then the keyword that most competitors hold."""
    return in_order(search.ec_competitor_gap(g.keywords, g.orders, SHOP_DAY, OWN_URL, sort=True), "gap")


@query
def ordered_lead_funnel(g: Given) -> DataFrame:
    return in_order(leasing_queries.re_lead_funnel(g).drop("generated_at"), "funnel")


@query
def ordered_property_performance(g: Given) -> DataFrame:
    """Most deals first, longest listed first."""
    return in_order(leasing.re_property_performance(g.properties, g.deals, g.activities, SHOP_DAY, sort=True), "properties")


@query
def ordered_leasing_weeks(g: Given) -> DataFrame:
    return in_order(leasing.re_weekly_summary(leasing_queries.re_lead_funnel(g), sort=True), "leasing_weeks")


# ------------------------------------------------------------------ from raw tables to reports


def _ads_loaded_twice(g: Given) -> list[DataFrame]:
    """Each advertising source as two loads of a rolling window leave it; the earlier load had other figures."""
    out = []
    for table, rows in zip(("ec_google_ads", "ec_meta_ads", "ec_yahoo_ads", "ec_microsoft_ads"), g.ad_sources):
        third = io.KEYS[table][2]
        sums = rows.groupBy("date", "campaign_id").agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost", "conversions")])
        newest = sums.select("*", F.lit("all").alias(third), F.date_add("date", 2).cast("timestamp").alias("inserted_at"))
        earlier = newest.withColumn("cost", F.col("cost") + 7).withColumn("inserted_at", F.date_add("date", 1).cast("timestamp"))
        out.append(io.newest_rows(earlier.unionByName(newest), table))
    return out


def _lines_loaded_twice(g: Given, columns: list[str] | None = None) -> DataFrame:
    """Order lines as two loads leave them; the earlier one had other prices. Both are made in one pass over the lines."""
    lines = g.orders.withColumn("line_item_id", F.concat_ws("-", "line_item_id", "sku", "inserted_at", "quantity", "unit_price"))
    loaded = lines.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("earlier"))
    loaded = loaded.withColumn("total_price", F.when(F.col("earlier"), F.col("total_price") + 1).otherwise(F.col("total_price")))
    before = F.when(F.col("earlier"), F.col("inserted_at") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("inserted_at"))
    return io.newest_rows(loaded.withColumn("inserted_at", before).drop("earlier"), "ec_shopify_orders", columns)


@query
def ec_channel_roi_from_raw(g: Given) -> DataFrame:
    """Every day of the ad sources and every order line was loaded twice."""
    return reports.ec_channel_roi(_lines_loaded_twice(g), *_ads_loaded_twice(g))


@query
def ec_ad_performance_from_raw(g: Given) -> DataFrame:
    ads = _ads_loaded_twice(g)
    return central.ec_ad_performance(*ads, reports.ec_channel_roi(_lines_loaded_twice(g), *ads))


@query
def ec_cohort_ltv_from_raw(g: Given) -> DataFrame:
    lines = _lines_loaded_twice(g, ["customer_email", "order_date", "order_id", "total_price"])
    return reports.ec_cohort_ltv(lines, generated_at=SHOP_NOW)


@query
def ec_customer_profile_from_raw(g: Given) -> DataFrame:
    return reports.ec_customer_profile(_lines_loaded_twice(g), SHOP_DAY, generated_at=SHOP_NOW)


@query
def ad_cost_feed_from_raw(g: Given) -> DataFrame:
    return reports.ad_cost_feed(*_ads_loaded_twice(g))


@query
def orders_required_and_rejects(g: Given) -> DataFrame:
    """Lines without a landing page or a referrer can't be loaded where both are required."""
    declared = struct("order_id S!, line_item_id S!, landing_site S!, referring_site S!, utm_source S")
    good, bad = io.required_or_reject(g.orders, declared)
    columns = ["order_id", "line_item_id", "sku", "quantity"]
    return good.select(*columns, F.lit(None).cast("string").alias("missing")).unionByName(bad.select(*columns, "missing"))
