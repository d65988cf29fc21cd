"""One customer, SKU, order, page and file hold half of all rows: the results are those of the plain joins."""

import pytest
from pyspark.sql import functions as F

from martloom.ingest import marketing, payloads, shop as shop_ingest
from martloom.operators import skew
from martloom.plans import search, shop
from tests.conftest import T, rows

RUN = T("2024-07-01T00:00:00")
REAL = skew.hot_keys


@pytest.fixture(scope="module")
def lopsided(spark):
    i = F.col("id")
    half = i % 2 == 0
    lines = spark.range(600).select(
        F.concat(F.lit("o"), i).alias("order_id"),
        F.concat(F.lit("l"), i).alias("line_item_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 150).cast("int")).alias("order_date"),
        F.when(half, "big@x").when(i % 3 == 0, F.lit(None)).otherwise(F.concat(i % 20, F.lit("@x"))).alias("customer_email"),
        F.when(half, "big").otherwise((i % 30).cast("string")).alias("sku"),
        (i % 7).alias("quantity"),
        (i * 10).alias("total_price"),
        i.alias("unit_price"),
        F.lit(False).alias("is_refunded"),
        F.lit(None).cast("long").alias("refund_amount"),
        F.when(half, "/p/a").otherwise(F.concat(F.lit("/p/"), i % 9)).alias("landing_site"),
    )
    history = lines.select(
        F.col("order_date").alias("data_date"),
        F.concat(F.lit("https://s.example"), "landing_site").alias("url"),
        F.concat(F.lit("q"), "order_id").alias("query"),
        F.lit(3).cast("long").alias("clicks"),
        F.lit(10).cast("long").alias("impressions"),
        F.lit(2.0).alias("position"),
    )
    costs = lines.select("sku").distinct().select(
        "sku",
        F.lit(5).cast("long").alias("cost_price"),
        F.lit("2024-01-10").cast("date").alias("valid_from"),
        F.lit("2099-12-31").cast("date").alias("valid_to"),
    )
    rules = spark.sql("SELECT date'2020-01-01' AS valid_from, date'2099-12-31' AS valid_to, 100L AS shipping_fee_per_order")
    gid = lambda kind, k: F.concat(F.lit(f"gid://shop/{kind}/"), k)
    no_seq = F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.col("n").alias("row"))
    docs = spark.range(40).select(i.alias("n"), F.to_json(F.struct(gid("Order", i).alias("id"), F.lit("a@x").alias("email"))).alias("body")).unionByName(
        spark.range(400).select(
            (i + 100).alias("n"),
            F.to_json(F.struct(gid("LineItem", i).alias("id"), gid("Order", F.when(half, 0).otherwise(i % 40)).alias("__parentId"), i.alias("quantity"))).alias("body"),
        )
    )
    bulk = payloads.parse(docs.select(no_seq.alias("seq"), "body"), payloads.BULK)
    head = spark.range(5).select(F.concat(F.lit("f"), i).alias("file"), F.lit(0).cast("long").alias("pos"), F.lit("TimePeriod,CampaignId,Clicks").alias("line"))
    report = head.unionByName(
        spark.range(300).select(F.concat(F.lit("f"), F.when(half, 0).otherwise(i % 5)).alias("file"), (i + 1).alias("pos"), F.concat(F.lit("2024-01-01,"), i, F.lit(",1")).alias("line"))
    )
    return {
        "pnl": lambda: shop.ec_daily_pnl(lines, costs, rules),
        "cohorts": lambda: shop.ec_cohort_ltv(lines),
        "pages": lambda: search.ec_search_to_purchase(history, lines),
        "bulk": lambda: shop_ingest.orders_from_bulk(bulk, RUN),
        "report": lambda: marketing.ad_report_with_preamble(report, RUN),
    }


@pytest.mark.parametrize("job", ["pnl", "cohorts", "pages", "bulk", "report"])
def test_hot_keys_do_not_change_results(spark, lopsided, monkeypatch, job):
    seen = []

    def every_row(facts, keys, *_):
        hot = REAL(facts, keys, facts.columns, 1.0, 32)
        seen.append(hot.count())
        return hot

    monkeypatch.setattr(skew, "hot_keys", lambda f, k, *_: REAL(f, k, f.columns, 1.0, 32).limit(0))
    plain = rows(lopsided[job]())
    monkeypatch.setattr(skew, "hot_keys", every_row)
    assert rows(lopsided[job]()) == plain and len(plain) > 0
    assert seen and seen[0] >= 1
