import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.plans import shop
from martloom.sources.schemas import struct
from tests.conftest import D, T, rows

NOW = T("2024-07-01T00:00:00")


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def order(i, email="a@x", day="2024-01-01", price=1000, line="1", **more):
    return {"order_id": str(i), "customer_email": email, "order_date": D(day), "total_price": price, "line_item_id": f"{i}-{line}", **more}


def test_daily_pnl(make):
    orders = make(
        "ec_shopify_orders",
        order(1, sku="a", quantity=2, day="2024-01-31"),
        order(2, sku="a", quantity=2, day="2024-02-01"),
        order(3, sku="none"),
        order(4, sku="a", price=0),
        order(5, sku="a", day="2023-12-31"),  # no rule
        order(6, sku="a", day="2024-03-01"),  # two rules
    )
    costs = make(
        "ec_cost_master",
        {"sku": "a", "cost_price": 100, "valid_from": D("2020-01-01"), "valid_to": D("2024-01-31")},
        {"sku": "a", "cost_price": 200, "valid_from": D("2024-02-01"), "valid_to": D("2099-12-31")},
    )
    rules = make(
        "ec_shipping_rules",
        {"valid_from": D("2024-01-01"), "valid_to": D("2024-12-31"), "shipping_fee_per_order": 300},
        {"valid_from": D("2024-03-01"), "valid_to": D("2024-03-01"), "shipping_fee_per_order": 400},
    )
    got = rows(
        shop.ec_daily_pnl(orders, costs, rules),
        "order_id", "cost_price", "total_cost", "gross_profit", "actual_gross_profit", "actual_margin_pct",
    )
    assert got == [
        ("1", 100, 200, 800, 500, 50.0),
        ("2", 200, 400, 600, 300, 30.0),
        ("3", None, None, None, None, None),
        ("4", 100, 100, -100, -400, None),
        ("6", 200, 200, 800, 400, 40.0),
        ("6", 200, 200, 800, 500, 50.0),
    ]


def ads(make, *days_costs):
    return make("ec_google_ads", *[{"date": D(d), "cost": c} for d, c in days_costs])


def test_channel_roi(make):
    orders = make(
        "ec_shopify_orders",
        order(1, utm_source="google", utm_medium="cpc", is_refunded=True),
        order(1, utm_source="google", utm_medium="cpc", line="2"),
        order(2, "b@x", day="2024-01-02"),
    )
    none = make("ec_google_ads", {"date": D("2024-01-05"), "cost": 0})
    roi = shop.ec_channel_roi(orders, ads(make, ("2024-01-01", 300), ("2024-01-01", 200), ("2024-01-03", 70)), none, none, none)
    got = by(roi, "date", "channel")
    paid = got[(D("2024-01-01"), "google_paid")]
    assert (paid.orders, paid.unique_customers, paid.revenue, paid.ad_cost) == (1, 1, 2000, 500)
    assert (paid.roas, paid.cpa, paid.refund_count, paid.refund_rate_pct, paid.ltv) == (4.0, 500.0, 1, 50.0, 2000.0)
    only_cost = got[(D("2024-01-03"), "google_paid")]
    assert (only_cost.orders, only_cost.revenue, only_cost.ad_cost, only_cost.roas, only_cost.cpa) == (None, None, 70, None, None)
    zero = got[(D("2024-01-05"), "meta_paid")]
    assert (zero.ad_cost, zero.roas) == (0, None)
    only_orders = got[(D("2024-01-02"), "direct")]
    assert (only_orders.orders, only_orders.ad_cost, only_orders.cpa) == (1, None, None)
    assert sum(r.revenue or 0 for r in got.values()) == 3000
    per_order = by(shop.ec_channel_roi(orders, *[none] * 4, revenue_basis="order"), "date", "channel")
    assert per_order[(D("2024-01-01"), "google_paid")].revenue == 1000


def test_weekly_summary_and_bases(make):
    orders = make("ec_shopify_orders", order(1), order(1, line="2"), order(2, "b@x", "2024-01-08", 500, is_refunded=True))
    got = rows(shop.ec_weekly_summary(orders))
    assert got == [(D("2024-01-01"), 2000, 1, 1, 1000.0, 0, 0.0), (D("2024-01-08"), 500, 1, 1, 500.0, 1, 100.0)]
    assert rows(shop.ec_weekly_summary(orders, "order"))[0][:2] == (D("2024-01-01"), 1000)
    with pytest.raises(ValueError):
        shop.ec_weekly_summary(orders, "lines")


def test_cohort_ltv(make):
    orders = make(
        "ec_shopify_orders",
        order(1, "a@x", "2024-01-05", 100),
        order(2, "a@x", "2024-03-01", 50),
        order(3, "b@x", "2024-01-31", 300),
        order(4, "c@x", "2024-02-01", 10),
        order(4, "c@x", "2024-02-01", 10, line="2"),
        order(5, None, "2024-02-01", 999),
    )
    got = rows(shop.ec_cohort_ltv(orders))
    assert got == [
        (D("2024-01-01"), 0, 2, 2, 100.0, 2, 400, 2, 400, 200.0),
        (D("2024-01-01"), 2, 2, 1, 50.0, 1, 50, 3, 450, 225.0),
        (D("2024-02-01"), 0, 1, 1, 100.0, 1, 20, 1, 20, 20.0),
    ]


def test_repeat_pattern(make):
    days = [D("2024-01-01") + dt.timedelta(days=20 * i) for i in range(12)]
    orders = make(
        "ec_shopify_orders",
        *[order(i, "many@x", str(d)) for i, d in enumerate(days)],
        order(90, "same@x", "2024-01-01"), order(91, "same@x", "2024-01-01"),
        order(92, "two@x", "2024-01-01"), order(93, "two@x", "2024-04-10"),
    )
    got = by(shop.ec_repeat_pattern(orders), "order_index")
    assert sorted(got) == list(range(1, 11))
    first = got[1]
    assert (first.customer_count, first.avg_days_to_next, first.p25_days, first.median_days, first.p75_days) == (2, 60.0, 20, 20, 100)
    assert (first.pct_within_30d, first.pct_within_90d, first.pct_within_180d) == (50.0, 50.0, 100.0)


def test_customer_profile(make):
    orders = make(
        "ec_shopify_orders",
        order(1, utm_source="google", utm_medium="cpc", sku="x", customer_id="7", tags="ギフト設定,vip"),
        order(1, utm_source="google", utm_medium="cpc", sku="y", line="2", customer_id="7"),
        order(2, day="2024-03-01", price=400, sku="y"),
        order(3, "b@x", "2024-06-30", 10, sku="a"),
    )
    got = by(shop.ec_customer_profile(orders, D("2024-08-28"), NOW), "customer_email")
    a = got["a@x"]
    assert (a.total_orders, a.total_revenue, a.avg_order_value, a.days_since_last_order) == (2, 2400, 800.0, 180)
    assert (a.is_dormant, a.is_repeater, a.first_channel, a.last_channel) == (True, True, "google_paid", "direct")
    assert (a.favorite_sku, a.gift_purchase_count, a.customer_id, a.cohort_month) == ("y", 1, "7", D("2024-01-01"))
    assert a.generated_at == NOW
    b = got["b@x"]
    assert (b.is_dormant, b.is_repeater) == (False, False)
    assert by(shop.ec_customer_profile(orders, D("2024-08-28"), revenue_basis="order"), "customer_email")["a@x"].total_revenue == 1400


def test_attribution(make):
    paid = {"utm_source": "google", "utm_medium": "cpc"}
    orders = make(
        "ec_shopify_orders",
        order(1, "one@x", **paid, utm_campaign="c1"),
        order(2, "loyal@x", **paid), order(3, "loyal@x", "2024-02-01", **paid, utm_campaign="late"), order(4, "loyal@x", "2024-03-01", **paid),
        order(5, "cross@x", **paid), order(6, "cross@x", "2024-02-01", landing_site="/?utm_campaign=p%20q"),
    )
    got = by(shop.ec_attribution_first_last(orders), "customer_email")
    assert (got["one@x"].journey_type, got["one@x"].first_utm_campaign) == ("one_time", "c1")
    assert (got["loyal@x"].journey_type, got["loyal@x"].first_utm_campaign, got["loyal@x"].last_utm_campaign) == ("loyal_same_channel", "late", "late")
    assert (got["cross@x"].journey_type, got["cross@x"].last_channel, got["cross@x"].last_utm_campaign) == ("cross_channel", "direct", "p%20q")


def test_klaviyo_conversion(make):
    campaign = lambda i, sent, **m: {"campaign_id": i, "campaign_name": i, "sent_at": sent, "recipients": 10, "revenue": 5, **m}
    campaigns = make(
        "ec_klaviyo_campaigns",
        campaign("c1", T("2024-01-01T23:00:00")), campaign("c2", T("2024-01-05T00:00:00")), campaign("never", None),
        campaign("twice", T("2024-01-01T00:00:00")), campaign("twice", T("2024-01-01T00:00:00")),
    )
    profiles = make("ec_klaviyo_profiles", {"email": "a@x"}, {"email": "a@x"})
    orders = make(
        "ec_shopify_orders",
        order(1, day="2024-01-01"), order(2, day="2024-01-08", price=10), order(3, day="2024-01-09", price=7),
        order(4, "stranger@x", "2024-01-02"),
        order(5, day="2024-01-03", price=1), order(5, day="2024-01-06", price=2, line="2"),  # one id on two days
    )
    got = by(shop.ec_klaviyo_conversion(campaigns, profiles, orders), "campaign_id")
    assert (got["c1"].shopify_orders, got["c1"].shopify_revenue, got["c1"].purchase_rate_pct) == (3, 1013, 30.0)
    assert (got["c2"].shopify_orders, got["c2"].shopify_revenue) == (3, 19)
    assert (got["never"].shopify_orders, got["never"].shopify_revenue, got["never"].purchase_rate_pct) == (0, None, 0.0)
    assert (got["twice"].shopify_orders, got["twice"].shopify_revenue) == (3, 2026)


def test_sku_trend(make):
    months = [D("2023-01-01"), *[dt.date(2023 + (m // 12), m % 12 + 1, 5) for m in range(1, 14)]]
    prices = [100, 100, 100, 120, 80, 120, 96, 100, 100, 100, 100, 100, 250, 100]
    lines = [order(i, day=str(d), price=p, sku="s", sku_title="S") for i, (d, p) in enumerate(zip(months, prices))]
    orders = make("ec_shopify_orders", *lines, order(99, sku="", price=5))
    costs = make("ec_cost_master", {"sku": "s", "cost_price": 30, "valid_from": D("2023-02-01"), "valid_to": D("2099-12-31")})
    got = by(shop.ec_sku_trend(orders, costs), "sku", "year_month")
    assert {k[0] for k in got} == {"s"}
    m = [got[("s", d.replace(day=1))] for d in months]
    assert (m[0].trend_class, m[0].gross_profit, m[0].mom_growth_pct) == ("unknown", None, None)
    assert (m[1].gross_profit, m[1].mom_growth_pct) == (70, 0.0)
    assert m[3].trend_class == "rising"  # exactly 1.20 times the average of the three before
    assert m[4].trend_class == "declining"
    assert m[12].yoy_growth_pct == 150.0 and m[11].yoy_growth_pct is None


def test_inventory_health(make):
    stock = lambda sku, available, day="2024-06-30": {"snapshot_date": D(day), "sku": sku, "item_id": sku, "available": available}
    inventory = make(
        "ec_openlogi_inventory_daily",
        stock("out", 0), stock("unknown", None), stock("dead", 5), stock("risk7", 6), stock("risk14", 7), stock("fine", 14),
        stock("over", 90), stock("slow", 3), stock("old", 1, "2024-06-29"), stock(None, 4),
    )
    sold = lambda sku, q, day: order(sku + day, day=day, sku=sku, quantity=q)
    recent = [sold(s, 7, "2024-06-23") for s in ("out", "risk7", "risk14", "fine", "over")]
    orders = make("ec_shopify_orders", *recent, sold("slow", 2, "2024-06-22"), sold("slow", 2, "2024-04-01"), sold("dead", 9, "2024-03-31"))
    got = by(shop.ec_inventory_health(inventory, orders, D("2024-06-30")), "sku")
    assert {s: r.status for s, r in got.items()} == {
        "out": "stockout", "unknown": "stockout", "dead": "no_recent_sales", "risk7": "at_risk_7d", "risk14": "at_risk_14d",
        "fine": "healthy", "over": "overstock", "slow": "healthy",
    }
    assert (got["slow"].sold_7d, got["slow"].sold_30d, got["slow"].sold_90d, got["slow"].days_of_stock) == (0, 2, 4, None)
    assert (got["dead"].turnover_30d_pct, got["fine"].days_of_stock, got["fine"].turnover_30d_pct) == (None, 14.0, 50.0)
    listed = [r.sku for r in shop.ec_inventory_health(inventory, orders, D("2024-06-30"), sort=True).collect()]
    assert listed[:4] == ["out", "unknown", "risk7", "risk14"]


def test_storage_cost(make):
    inventory = make(
        "ec_openlogi_inventory_daily",
        *[{"snapshot_date": D(d), "sku": s, "item_id": "i", "quantity": 3} for d, s in (("2024-01-01", "a"), ("2024-02-01", "a"), ("2024-01-01", "b"), ("2024-01-01", None))],
    )
    sizes = make("ec_openlogi_sku_size_map", {"sku": "a", "size_category": "80", "valid_from": D("2024-01-01"), "valid_to": D("9999-12-31")})
    rates = make(
        "ec_openlogi_storage_rate",
        {"size_category": "80", "daily_rate_yen": 2.5, "monthly_rate_yen": 75, "valid_from": D("2020-01-01"), "valid_to": D("2024-01-31")},
    )
    got = rows(shop.ec_storage_cost_estimated(inventory, sizes, rates), "sku", "snapshot_date", "size_category", "estimated_daily_cost_yen", "estimated_monthly_cost_yen")
    assert got == [("a", D("2024-01-01"), "80", 7.5, 225.0), ("a", D("2024-02-01"), "80", None, None), ("b", D("2024-01-01"), None, None, None)]


def test_cost_master_settles_two_rows_of_a_day(make):
    seen = lambda day, cost, at, sku="s": {"fetched_date": D(day), "sku": sku, "cost_price": cost, "inserted_at": T(at)}
    snapshots = make(
        "ec_shopify_products_daily",
        seen("2024-01-01", 1, "2024-01-01"), seen("2024-01-02", 9, "2024-01-02T01:00:00"), seen("2024-01-02", 2, "2024-01-02T02:00:00"),
        seen("2024-01-03", None, "2024-01-03"), seen("2024-01-04", 1, "2024-01-04"), seen("2024-01-04", 1, "2024-01-04", ""),
    )
    assert rows(shop.ec_cost_master(snapshots)) == [
        ("s", 1, D("2020-01-01"), D("2024-01-01")),
        ("s", 1, D("2024-01-04"), D("2099-12-31")),
        ("s", 2, D("2024-01-02"), D("2024-01-03")),
    ]


def test_empty_inputs(make, spark):
    orders = make("ec_shopify_orders", order(1)).limit(0)
    costs = make("ec_cost_master", {"sku": "a"}).limit(0)
    for df in (
        shop.ec_cohort_ltv(orders), shop.ec_repeat_pattern(orders), shop.ec_customer_profile(orders, D("2024-01-01")),
        shop.ec_attribution_first_last(orders), shop.ec_sku_trend(orders, costs), shop.ec_weekly_summary(orders),
    ):
        assert df.count() == 0


def test_cohort_totals_agree_with_the_orders(spark):
    from martloom.sources.given import Given

    orders = Given(spark, "/root/testdata/sf0.001").orders
    cohorts = shop.ec_cohort_ltv(orders).collect()
    assert sum(r.month_revenue for r in cohorts) == orders.agg(F.sum("total_price")).first()[0]
    last = {}
    for r in sorted(cohorts, key=lambda r: r.months_since_first):
        last[r.cohort_month] = r.cumulative_revenue
    assert sum(last.values()) == orders.agg(F.sum("total_price")).first()[0]
    assert struct("a I!").fields[0].nullable is False


def test_email_orders_against_all_pairs(spark, make):
    """Orders delivered again on other days, windows that overlap, campaigns loaded twice."""
    rnd = random.Random(9)
    day = lambda n: D("2024-01-01") + dt.timedelta(days=n)
    lines = [{"order_id": str(rnd.randint(1, 25)), "order_date": day(rnd.randint(0, 30)), "customer_email": rnd.choice(["a@x", "b@x", "new@x"]), "total_price": rnd.randint(1, 9)} for _ in range(150)]
    sent = [(f"c{i}", dt.datetime(2024, 1, rnd.randint(1, 28), 10)) for i in range(12)] + [("late", dt.datetime(2025, 1, 1)), ("unsent", None)]
    campaigns = [{"campaign_id": c, "sent_at": at, "recipients": 100, "revenue": 5} for c, at in [*sent, sent[0]]]
    got = shop.ec_klaviyo_conversion(make("ec_klaviyo_campaigns", *campaigns), make("ec_klaviyo_profiles", {"email": "a@x"}, {"email": "b@x"}), make("ec_shopify_orders", *lines))
    want = []
    for c, at in sent:
        inside = [x for x in lines if at and x["customer_email"] != "new@x" and 0 <= (x["order_date"] - at.date()).days <= 7]
        copies = 2 if c == sent[0][0] else 1
        want.append((c, len({x["order_id"] for x in inside}), sum(x["total_price"] for x in inside) * copies if inside else None))
    assert rows(got, "campaign_id", "shopify_orders", "shopify_revenue") == sorted(want, key=str)
