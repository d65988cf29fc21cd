from martloom.plans import central, leasing, quality
from martloom.plans.shop import ec_weekly_summary
from martloom.sources.schemas import SCHEMAS
from tests.conftest import D, T, rows
from tests.test_shop import by, order

AS_OF = D("2024-06-30")


def deal(i, status, created="2024-06-01T00:00:00", updated="2024-06-11T00:00:00", **more):
    return {"id": i, "status": status, "created_at": T(created), "updated_at": T(updated), **more}


def test_case_pipeline(make):
    deals = make(
        "re_deals",
        deal(1, "VIEWED", assigned_user_id=10, proposed_rent=100), deal(2, "VIEWED", "2024-06-01T15:00:00", assigned_user_id=9),
        deal(3, "INQUIRY"), deal(4, "CONTRACTED"), deal(5, "LOST"), deal(6, "OTHER", assigned_user_id=1),
    )
    got = [tuple(r) for r in leasing.re_case_pipeline(deals, AS_OF, sort=True).collect()]
    assert got == [("INQUIRY", 1, 0, 29.0, 0, None), ("VIEWED", 2, 100, 28.5, 2, "10,9"), ("OTHER", 1, 0, 29.0, 1, "1")]


def test_lead_funnel_and_weeks(make):
    traffic = make("re_search_console", {"date": D("2024-06-30"), "clicks": 4, "impressions": 10}, {"date": D("2023-01-01"), "clicks": 99, "impressions": 1})
    tenants = make("re_tenants", {"id": 1, "created_at": T("2024-06-29T14:59:00")}, {"id": 2, "created_at": T("2024-06-29T15:00:00")})
    deals = make(
        "re_deals",
        deal(1, "CONTRACTED", "2024-06-29T15:00:00", "2024-06-30T14:59:00"), deal(2, "LOST", "2020-01-01T00:00:00", "2024-06-30T00:00:00"),
        deal(3, "VIEWED", "2024-06-30T15:00:00", "2024-06-30T15:00:00"),
    )
    funnel = leasing.re_lead_funnel(traffic, tenants, deals, AS_OF)
    got = by(funnel, "date")
    assert len(got) == 366 and min(got) == D("2023-07-01") and max(got) == AS_OF
    today = got[AS_OF]
    assert tuple(today)[1:] == (4, 10, 1, 1, 1, 1, 25.0, 100.0, 100.0)
    assert tuple(got[D("2024-06-29")])[1:] == (0, 0, 1, 0, 0, 0, None, 0.0, None)
    weeks = by(leasing.re_weekly_summary(funnel), "week_start")
    assert len(weeks) == 53
    this = weeks[D("2024-06-24")]
    assert (this.organic_clicks, this.inquiries, this.won, this.clicks_wow_pct) == (4, 2, 1, None)
    assert weeks[D("2023-06-26")].clicks_wow_pct is None


def test_property_performance(make):
    homes = make("re_properties", *[{"id": i, "property_name": str(i), "created_at": T("2024-06-28T15:00:00")} for i in (1, 2)])
    deals = make(
        "re_deals",
        deal(1, "CONTRACTED", "2024-06-01T23:00:00", "2024-06-03T01:00:00", property_id=1), deal(2, "LOST", property_id=1), deal(3, "VIEWED", property_id=1),
    )
    acts = make("re_activities", *[{"id": i, "property_id": p, "activity_type": t} for i, p, t in ((1, 1, "VIEWING"), (2, 1, "CALL"), (3, 9, "VIEWING"))])
    got = by(leasing.re_property_performance(homes, deals, acts, AS_OF), "property_id")
    one, two = got[1], got[2]
    assert (one.total_deals, one.won_deals, one.lost_deals, one.active_deals) == (3, 1, 1, 1)
    assert (one.avg_lead_time_days, one.total_viewings, one.win_rate_pct, one.days_listed) == (2.0, 1, 33.3, 1)
    assert (two.total_deals, two.avg_lead_time_days, two.total_viewings, two.win_rate_pct) == (0, None, 0, None)


def test_seo_inquiry_attribution(make):
    now = T("2024-06-30T16:00:00")  # already 1 July in Tokyo
    page = lambda q, clicks, day="2024-06-15", position=2.0: {"date": D(day), "page": "p", "query": q, "clicks": clicks, "impressions": 10, "position": position}
    traffic = make("re_search_console", page("a", 1), page("a", 3, position=4.0), page("b", 9), page("none", 0), page("old", 5, "2024-05-31"), page("edge", 1, "2024-06-01"))
    person = lambda i, source, at: {"id": i, "source": source, "created_at": T(at)}
    tenants = make("re_tenants", person(1, "WEB", "2024-06-20"), person(2, "My Site", "2024-06-20"), person(3, None, "2024-06-20"), person(4, "web", "2024-05-31T15:59:59"))
    got = [tuple(r) for r in leasing.re_seo_inquiry_attribution(traffic, tenants, now).collect()]
    assert got == [("p", "b", 9, 10, 2.0, 1), ("p", "a", 4, 20, 3.5, 1), ("p", "edge", 1, 10, 2.0, 1)]
    named = leasing.re_seo_inquiry_attribution(traffic, tenants, now, site_names=["my site"], top=1).collect()
    assert [r.total_web_inquiries_30d for r in named] == [2]


def test_revenue_of_both_businesses(make):
    shop_weeks = ec_weekly_summary(make("ec_shopify_orders", order(1)))
    funnel = make("x", {"date": D("2024-01-01"), "organic_clicks": 1, "inquiry_count": 2, "new_deal_count": 3, "won_count": 4, "lost_count": 5}, schema=_funnel())
    both = by(central.all_revenue_summary(shop_weeks, leasing.re_weekly_summary(funnel)), "business")
    assert (both["ec"].weekly_revenue, both["ec"].won) == (1000, None)
    assert (both["re"].weekly_revenue, both["re"].won) == (None, 4)


def _funnel():
    from martloom.sources.schemas import struct

    return struct("date D, organic_clicks I, inquiry_count I, new_deal_count I, won_count I, lost_count I")


def test_quality(make):
    orders = make("ec_shopify_orders", order(1), order(1), order(2, None, sku="zz"))
    assert rows(quality.duplicate_keys(orders, ["order_id", "line_item_id"])) == [("1", "1-1", 2)]
    missing = dict(rows(quality.missing_required(orders, SCHEMAS["ec_shopify_orders"])))
    assert missing["customer_email"] == 1 and missing["order_id"] == 0 and "utm_source" not in missing
    costs = make("ec_cost_master", {"sku": "s1"})
    assert rows(quality.skus_without_master(orders, costs)) == [("zz",)]
    rule = lambda a, b, fee: {"valid_from": D(a), "valid_to": D(b), "shipping_fee_per_order": fee}
    rules = make("ec_shipping_rules", rule("2020-01-01", "2023-12-31", 1), rule("2024-01-01", "2099-12-31", 2), rule("2030-01-01", "2030-01-02", 3))
    assert rows(quality.overlapping_periods(rules), "shipping_fee_per_order") == [(3,)]
    assert rows(quality.yearly_orders(orders)) == [(2024, 3, 2)]
