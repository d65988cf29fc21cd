import json

import pytest
from pyspark.sql import functions as F

from martloom.ingest import entities, marketing, payloads, shop
from martloom.sources.schemas import SCHEMAS
from tests.conftest import D, T, rows

RUN = T("2024-07-01T00:00:00")
DAY = D("2024-07-01")


@pytest.fixture
def land(tmp_path):
    """Write documents (one per line) or texts into a folder of files; returns the folder."""

    def put(*files, name="in"):
        folder = tmp_path / name
        folder.mkdir()
        for i, f in enumerate(files):
            text = f if isinstance(f, str) else "\n".join(json.dumps(d) for d in f)
            (folder / f"{i:03d}.txt").write_text(text, encoding="utf-8")
        return str(folder)

    return put


def same_columns(df, table):
    want = SCHEMAS[table]
    assert df.columns == want.fieldNames()
    assert {f.name: f.dataType for f in df.schema.fields} == {f.name: f.dataType for f in want.fields}


def test_orders_rest(spark, land):
    line = {"id": 11, "product_id": 5, "sku": None, "title": "T", "quantity": 2, "price": "10.5", "discount_allocations": [{"amount": "1.25"}, {"amount": "1.25"}]}
    full = {
        "id": 1, "name": "#1", "created_at": "2024-06-30T23:30:00+09:00", "email": "o@x", "customer": {"id": 7, "email": "c@x"},
        "total_price": "1000.5", "subtotal_price": "", "landing_site": "/p?utm_source=a%20b&utm_medium=&utm_campaign=c", "tags": "",
        "refunds": [
            {"created_at": "2024-07-02T00:00:00+09:00", "note": "", "transactions": [{"amount": "100.2"}, {"amount": "0.3"}]},
            {"created_at": "2024-07-03T00:00:00+09:00", "note": "later", "transactions": []},
        ],
        "line_items": [line, {"id": 12, "sku": "s", "quantity": 1, "price": "3", "discount_allocations": []}],
    }
    guest = {"id": 2, "created_at": "2024-06-30T00:00:00+09:00", "email": "g@x", "customer": {"id": 8, "email": ""}, "total_price": "5", "refunds": [], "line_items": [{"id": 21, "quantity": 1, "price": "5"}]}
    nobody = {"id": 3, "created_at": "2024-06-30T00:00:00+09:00", "email": None, "line_items": [{"id": 31, "quantity": 1, "price": "5"}]}
    df = shop.orders_from_rest(payloads.read_json(spark, land([full, guest, nobody]), payloads.ORDER), RUN)
    same_columns(df, "ec_shopify_orders")
    a, b, c = sorted(df.collect(), key=lambda r: r.line_item_id)
    assert (a.order_id, a.customer_email, a.customer_id, a.order_date, a.created_at) == ("1", "c@x", "7", D("2024-06-30"), T("2024-06-30T14:30:00"))
    assert (a.total_price, a.subtotal_price, a.unit_price, a.line_discount, a.sku) == (1001, None, 11, 3, "")
    assert (a.is_refunded, a.refund_date, a.refund_amount, a.refund_reason) == (True, D("2024-07-02"), 101, None)
    assert (a.utm_source, a.utm_medium, a.utm_campaign, a.tags, a.inserted_at) == ("a b", None, "c", None, RUN)
    assert (b.line_item_id, b.line_discount) == ("12", None)
    assert (c.customer_email, c.is_refunded, c.refund_amount) == ("g@x", False, None)


def test_bulk_export_is_staged_by_many_tasks(spark, land, tmp_path):
    docs = [{"id": f"gid://shop/{('Order', 'LineItem', 'Refund', 'Other')[i % 4]}/{i}", "note": "n" * 400} for i in range(8_000)]
    names = [*payloads.STAGING, "spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k, None) for k in names}
    staged = payloads.staged_bulk(payloads.read_bulk(spark, land(docs)), str(tmp_path / "staged"))
    assert {k: spark.conf.get(k, None) for k in names} == before
    assert sorted(r.id for r in staged.collect()) == sorted(d["id"] for d in docs if "Other" not in d["id"])
    tasks = {f.name.split("-")[1] for f in (tmp_path / "staged").rglob("part-*.parquet")}
    assert len(tasks) >= 3  # 3.5 MB of documents; Spark's own splits make a task of them


def test_orders_bulk(spark, land):
    money = lambda v: {"shopMoney": {"amount": v}}
    gid = lambda kind, i: f"gid://shop/{kind}/{i}"
    docs = [
        {"id": gid("Order", 1), "name": "first copy", "createdAt": "2024-06-30T00:00:00Z", "email": "o@x"},
        {"id": gid("LineItem", 11), "__parentId": gid("Order", 1), "sku": "s", "quantity": 1, "originalUnitPriceSet": money("2.5"), "discountAllocations": [{"allocatedAmountSet": money("1.5")}, {"allocatedAmountSet": money("2.0")}]},
        {"id": gid("Refund", 91), "__parentId": gid("Order", 1), "createdAt": "2024-07-09T00:00:00Z", "note": "first in file"},
        {"id": gid("Refund", 92), "__parentId": gid("Order", 1), "createdAt": "2024-07-01T00:00:00Z", "note": "second in file"},
        {"id": gid("Order", 1), "name": "#1", "createdAt": "2024-06-30T00:00:00Z", "email": "o@x", "customer": {"id": gid("Customer", 7), "email": None}, "displayFinancialStatus": "PAID", "totalPriceSet": money("3.5"), "totalRefundedSet": money("2"), "tags": ["x", "y"], "landingPageUrl": "https://s.example/?utm_source=z"},
        {"id": gid("LineItem", 12), "__parentId": gid("Order", 1), "quantity": 1, "discountAllocations": []},
        {"id": gid("Order", 2), "createdAt": "2024-06-30T00:00:00Z", "email": ""},
        {"id": gid("LineItem", 21), "__parentId": gid("Order", 2), "quantity": 1},
        {"id": gid("LineItem", 99), "__parentId": gid("Order", 404), "quantity": 1},
        {"id": gid("Order", 3), "createdAt": "2024-06-30T00:00:00Z", "email": "p@x"},
        {"id": gid("LineItem", 31), "__parentId": gid("Order", 3), "quantity": 4},
    ]
    df = shop.orders_from_bulk(payloads.read_bulk(spark, land(docs)), RUN)
    same_columns(df, "ec_shopify_orders")
    a, b, c = sorted(df.collect(), key=lambda r: r.line_item_id)
    assert (a.order_id, a.order_name, a.customer_id, a.financial_status, a.tags) == ("1", "#1", "7", "paid", "x,y")
    assert (a.total_price, a.unit_price, a.line_discount) == (4, 2, 4)  # halves to even
    assert (a.is_refunded, a.refund_date, a.refund_amount, a.refund_reason) == (True, D("2024-07-09"), 2, "first in file")
    assert (b.sku, b.line_discount, b.utm_source) == ("", None, "z")
    assert (c.order_id, c.is_refunded, c.refund_amount, c.financial_status) == ("3", False, None, None)


def test_product_snapshot(spark, land):
    variant = lambda i, **m: {"node": {"id": f"gid://shopify/ProductVariant/{i}", "inventoryItem": {"id": f"gid://shopify/InventoryItem/{i}"}, **m}}
    cost = {"id": "gid://shopify/InventoryItem/9", "unitCost": {"amount": "10.5", "currencyCode": "USD"}}
    page = {"data": {"products": {"edges": [{"node": {"id": "gid://shopify/Product/1", "title": "P", "variants": {"edges": [variant(1, sku="", price="99.5"), variant(2, sku="s", inventoryItem=cost)]}}}]}}}
    df = shop.product_snapshot(payloads.read_json(spark, land([page]), payloads.PRODUCTS), DAY, RUN)
    same_columns(df, "ec_shopify_products_daily")
    assert rows(df, "variant_id", "sku", "price", "cost_price", "inventory_item_id", "currency") == [("1", None, 100, None, "1", "JPY"), ("2", "s", None, 11, "9", "USD")]


def test_stock_snapshot(spark):
    bodies = ['{"items":[{"id":1,"code":"s","stock":{"quantity":5,"available":"3"}}]}', '[{"id":"x","name":"n"}]', '{"other":1}']
    df = shop.stock_snapshot(spark.createDataFrame([(b,) for b in bodies], "body string"), DAY, RUN)
    same_columns(df, "ec_openlogi_inventory_daily")
    got = rows(df, "item_id", "sku", "item_name", "quantity", "available", "shipping")
    assert got == [("1", "s", None, 5, 3, None), ("x", None, "n", None, None, None)]
    assert json.loads(df.filter("item_id = '1'").first().raw_payload)["stock"] == {"quantity": 5, "available": "3"}


def test_keywords(spark):
    body = json.dumps({"data": {"items": [{"keyword": "k", "metrics": {"searchVolume": 10, "cpc": 1.5}}, {"metrics": None}]}})
    df = spark.createDataFrame([("https://a.example/x", "sub_domain", body), ("https://b.example/", "sub_domain", '{"data":{}}')], "target_url string, match_type string, body string")
    out = marketing.keyword_rows(payloads.parse(df, payloads.KEYWORDS), DAY, RUN)
    same_columns(out, "rakko_inflow_keywords")
    assert rows(out, "domain", "keyword", "search_volume", "cpc", "rank") == [("a.example", "", None, None, None), ("a.example", "k", 10, 1.5, None)]


def test_email_campaigns(spark, land):
    campaign = lambda i, **a: {"id": i, "attributes": a}
    meta = {"data": [campaign("c1", name="A", send_time="2024-07-01T23:30:00+09:00"), campaign("c2", scheduled_at="2024-07-07T00:00:00Z"), campaign("c3")]}
    result = lambda i, **s: {"groupings": {"campaign_id": i}, "statistics": s}
    page = lambda *r: {"data": {"attributes": {"results": list(r)}}}
    stats = [page(result("c1", recipients=1), result("c1", recipients=2, opens=9, opens_unique=4, conversion_value=10.5)), page(result("c2", opens=3, revenue=7.4), {"statistics": {}})]
    got = marketing.email_campaigns(
        payloads.read_json(spark, land([meta], name="meta"), payloads.CAMPAIGNS),
        payloads.with_position(payloads.read_json(spark, land(stats, name="stats"), payloads.CAMPAIGN_STATS)),
        RUN,
    )
    same_columns(got, "ec_klaviyo_campaigns")
    assert rows(got, "campaign_id", "sent_day_of_week", "sent_hour", "recipients", "opens", "revenue") == [
        ("c1", "Monday", 14, 2, 4, 11), ("c2", "Sunday", 0, None, 3, 7), ("c3", None, None, None, None, None),
    ]


def test_email_profiles(spark, land):
    person = lambda i, **a: {"id": i, "attributes": a}
    page = {"data": [
        person("1", email="a@x", first_name="", created="2024-01-01T00:00:00Z", last_event_date="2024-02-01T00:00:00Z", predictive_analytics={"historic_clv": 99.5}),
        person("2", email="b@x", created="2024-01-01T00:00:00Z"), person("3", email=""), person("4", email="d@x", updated="2024-03-01T00:00:00Z", created="2024-01-01T00:00:00Z"),
    ]}
    got = marketing.email_profiles(payloads.read_json(spark, land([page]), payloads.PROFILES), RUN)
    same_columns(got, "ec_klaviyo_profiles")
    assert rows(got, "profile_id", "first_name", "total_revenue", "updated_at") == [("1", None, 100, T("2024-02-01")), ("2", None, None, T("2024-01-01")), ("4", None, None, T("2024-03-01"))]


def test_social_posts(spark):
    post = lambda i: {"id": i, "media_type": "IMAGE", "timestamp": "2024-06-01T00:00:00+0000", "like_count": 3}
    metric = lambda n, v: {"name": n, "values": [{"value": v}]}
    media = spark.createDataFrame([(json.dumps({"data": [post("1"), post("2"), post("3")]}),)], "body string")
    insights = [("1", {"data": [metric("reach", 3), metric("total_interactions", 2), metric("saved", "4"), metric("impressions", {"a": 1})]}), ("2", {"data": [metric("reach", 0), metric("total_interactions", 2)]})]
    got = marketing.social_posts(
        payloads.parse(media, payloads.MEDIA),
        payloads.parse(spark.createDataFrame([(i, json.dumps(d)) for i, d in insights], "post_id string, body string"), payloads.INSIGHTS),
        DAY, RUN,
    )
    same_columns(got, "ec_instagram_organic")
    assert rows(got, "post_id", "impressions", "reach", "saves", "engagement_rate") == [("1", None, 3, 4, 0.666667), ("2", None, 0, None, None)]


def test_search_rows(spark):
    page = {"rows": [{"keys": ["2024-06-01", "u", "q"], "clicks": 1, "position": 2.5}, {"keys": ["2024-06-01", "u"], "clicks": 9}]}
    df = spark.createDataFrame([("site", json.dumps(page)), ("site", "{}")], "site_url string, body string")
    got = marketing.search_rows(payloads.parse(df, payloads.SEARCH_ROWS))
    same_columns(got, "sc_history")
    assert rows(got) == [(D("2024-06-01"), "site", "u", "q", 1, 0, 0.0, 2.5)]


def test_ad_report(spark, land):
    search = 'Day,CampaignID,Campaign name,Impressions,Clicks,Cost,Conversions,Conv. value\n2024-06-01,1,"Pans, large","1,200",3,10.5,,7\n--,2,x,1,1,1,1,1\n2024-06-02,--,x,1,1,1,1,1\n'
    display = "Daily,Campaign ID,Campaign Name,Imps,Clicks,Cost\n20240603,5,D,1,2,x\nTotal,,,9,9,9\n"
    got = marketing.ad_report(marketing.read_ad_report(spark, land(search, name="s")), "search", RUN)
    same_columns(got, "ec_yahoo_ads")
    assert rows(got.drop("inserted_at")) == [(D("2024-06-01"), "1", "Pans, large", "search", None, 1200, 3, 11, 0.0, 7)]
    got = marketing.ad_report(marketing.read_ad_report(spark, land(display, name="d")), "display", RUN)
    same_columns(got, "ec_yahoo_ads")
    assert rows(got.drop("inserted_at")) == [(D("2024-06-03"), "5", "D", "display", None, 1, 2, None, None, None)]


def test_ad_report_with_preamble(spark, land):
    head = '"Report Name: a, b"\r\n"Time: x"\r\n\r\n'
    a = head + '"TimePeriod","CampaignId","CampaignName","Impressions","Spend"\r\n"2024-06-01","1","N, ""x""","1,000","2.5"\r\n\r\n"©2024, all rights"\r\n'
    b = head + "CampaignId,TimePeriod,CampaignType,Clicks\n7,2024-06-02,Search,4\n"
    lines = payloads.read_lines(spark, land(a, b, "no header here\n1,2,3\n"))
    got = marketing.ad_report_with_preamble(lines, RUN)
    same_columns(got, "ec_microsoft_ads")
    one, two = sorted(got.collect(), key=lambda r: r.campaign_id)
    assert (one.date, one.campaign_type, one.impressions, one.clicks, one.cost, one.revenue) == (D("2024-06-01"), None, 1000, None, 3, None)
    assert one.campaign_name.startswith("N, ")
    assert (two.date, two.campaign_id, two.campaign_type, two.clicks, two.impressions) == (D("2024-06-02"), "7", "Search", 4, None)


def test_views(spark):
    stats = spark.createDataFrame(
        [(D("2024-06-30"), 1, 10, 1, 1_500_000, 0.5, 2.5), (D("2024-09-30"), 1, 10, 1, 0, 0.0, 0.0)],
        "_DATA_DATE date, campaign_id long, metrics_impressions long, metrics_clicks long, metrics_cost_micros long, metrics_conversions double, metrics_conversions_value double",
    )
    campaigns = spark.createDataFrame(
        [(D("2024-06-01"), 1, "old", "SEARCH"), (D("2024-06-15"), 1, "new", "SEARCH"), (D("2024-07-15"), 1, "later", "SEARCH")],
        "_DATA_DATE date, campaign_id long, campaign_name string, campaign_advertising_channel_type string",
    )
    got = marketing.google_ads_view(stats, campaigns, RUN)
    same_columns(got, "ec_google_ads")
    assert rows(got, "date", "campaign_name", "cost", "revenue") == [(D("2024-06-30"), "new", 2, 3)]

    insights = spark.createDataFrame([(D("2024-06-01"), "c", "n", "s", "a", "10", "x", "2.5"), (D("2024-06-01"), "c", "n", "s", "b", "1", "2", None)], "DateStart date, CampaignId string, CampaignName string, AdSetId string, AdId string, Impressions string, Clicks string, Spend string")
    actions = spark.createDataFrame([(D("2024-06-01"), "a", "1"), (D("2024-06-01"), "a", "2.5"), (D("2024-06-01"), "a", "bad")], "DateStart date, AdId string, Action1dClick string")
    got = marketing.meta_ads_view(insights, actions, RUN)
    same_columns(got, "ec_meta_ads")
    assert rows(got, "impressions", "clicks", "cost", "conversions") == [(1, 2, None, 0.0), (10, None, 3, 3.5)]

    export = spark.createDataFrame([(D("2024-06-01"), "u", "q", 1, 0, 5.0), (D("2024-06-01"), "u", None, 1, 4, 5.0), (D("2024-06-01"), "u", "r", 1, 4, 6.0)], "data_date date, url string, query string, clicks long, impressions long, sum_position double")
    got = marketing.search_console_view(export, RUN)
    same_columns(got, "ec_search_console")
    assert rows(got, "query", "ctr", "position") == [("q", None, None), ("r", 0.25, 1.5)]


def test_entities(spark):
    df = spark.createDataFrame([(1, {"a": 1}, [1, 2], True, D("2024-01-01"), None)], "id long, extra map<string,int>, areas array<int>, ok boolean, day date, note string")
    got = entities.flat_rows(df, RUN).first()
    assert tuple(got) == (1, '{"a":1}', "[1,2]", True, "2024-01-01", None, RUN)


def test_a_misfit_document_fails_the_load(spark, land):
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        payloads.read_json(spark, land([{"rows": [{"keys": "not a list"}]}]), payloads.SEARCH_ROWS).select(F.col("rows")).collect()
