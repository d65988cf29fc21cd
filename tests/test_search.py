from martloom.plans import search
from tests.conftest import D, rows
from tests.test_shop import by, order

OWN = "https://own.example/"
NOW, OLD = "2024-06-20", "2023-07-10"


def seen(query, day=NOW, clicks=0, impressions=100, position=5.0, url="https://own.example/p"):
    return {"data_date": D(day), "query": query, "url": url, "clicks": clicks, "impressions": impressions, "position": position}


def keyword(word, target=OWN, volume=1000, difficulty=10, day="2024-06-15"):
    return {"fetched_date": D(day), "target_url": target, "domain": target.split("/")[2], "keyword": word, "search_volume": volume, "seo_difficulty": difficulty, "cpc": 1.0}


def test_search_to_purchase(make):
    history = make(
        "sc_history",
        seen("q", "2024-06-01", 10, url="https://own.example/p"), seen("q", "2024-06-02", 10, url="https://own.example/p"),
        seen("root", "2024-06-01", 0, url="https://own.example/"), seen("none", "2024-05-01", 4, url="https://own.example/p"),
        seen("nopath", "2024-06-01", 4, url="https://own.example"),
    )
    orders = make(
        "ec_shopify_orders",
        order(1, day="2024-06-03", landing_site="/p?x=1", price=200), order(2, day="2024-06-04", landing_site="/p/deep"),
        order(3, day="2024-06-05", landing_site="https://own.example/p"), order(4, day="2024-06-05", landing_site="?x"),
    )
    got = by(search.ec_search_to_purchase(history, orders), "sc_query")
    q = got["q"]
    assert (q.sc_clicks, q.matched_orders, q.matched_revenue, q.conversion_rate_pct, q.revenue_per_click) == (20, 2, 1200, 10.0, 60.0)
    assert (got["root"].matched_orders, got["root"].conversion_rate_pct) == (2, None)
    assert (got["none"].matched_orders, got["none"].matched_revenue, got["none"].revenue_per_click) == (0, 0, 0.0)
    assert (got["nopath"].sc_path, got["nopath"].matched_orders) == (None, 0)


def test_seo_opportunity(make):
    history = make(
        "sc_history",
        seen("loss", clicks=1), seen("loss", OLD, 101), seen("minor", clicks=1), seen("minor", OLD, 31),
        seen("low", clicks=5, position=2.0), seen("low", OLD, 5), seen("grow", clicks=9), seen("flat", clicks=3), seen("flat", OLD, 3),
        seen("goneknown", OLD, 50), seen("gone", OLD, 200), seen("between", "2024-01-01", 7),
    )
    words = make("rakko_inflow_keywords", *[keyword(w) for w in ("low", "goneknown")], keyword("flat", volume=None), keyword("loss", target="https://x.example/"))
    orders = make("ec_shopify_orders", order(1, day="2024-06-10", price=1000), order(2, day="2024-01-01", price=9))
    got = search.ec_seo_opportunity(history, words, orders, D("2024-06-30"), OWN).collect()
    kinds = {r.keyword: r.opportunity_type for r in got}
    assert kinds == {
        "loss": "declining_loss", "minor": "declining_minor", "low": "top3_low_ctr", "grow": "growing", "flat": "stable",
        "goneknown": "new_opportunity", None: "declining_loss",
    }
    loss = next(r for r in got if r.keyword == "loss")
    assert (loss.click_decline, loss.estimated_monthly_loss_yen, loss.sc_recent_position, loss.search_volume) == (100, 1500.0, 5.0, None)
    no_sales = search.ec_seo_opportunity(history, words, orders.limit(0), D("2024-06-30"), OWN).collect()
    assert {r.estimated_monthly_loss_yen for r in no_sales} == {None}


def test_competitor_gap(make):
    a, b = "https://a.example/", "https://b.example/"
    both = lambda w, **k: [keyword(w, a, **k), keyword(w, b, **k)]
    words = make(
        "rakko_inflow_keywords",
        *both("gap", volume=100), keyword("gap", a, 5), *both("low", volume=99), *both("top", volume=30000), *both("huge", volume=30001),
        keyword("single", a), *both("mine"), keyword("mine"), *both("hard", difficulty=None), *both("", volume=500),
        *both("stale", day="2024-06-01"),
    )
    orders = make("ec_shopify_orders", order(1, day="2024-06-10", price=1000))
    got = rows(search.ec_competitor_gap(words, orders, D("2024-06-30"), OWN, sort=True), "keyword", "search_volume", "competitor_count", "competitors", "estimated_monthly_opportunity_yen")
    assert got == [("gap", 100, 2, "a.example,b.example", 150.0), ("top", 30000, 2, "a.example,b.example", 45000.0)]


def test_analyses(make):
    history = make(
        "sc_history",
        seen("acme pan", "2024-01-05", 100, 1000, 2.0), seen("pan", "2024-01-06", 60, 500, 10.0, "https://own.example/b"),
        seen("pan", "2024-03-06", 2, 500, 12.0, "https://own.example/b"), seen("new", "2024-03-07", 50, 100, 1.0), seen("acme pan", "2024-03-08", 50, 900, 3.0),
    )
    old, new = (D("2024-01-01"), D("2024-01-31")), (D("2024-03-01"), D("2024-03-31"))
    assert rows(search.monthly_trend(history))[0] == (D("2024-01-01"), 160, 1500, 10.67, 4.7, 2)
    assert rows(search.ctr_by_position_band(history))[0] == (D("2024-01-01"), 10.0, 12.0, None, 1000)
    assert rows(search.brand_share(history, ["acme", "akme"]))[0] == (D("2024-01-01"), 100, 60, 62.5)
    decline = [tuple(r) for r in search.query_decline(history, old, new, top=2).collect()]
    assert decline == [("pan", 60, 2, -58, 10.0, 12.0), ("acme pan", 100, 50, -50, 2.0, 3.0)]
    assert [tuple(r) for r in search.page_decline(history, old, new, top=1).collect()] == [("/b", 60, 2, -97.0)]
    assert tuple(search.query_survival(history, old, new).first()) == (1, 0, 0, 1, 1)
