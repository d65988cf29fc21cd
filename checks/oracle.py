"""The same results in SQL, formulated on their own."""

from __future__ import annotations

from checks.sql import BRAND_PATTERN, labelled, with_parts
from martloom.sources.given import DEAL_STATES, OWN_URL

ORACLE: dict[str, str] = {}


def sql(name: str, parts: str, body: str) -> None:
    ORACLE[name] = with_parts(parts, body)


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def rnd(x: str, places: int = 0) -> str:
    scale = f"{10**places}::DOUBLE"
    return f"round({x})" if places == 0 else f"(round(({x}) * {scale}) / {scale})"


def pct(a: str, b: str, places: int = 1) -> str:
    return rnd(f"{div(a, b)} * 100::DOUBLE", places)


def big(x: str) -> str:
    return f"({x})::BIGINT"


# ------------------------------------------------------------------ shop

_WEEKLY = f"""
    SELECT date_trunc('week', order_date)::DATE AS week_start, {big('sum(total_price)')} AS weekly_revenue,
           count(DISTINCT order_id) AS weekly_orders, count(DISTINCT customer_email) AS weekly_customers,
           {rnd(div('sum(total_price)', 'count(total_price)'))} AS avg_order_value,
           count(*) FILTER (is_refunded) AS refund_count, {pct('count(*) FILTER (is_refunded)', 'count(*)')} AS refund_rate_pct
    FROM {{source}} GROUP BY ALL"""
sql("ec_weekly_summary", "lines", _WEEKLY.format(source="lines"))
sql(
    "ec_weekly_summary_per_order",
    "lines",
    _WEEKLY.format(
        source="(SELECT order_id, order_date, customer_email, total_price, bool_or(is_refunded) AS is_refunded FROM lines GROUP BY ALL)"
    ),
)

sql("ec_cost_master", "costs", "SELECT * FROM costs")

sql(
    "ec_daily_pnl",
    "lines costs rules",
    f"""
    SELECT order_date, order_id, l.sku, quantity, unit_price, total_price AS revenue, cost_price,
           cost_price * quantity AS total_cost, total_price - cost_price * quantity AS gross_profit,
           fee::BIGINT AS shipping_fee_per_order, total_price - cost_price * quantity - fee AS actual_gross_profit,
           {pct('total_price - cost_price * quantity - fee', 'total_price')} AS actual_margin_pct, is_refunded, refund_amount
    FROM lines l
    LEFT JOIN costs c ON c.sku = l.sku AND order_date >= c.valid_from AND order_date <= c.valid_to
    JOIN rules r ON order_date >= r.valid_from AND order_date <= r.valid_to""",
)

sql(
    "ad_cost_feed",
    "ads",
    f"SELECT day AS date, channel, {big('sum(cost)')} AS ad_cost FROM ads WHERE channel IS NOT NULL GROUP BY ALL",
)

_ROI = f""", by_day AS (
    SELECT order_date AS date, channel, count(DISTINCT order_id) AS orders, count(DISTINCT customer_email) AS customers,
           {big('sum(total_price)')} AS revenue, count(*) FILTER (is_refunded) AS refunds, count(*) AS n
    FROM {labelled('roi', raw_organic=False)} GROUP BY ALL),
    spend AS (SELECT day AS date, channel, {big('sum(cost)')} AS ad_cost FROM ads WHERE channel IS NOT NULL GROUP BY ALL),
    roi AS (
    SELECT date, channel, orders, customers AS unique_customers, revenue, ad_cost,
           {rnd(div('revenue', 'ad_cost'), 2)} AS roas, {rnd(div('ad_cost', 'orders'))} AS cpa, refunds AS refund_count,
           {pct('refunds', 'n')} AS refund_rate_pct, {div('revenue', 'customers')} AS ltv
    FROM by_day FULL JOIN spend USING (date, channel))"""
sql("ec_channel_roi", "tagged paid found ads", _ROI + " SELECT * FROM roi")

for _name, _source in {
    "roi": labelled("roi", raw_organic=False),
    "profile": labelled("customer"),
    "attribution": labelled("customer", unknown=True),
    "basic": labelled("basic", resolve=False),
}.items():
    sql(
        f"channel_rules_{_name}",
        "tagged paid found",
        f"SELECT channel, count(*) AS lines, count(DISTINCT order_id) AS orders FROM {_source} GROUP BY ALL",
    )

sql(
    "ec_cohort_ltv",
    "lines",
    f""", months AS (
        SELECT *, date_trunc('month', order_date)::DATE AS month,
               min(date_trunc('month', order_date)::DATE) OVER (PARTITION BY customer_email) AS cohort FROM lines),
    cells AS (
        SELECT cohort, date_diff('month', cohort, month) AS age, count(DISTINCT customer_email) AS active,
               count(DISTINCT order_id) AS orders, {big('sum(total_price)')} AS revenue FROM months GROUP BY ALL),
    sums AS (
        SELECT a.*, (SELECT {big('sum(b.orders)')} FROM cells b WHERE b.cohort = a.cohort AND b.age <= a.age) AS all_orders,
               (SELECT {big('sum(b.revenue)')} FROM cells b WHERE b.cohort = a.cohort AND b.age <= a.age) AS all_revenue,
               (SELECT b.active FROM cells b WHERE b.cohort = a.cohort AND b.age = 0) AS size
        FROM cells a)
    SELECT cohort AS cohort_month, age AS months_since_first, size AS cohort_size, active AS active_customers,
           {pct('active', 'size')} AS retention_pct, orders AS month_orders, revenue AS month_revenue,
           all_orders AS cumulative_orders, all_revenue AS cumulative_revenue,
           {rnd(div('all_revenue', 'size'))} AS cumulative_ltv
    FROM sums""",
)

sql(
    "ec_repeat_pattern",
    "lines",
    f""", days AS (
        SELECT customer_email AS c, order_date AS d, row_number() OVER (PARTITION BY customer_email ORDER BY order_date) AS n
        FROM (SELECT DISTINCT customer_email, order_date FROM lines)),
    gaps AS (SELECT a.n, (b.d - a.d)::BIGINT AS gap FROM days a JOIN days b ON a.c = b.c AND b.n = a.n + 1 WHERE a.n <= 10)
    SELECT n AS order_index, count(*) AS customer_count, {rnd(div('sum(gap)', 'count(*)'))} AS avg_days_to_next,
           quantile_disc(gap, 0.25) AS p25_days, quantile_disc(gap, 0.5) AS median_days, quantile_disc(gap, 0.75) AS p75_days,
           {', '.join(f"{pct(f'count(*) FILTER (gap <= {d})', 'count(*)')} AS pct_within_{d}d" for d in (30, 60, 90, 180))}
    FROM gaps GROUP BY n""",
)

_FIRST_LAST = """ranked AS (
        SELECT *, row_number() OVER (PARTITION BY customer_email ORDER BY order_date, order_id) AS up,
               row_number() OVER (PARTITION BY customer_email ORDER BY order_date DESC, order_id DESC) AS down
        FROM labelled)"""
sql(
    "ec_customer_profile",
    "tagged paid found",
    f""", labelled AS (SELECT * FROM {labelled('customer')}), {_FIRST_LAST},
    liked AS (
        SELECT customer_email, sku FROM labelled GROUP BY customer_email, sku
        QUALIFY row_number() OVER (PARTITION BY customer_email ORDER BY count(*) DESC, sku) = 1)
    SELECT customer_email, max(customer_id) AS customer_id, min(order_date) AS first_order_date,
           max(order_date) AS last_order_date, count(DISTINCT order_id) AS total_orders,
           {big('sum(total_price)')} AS total_revenue, {rnd(div('sum(total_price)', 'count(*)'))} AS avg_order_value,
           (DATE '2001-08-01' - max(order_date))::BIGINT AS days_since_last_order,
           date_trunc('month', min(order_date))::DATE AS cohort_month,
           DATE '2001-08-01' - max(order_date) >= 180 AS is_dormant, count(DISTINCT order_id) >= 2 AS is_repeater,
           max(channel) FILTER (up = 1) AS first_channel, max(channel) FILTER (down = 1) AS last_channel,
           max(liked.sku) AS favorite_sku, count(*) FILTER (contains(tags, 'ギフト設定')) AS gift_purchase_count
    FROM ranked LEFT JOIN liked USING (customer_email) GROUP BY customer_email""",
)
sql(
    "ec_attribution_first_last",
    "tagged paid found",
    f""", labelled AS (SELECT * FROM {labelled('customer', unknown=True)}), {_FIRST_LAST},
    ends AS (
        SELECT customer_email, min(order_date) AS first_order_date, max(channel) FILTER (up = 1) AS first_channel,
               first(camp ORDER BY up) FILTER (camp IS NOT NULL) AS first_utm_campaign, max(order_date) AS last_order_date,
               max(channel) FILTER (down = 1) AS last_channel,
               first(camp ORDER BY down) FILTER (camp IS NOT NULL) AS last_utm_campaign,
               count(DISTINCT order_id) AS total_orders
        FROM ranked GROUP BY customer_email)
    SELECT *, first_channel = last_channel AS is_same_channel,
           CASE WHEN total_orders = 1 THEN 'one_time' WHEN first_channel <> last_channel THEN 'cross_channel'
                ELSE 'loyal_same_channel' END AS journey_type
    FROM ends""",
)

sql(
    "ec_klaviyo_conversion",
    "lines campaigns",
    f""", bought AS (
        SELECT * FROM lines WHERE customer_email IN (SELECT 'customer' || c_custkey || '@example.com' FROM customer
                                                     WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD')))
    SELECT campaign_id, campaign_name, sent_at, recipients, open_rate, click_rate, revenue AS klaviyo_revenue,
           count(DISTINCT order_id) AS shopify_orders, {big('sum(total_price)')} AS shopify_revenue,
           {pct('count(DISTINCT order_id)', 'recipients', 2)} AS purchase_rate_pct
    FROM campaigns LEFT JOIN bought ON order_date - sent_at::DATE BETWEEN 0 AND 7
    GROUP BY campaign_id, campaign_name, sent_at, recipients, open_rate, click_rate, revenue""",
)

sql(
    "ec_sku_trend",
    "lines costs",
    f""", months AS (
        SELECT date_trunc('month', order_date)::DATE AS year_month, l.sku, min(sku_title) AS sku_title,
               {big('sum(quantity)')} AS units_sold, {big('sum(total_price)')} AS revenue,
               count(DISTINCT customer_email) AS unique_customers,
               {big('sum(coalesce(cost_price, 0) * quantity)')} AS total_cost
        FROM lines l LEFT JOIN costs c ON c.sku = l.sku AND order_date BETWEEN c.valid_from AND c.valid_to GROUP BY ALL),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY year_month) AS n FROM months),
    wide AS (
        SELECT a.*, b.revenue AS r1, y.revenue AS r12,
               (SELECT {div('sum(p.revenue)', 'count(*)')} FROM numbered p
                WHERE p.sku = a.sku AND p.n BETWEEN a.n - 3 AND a.n - 1) AS usual
        FROM numbered a LEFT JOIN numbered b ON b.sku = a.sku AND b.n = a.n - 1
        LEFT JOIN numbered y ON y.sku = a.sku AND y.n = a.n - 12)
    SELECT year_month, sku, sku_title, units_sold, revenue, unique_customers, total_cost,
           CASE WHEN total_cost > 0 THEN revenue - total_cost END AS gross_profit,
           {pct('revenue - r1', 'r1')} AS mom_growth_pct, {pct('revenue - r12', 'r12')} AS yoy_growth_pct,
           CASE WHEN usual IS NULL THEN 'unknown' WHEN revenue >= usual * 1.2::DOUBLE THEN 'rising'
                WHEN revenue <= usual * 0.8::DOUBLE THEN 'declining' ELSE 'stable' END AS trend_class
    FROM wide""",
)

sql(
    "ec_inventory_health",
    "lines stock",
    f""", sold AS (
        SELECT sku, {', '.join(f"{big(f'sum(quantity) FILTER (age <= {n})')} AS s{n}" for n in (7, 30, 90))}
        FROM (SELECT sku, quantity, DATE '2001-08-01' - order_date AS age FROM lines) GROUP BY sku),
    facts AS (
        SELECT stock.*, s7, s30, s90, available::DOUBLE / (nullif(s7, 0)::DOUBLE / 7::DOUBLE) AS cover
        FROM stock LEFT JOIN sold USING (sku)
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM stock) AND stock.sku IS NOT NULL)
    SELECT snapshot_date, sku, item_name, quantity AS total_quantity, available, backordered, processing, shipping,
           coalesce(s7, 0) AS sold_7d, coalesce(s30, 0) AS sold_30d, coalesce(s90, 0) AS sold_90d,
           {rnd('cover', 1)} AS days_of_stock, {pct('s30', 'available')} AS turnover_30d_pct,
           CASE WHEN coalesce(available, 0) <= 0 THEN 'stockout' WHEN coalesce(s90, 0) = 0 THEN 'no_recent_sales'
                WHEN cover IS NULL THEN 'healthy' WHEN cover < 7 THEN 'at_risk_7d' WHEN cover < 14 THEN 'at_risk_14d'
                WHEN cover < 90 THEN 'healthy' ELSE 'overstock' END AS status
    FROM facts""",
)

sql(
    "ec_storage_cost_estimated",
    "stock sizes rates",
    f"""
    SELECT snapshot_date, stock.sku, item_name, quantity AS stock_qty, sizes.size AS size_category,
           daily::DOUBLE AS daily_rate_yen, monthly::BIGINT AS monthly_rate_yen,
           {rnd('quantity * daily::DOUBLE', 2)} AS estimated_daily_cost_yen,
           (quantity * monthly)::DOUBLE AS estimated_monthly_cost_yen
    FROM stock
    LEFT JOIN sizes ON sizes.sku = stock.sku AND snapshot_date BETWEEN sizes.a AND sizes.b
    LEFT JOIN rates ON rates.size = sizes.size AND snapshot_date BETWEEN rates.a::DATE AND rates.b::DATE
    WHERE stock.sku IS NOT NULL""",
)

# ------------------------------------------------------------------ search

_AOV = f"""(SELECT {rnd(div('sum(total_price)', 'count(*)'))} FROM lines WHERE order_date >= DATE '2001-07-02')"""

sql(
    "ec_search_to_purchase",
    "lines history",
    f""", seen AS (
        SELECT date_trunc('month', day)::DATE AS m, query, nullif(regexp_extract(url, '^https?://[^/]+(/.*)$', 1), '') AS path,
               {big('sum(clicks)')} AS clicks, {big('sum(impressions)')} AS impressions,
               {div('sum(position * impressions)', 'sum(impressions)')} AS position
        FROM history GROUP BY ALL),
    landed AS (
        SELECT date_trunc('month', order_date)::DATE AS m, nullif(split_part(landing_site, '?', 1), '') AS path,
               count(DISTINCT order_id) AS orders, {big('sum(total_price)')} AS revenue
        FROM lines WHERE landing_site IS NOT NULL GROUP BY ALL),
    joined AS (
        SELECT seen.*, {big('coalesce(sum(orders), 0)')} AS o, {big('coalesce(sum(revenue), 0)')} AS r
        FROM seen LEFT JOIN landed ON seen.m = landed.m AND starts_with(landed.path, seen.path) GROUP BY ALL)
    SELECT m AS year_month, query AS sc_query, path AS sc_path, clicks AS sc_clicks, impressions AS sc_impressions,
           {rnd('position', 1)} AS sc_avg_position, o AS matched_orders, r AS matched_revenue,
           {pct('o', 'clicks', 2)} AS conversion_rate_pct, {rnd(div('r', 'clicks'))} AS revenue_per_click
    FROM joined""",
)

sql(
    "ec_seo_opportunity",
    "lines history keywords",
    f""", now AS (
        SELECT query, sum(clicks) AS clicks, {div('sum(position * impressions)', 'sum(impressions)')} AS position
        FROM history WHERE DATE '2001-08-01' - day <= 30 GROUP BY query),
    old AS (
        SELECT query, sum(clicks) AS clicks, {div('sum(position * impressions)', 'sum(impressions)')} AS position
        FROM history WHERE DATE '2001-08-01' - day BETWEEN 335 AND 365 GROUP BY query),
    tool AS (
        SELECT keyword, max(volume) AS volume, max(difficulty) AS difficulty, max(cpc) AS cpc FROM keywords
        WHERE target = '{OWN_URL}' AND DATE '2001-08-01' - fetched <= 30 GROUP BY keyword),
    merged AS (
        SELECT now.query AS known, tool.*, now.clicks AS c, coalesce(now.clicks, 0) AS c0, coalesce(old.clicks, 0) AS b,
               now.position AS p, old.position AS q
        FROM now FULL JOIN old ON now.query = old.query LEFT JOIN tool ON tool.keyword = coalesce(now.query, old.query))
    SELECT coalesce(known, keyword) AS keyword, volume AS search_volume, difficulty AS seo_difficulty, cpc,
           {big('c0')} AS sc_recent_clicks, {big('b')} AS sc_baseline_clicks, {big('b - c0')} AS click_decline,
           {rnd('p', 1)} AS sc_recent_position, {rnd('q', 1)} AS sc_baseline_position,
           CASE WHEN c IS NULL AND coalesce(volume, 0) > 0 THEN 'new_opportunity' WHEN b - c0 >= 100 THEN 'declining_loss'
                WHEN b - c0 >= 30 THEN 'declining_minor' WHEN p <= 3 AND c < volume * 0.02::DOUBLE THEN 'top3_low_ctr'
                WHEN c > b THEN 'growing' ELSE 'stable' END AS opportunity_type,
           {rnd(f'greatest(b - c0, 0)::DOUBLE * 0.015::DOUBLE * {_AOV}')} AS estimated_monthly_loss_yen
    FROM merged""",
)

sql(
    "ec_competitor_gap",
    "lines keywords",
    f""", fresh AS (SELECT * FROM keywords WHERE fetched = (SELECT max(fetched) FROM keywords)),
    theirs AS (
        SELECT keyword, max(volume) AS v, max(difficulty) AS d, max(cpc) AS cpc,
               list_sort(list_distinct(list(split_part(target, '/', 3)))) AS hosts
        FROM fresh WHERE target <> '{OWN_URL}' GROUP BY keyword)
    SELECT keyword, v AS search_volume, d AS seo_difficulty, cpc, len(hosts)::BIGINT AS competitor_count,
           array_to_string(hosts, ',') AS competitors,
           {rnd(f'v::DOUBLE * 0.1::DOUBLE * 0.015::DOUBLE * {_AOV}')} AS estimated_monthly_opportunity_yen
    FROM theirs WHERE keyword NOT IN (SELECT keyword FROM fresh WHERE target = '{OWN_URL}')
      AND v BETWEEN 100 AND 30000 AND d IS NOT NULL AND len(hosts) > 1""",
)

sql(
    "search_monthly_trend",
    "history",
    f"""
    SELECT date_trunc('month', day)::DATE AS month, {big('sum(clicks)')} AS clicks, {big('sum(impressions)')} AS impressions,
           {pct('sum(clicks)', 'sum(impressions)', 2)} AS ctr_pct,
           {rnd(div('sum(position * impressions)', 'sum(impressions)'), 1)} AS avg_position,
           count(DISTINCT query) AS unique_queries
    FROM history GROUP BY ALL""",
)


def _band(cond: str) -> str:
    return pct(f"sum(clicks) FILTER ({cond})", f"sum(impressions) FILTER ({cond})", 2)


sql(
    "search_ctr_by_position_band",
    "history",
    f"""
    SELECT date_trunc('month', day)::DATE AS month, {_band('position <= 3')} AS top3_ctr_pct,
           {_band('position > 3 AND position <= 10')} AS pos4_10_ctr_pct, {_band('position > 10')} AS pos11_plus_ctr_pct,
           {big('coalesce(sum(impressions) FILTER (position <= 3), 0)')} AS top3_impressions
    FROM history GROUP BY ALL""",
)
sql(
    "search_brand_share",
    "history",
    f"""
    SELECT *, {pct('brand_clicks', 'brand_clicks + non_brand_clicks')} AS brand_share_pct FROM (
        SELECT date_trunc('month', day)::DATE AS month,
               {big(f"coalesce(sum(clicks) FILTER (regexp_matches(query, '{BRAND_PATTERN}')), 0)")} AS brand_clicks,
               {big(f"coalesce(sum(clicks) FILTER (NOT regexp_matches(query, '{BRAND_PATTERN}')), 0)")} AS non_brand_clicks
        FROM history GROUP BY ALL)""",
)

_PAIRED = f""", spans(which, a, b) AS (VALUES ('old', DATE '2000-07-01', DATE '2000-12-31'),
                                             ('new', DATE '2001-02-01', DATE '2001-07-31')),
    tall AS (
        SELECT {{item}} AS item, which, {big('sum(clicks)')} AS clicks,
               {div('sum(position * impressions)', 'sum(impressions)')} AS position
        FROM history JOIN spans ON day BETWEEN a AND b GROUP BY ALL),
    pairs AS (
        SELECT item, coalesce(max(clicks) FILTER (which = 'old'), 0) AS o, coalesce(max(clicks) FILTER (which = 'new'), 0) AS n,
               max(position) FILTER (which = 'old') AS po, max(position) FILTER (which = 'new') AS pn
        FROM tall GROUP BY item)"""
sql(
    "search_query_decline",
    "history",
    _PAIRED.format(item="query")
    + f""" SELECT item AS query, o AS old_clicks, n AS new_clicks, n - o AS click_diff,
           {rnd('po', 1)} AS old_position, {rnd('pn', 1)} AS new_position FROM pairs ORDER BY n - o, item LIMIT 20""",
)
sql(
    "search_page_decline",
    "history",
    _PAIRED.format(item="'/' || split_part(url, '/', 4) || '/' || split_part(url, '/', 5)")
    + f""" SELECT item AS page, o AS old_clicks, n AS new_clicks, {pct('n - o', 'o', 0)} AS change_pct
           FROM pairs ORDER BY n - o, item LIMIT 15""",
)
sql(
    "search_query_survival",
    "history",
    _PAIRED.format(item="query")
    + """ SELECT count(*) FILTER (o >= 50 AND n < 5) AS lost_50_to_5, count(*) FILTER (o >= 100 AND n < 10) AS lost_100_to_10,
           count(*) FILTER (o >= 500 AND n < 50) AS lost_500_to_50, count(*) FILTER (o >= 50 AND 2 * n >= o) AS kept_half,
           count(*) FILTER (o = 0 AND n >= 50) AS gained_50 FROM pairs""",
)

# ------------------------------------------------------------------ leasing


def jst(ts: str) -> str:
    return f"({ts} + INTERVAL 9 HOUR)::DATE"


sql(
    "re_case_pipeline",
    "deals",
    f"""
    SELECT status, count(*) AS deal_count, {big('sum(coalesce(rent, 0))')} AS total_proposed_rent_yen,
           {rnd(div(f"sum(DATE '2001-08-01' - {jst('created_at')})", 'count(*)'), 1)} AS avg_age_days,
           count(DISTINCT assignee) AS distinct_assignees,
           string_agg(DISTINCT assignee::VARCHAR, ',' ORDER BY assignee::VARCHAR) AS assigned_user_ids
    FROM deals WHERE status <> 'CONTRACTED' AND status <> 'LOST' GROUP BY status""",
)

_FUNNEL = f""", ticks AS (
        SELECT day, 'clicks' AS what, clicks AS n FROM traffic UNION ALL
        SELECT day, 'impressions', impressions FROM traffic UNION ALL
        SELECT {jst('created_at')}, 'inquiries', 1 FROM tenants UNION ALL
        SELECT {jst('created_at')}, 'new', 1 FROM deals UNION ALL
        SELECT {jst('updated_at')}, status, 1 FROM deals WHERE status IN ('CONTRACTED', 'LOST')),
    span AS (SELECT unnest(range(366))::INTEGER AS i),
    filled AS (
        SELECT (DATE '2001-08-01' - i)::DATE AS date,
               {', '.join(f"{big(f'coalesce(sum(n) FILTER (what = {w!r}), 0)')} AS {a}" for w, a in (('clicks', 'organic_clicks'), ('impressions', 'organic_impressions'), ('inquiries', 'inquiry_count'), ('new', 'new_deal_count'), ('CONTRACTED', 'won_count'), ('LOST', 'lost_count')))}
        FROM span LEFT JOIN ticks ON day = DATE '2001-08-01' - i GROUP BY i)"""
sql(
    "re_lead_funnel",
    "export tenants deals",
    _FUNNEL
    + f""" SELECT *, {pct('inquiry_count', 'organic_clicks', 2)} AS click_to_inquiry_pct,
           {pct('new_deal_count', 'inquiry_count', 2)} AS inquiry_to_deal_pct,
           {pct('won_count', 'new_deal_count', 2)} AS deal_win_pct FROM filled""",
)
_WEEKS = (
    _FUNNEL
    + f""", weeks AS (
        SELECT date_trunc('week', date)::DATE AS w, {big('sum(organic_clicks)')} AS c, {big('sum(inquiry_count)')} AS i,
               {big('sum(new_deal_count)')} AS d, {big('sum(won_count)')} AS won, {big('sum(lost_count)')} AS lost
        FROM filled GROUP BY ALL),
    compared AS (
        SELECT a.w AS week_start, a.c AS organic_clicks, a.i AS inquiries, a.d AS new_deals, a.won, a.lost,
               {pct('a.c - b.c', 'b.c')} AS clicks_wow_pct, {pct('a.i - b.i', 'b.i')} AS inquiries_wow_pct,
               {pct('a.d - b.d', 'b.d')} AS new_deals_wow_pct, {pct('a.won - b.won', 'b.won')} AS won_wow_pct
        FROM weeks a LEFT JOIN weeks b ON b.w = a.w - 7)"""
)
sql("re_weekly_summary", "export tenants deals", _WEEKS + " SELECT * FROM compared")

sql(
    "re_property_performance",
    "deals",
    f""", shown AS (SELECT user_id AS id, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY ALL),
    homes AS (
        SELECT *, TIMESTAMP '2001-08-01 03:00:00' - to_hours(p_partkey * 11 % 20000) AS listed FROM part)
    SELECT p_partkey AS property_id, p_name AS property_name, p_type AS property_type, p_brand AS listing_status,
           (floor(p_retailprice) * 100)::BIGINT AS rent_amount, p_partkey % 97 AS owner_id, count(d.id) AS total_deals,
           count(*) FILTER (status = 'CONTRACTED') AS won_deals, count(*) FILTER (status = 'LOST') AS lost_deals,
           count(*) FILTER (status NOT IN ('CONTRACTED', 'LOST')) AS active_deals,
           {rnd(div("sum(d.updated_at::DATE - d.created_at::DATE) FILTER (status = 'CONTRACTED')", "count(*) FILTER (status = 'CONTRACTED')"), 1)} AS avg_lead_time_days,
           coalesce(max(shown.n), 0) AS total_viewings,
           {pct("count(*) FILTER (status = 'CONTRACTED')", 'count(d.id)')} AS win_rate_pct,
           (DATE '2001-08-01' - {jst('listed')})::BIGINT AS days_listed
    FROM homes LEFT JOIN deals d ON d.property_id = p_partkey LEFT JOIN shown ON shown.id = p_partkey
    GROUP BY p_partkey, p_name, p_type, p_brand, p_retailprice, listed""",
)

sql(
    "re_seo_inquiry_attribution",
    "export tenants",
    f""", best AS (
        SELECT page, query, {big('sum(clicks)')} AS c, {big('sum(impressions)')} AS i,
               {div('sum(clicks * position)', 'sum(clicks)')} AS p
        FROM traffic WHERE DATE '2001-08-01' - day <= 30 GROUP BY ALL)
    SELECT page, query, c AS sc_clicks_30d, i AS sc_impressions_30d, {rnd('p', 1)} AS avg_position,
           (SELECT count(*) FROM tenants WHERE created_at >= TIMESTAMP '2001-07-02 03:00:00'
            AND regexp_matches(lower(source), 'web|search|seo|hp')) AS total_web_inquiries_30d
    FROM best WHERE c > 0 ORDER BY c DESC, page, query LIMIT 200""",
)

# ------------------------------------------------------------------ both businesses, planned reports

sql(
    "all_revenue_summary",
    "lines export tenants deals",
    _WEEKS
    + f""", shop AS ({_WEEKLY.format(source='lines')})
    SELECT *, 'ec' AS business FROM shop UNION ALL BY NAME SELECT *, 're' AS business FROM compared""",
)
sql(
    "ec_ad_performance",
    "tagged paid found ads",
    _ROI
    + f""", delivered AS (
        SELECT channel, date_trunc('week', day)::DATE AS week_start, {big('sum(impressions)')} AS impressions,
               {big('sum(clicks)')} AS clicks, {big('sum(cost)')} AS cost, sum(conversions) AS conversions
        FROM ads WHERE channel IS NOT NULL GROUP BY ALL),
    earned AS (
        SELECT channel, date_trunc('week', date)::DATE AS week_start, {big('sum(orders)')} AS orders, {big('sum(revenue)')} AS revenue
        FROM roi WHERE channel IN (SELECT channel FROM ads) GROUP BY ALL)
    SELECT *, {pct('clicks', 'impressions', 2)} AS ctr_pct, {rnd(div('revenue', 'cost'), 2)} AS roas
    FROM delivered FULL JOIN earned USING (channel, week_start)""",
)
sql(
    "ec_refund_analysis_by_sku",
    "tagged paid found",
    f"""SELECT channel, sku, count(*) AS lines, count(*) FILTER (is_refunded) AS refunds,
           {pct('count(*) FILTER (is_refunded)', 'count(*)')} AS refund_rate_pct
    FROM {labelled('roi', raw_organic=False)} GROUP BY ALL""",
)
sql(
    "ec_refund_analysis_roas",
    "tagged paid found ads",
    f""", sales AS (
        SELECT channel, {big('sum(total_price)')} AS revenue, {big('coalesce(sum(refund_amount), 0)')} AS refund_amount
        FROM {labelled('roi', raw_organic=False)} GROUP BY ALL),
    spend AS (SELECT channel, {big('sum(cost)')} AS ad_cost FROM ads WHERE channel IS NOT NULL GROUP BY ALL)
    SELECT *, {rnd(div('revenue - refund_amount', 'ad_cost'), 2)} AS effective_roas FROM sales FULL JOIN spend USING (channel)""",
)

# ------------------------------------------------------------------ quality

sql(
    "quality_duplicate_keys",
    "lines",
    "SELECT order_id, line_item_id, count(*) AS copies FROM lines GROUP BY ALL HAVING count(*) > 1",
)
sql(
    "quality_overlapping_periods",
    "",
    """tags AS (SELECT DISTINCT l_partkey::VARCHAR AS sku, l_shipdate::DATE AS day FROM lineitem)
    SELECT sku, day AS valid_from, (day + 29)::DATE AS valid_to FROM tags a
    WHERE EXISTS (SELECT 1 FROM tags b WHERE b.sku = a.sku AND a.day - b.day BETWEEN 1 AND 29)""",
)
sql(
    "quality_missing_required",
    "lines",
    "SELECT c AS column_name, n AS null_rows FROM (SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ("order_id", "landing_site", "referring_site", "utm_source", "refund_amount")
    )
    + " FROM lines) UNPIVOT (n FOR c IN (order_id, landing_site, referring_site, utm_source, refund_amount))",
)
sql(
    "quality_skus_without_size",
    "sizes",
    "SELECT DISTINCT l_partkey::VARCHAR AS sku FROM lineitem WHERE l_partkey::VARCHAR NOT IN (SELECT sku FROM sizes)",
)
sql(
    "yearly_orders",
    "",
    """y AS (SELECT year(o_orderdate) AS year, o_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT year, count(*) AS line_rows, count(DISTINCT o_orderkey) AS orders FROM y GROUP BY ALL""",
)
sql(
    "quality_stock_without_cost",
    "stock",
    """SELECT DISTINCT sku FROM stock WHERE sku IS NOT NULL AND sku NOT IN (
        SELECT l_partkey::VARCHAR FROM lineitem WHERE DATE '2001-08-01' - l_shipdate::DATE BETWEEN 0 AND 59)""",
)
sql(
    "quality_overlapping_rules",
    "",
    """n AS (
        SELECT (DATE '2015-01-01' + (n_nationkey * 90)::INTEGER)::DATE AS a, (a + (n_nationkey % 7 * 30)::INTEGER)::DATE AS b,
               900 + n_nationkey * 10 AS fee FROM nation),
    rules AS (
        SELECT *, row_number() OVER (ORDER BY a, b, fee) AS i
        FROM (SELECT DATE '2020-01-01' AS a, DATE '2099-12-31' AS b, 1000 AS fee
              UNION ALL SELECT * FROM n UNION ALL SELECT * FROM n WHERE fee % 50 = 0))
    SELECT a AS valid_from, b AS valid_to, fee::BIGINT AS shipping_fee_per_order FROM rules x
    WHERE EXISTS (SELECT 1 FROM rules y WHERE y.i < x.i AND y.b >= x.a)""",
)

# ------------------------------------------------------------------ each order once, and the stamp of the run

_ONCE = "lines AS (SELECT * FROM every_line QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY inserted_at DESC, is_refunded DESC) = 1)"
ORACLE["ec_channel_roi_per_order"] = (
    ORACLE["ec_channel_roi"].replace("lines AS (", "every_line AS (", 1).replace("tagged AS (", f"{_ONCE},\ntagged AS (", 1)
)
ORACLE["ec_cohort_ltv_per_order"] = (
    ORACLE["ec_cohort_ltv"].replace("lines AS (", "every_line AS (", 1).replace(", months AS (", f", {_ONCE}, months AS (", 1)
)
ORACLE["ec_customer_profile_per_order"] = f"""
    SELECT p.* REPLACE (t.revenue AS total_revenue, {rnd(div('t.revenue', 't.n'))} AS avg_order_value)
    FROM ({ORACLE['ec_customer_profile']}) p
    JOIN (SELECT 'customer' || o_custkey || '@example.com' AS customer_email, {big('sum(round(o_totalprice))')} AS revenue, count(*) AS n
          FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL) t USING (customer_email)"""

_STAMPED = (
    "ec_cohort_ltv", "ec_repeat_pattern", "ec_customer_profile", "ec_attribution_first_last", "ec_sku_trend", "ec_inventory_health",
    "ec_storage_cost_estimated", "ec_search_to_purchase", "ec_seo_opportunity", "ec_competitor_gap", "re_case_pipeline",
    "re_lead_funnel", "re_property_performance", "re_seo_inquiry_attribution", "re_weekly_summary",
)

# ------------------------------------------------------------------ order of rows

for _name, _of, _order in (
    ("ordered_repeat_pattern", "ec_repeat_pattern", "order_index"),
    ("ordered_storage_cost", "ec_storage_cost_estimated", "snapshot_date DESC, estimated_daily_cost_yen DESC NULLS LAST, sku"),
    ("ordered_case_pipeline", "re_case_pipeline", f"list_position({list(DEAL_STATES)}, status)"),
    ("ordered_weekly_summaries", "ec_weekly_summary", "week_start DESC"),
    ("ordered_competitor_gap", "ec_competitor_gap", "search_volume DESC, competitor_count DESC, keyword"),
    ("ordered_lead_funnel", "re_lead_funnel", "date"),
    ("ordered_property_performance", "re_property_performance", "total_deals DESC, days_listed DESC, property_id"),
    ("ordered_leasing_weeks", "re_weekly_summary", "week_start"),
):
    ORACLE[_name] = f"SELECT *, row_number() OVER (ORDER BY {_order}) AS position FROM ({ORACLE[_of]})"

for _name in _STAMPED:
    ORACLE[_name] = f"SELECT *, TIMESTAMP '2001-08-01 03:00:00' AS generated_at FROM ({ORACLE[_name]})"
