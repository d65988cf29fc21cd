"""Building blocks of the check SQL: the given tables in the shapes of martloom.sources.given, for DuckDB."""

from __future__ import annotations

from martloom.sources.given import BRANDS, DEAL_STATES, OWN_URL, RIVAL_URLS, STORAGE_RATES, VISIT_FIELDS, VISITS


def _lit(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


_numbered_visits = [(i, *row) for i, row in enumerate(VISITS)]

PARTS = {
    "visit": f"visit(k, {', '.join(VISIT_FIELDS)}) AS (VALUES {_values(_numbered_visits)})",
    # order lines
    "lines": """lines AS (
        SELECT o_orderkey::VARCHAR AS order_id, o_orderdate::DATE AS order_date, o_orderdate AS created_at,
               o_custkey::VARCHAR AS customer_id, 'customer' || o_custkey || '@example.com' AS customer_email,
               round(o_totalprice)::BIGINT AS total_price, l_orderkey || '-' || l_linenumber AS line_item_id,
               l_partkey::VARCHAR AS sku, 'Part ' || l_partkey AS sku_title, l_quantity::BIGINT AS quantity,
               floor(l_extendedprice)::BIGINT AS unit_price, l_returnflag = 'R' AS is_refunded,
               CASE WHEN l_returnflag = 'R' THEN floor(o_totalprice * 0.5::DOUBLE)::BIGINT END AS refund_amount,
               v.landing_site::VARCHAR AS landing_site, v.referring_site::VARCHAR AS referring_site,
               v.utm_source::VARCHAR AS utm_source, v.utm_medium::VARCHAR AS utm_medium,
               v.utm_campaign::VARCHAR AS utm_campaign,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'ギフト設定,vip' WHEN '2-HIGH' THEN 'vip' END AS tags,
               l_shipdate AS inserted_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN visit v ON v.k = o_orderkey % 24)""",
    # lines with the tags resolved from the landing page, and the paid channel of a (source, medium) pair
    "tagged": """tagged AS (
        SELECT *, coalesce(utm_source, nullif(regexp_extract(landing_site, '[?&]utm_source=([^&]+)', 1), '')) AS src,
                  coalesce(utm_medium, nullif(regexp_extract(landing_site, '[?&]utm_medium=([^&]+)', 1), '')) AS med,
                  coalesce(utm_campaign, nullif(regexp_extract(landing_site, '[?&]utm_campaign=([^&]+)', 1), '')) AS camp
        FROM lines)""",
    "paid": """paid AS (
        SELECT rules, label, unnest(sources) AS src, mediums FROM (VALUES
          ('roi', 'google_paid', ['google'], ['cpc', 'paid', 'paidsearch', 'ppc', 'dg']),
          ('roi', 'meta_paid', ['facebook', 'instagram', 'meta'], ['cpc', 'paid']),
          ('roi', 'yahoo_paid', ['yahoo'], ['cpc', 'paid']),
          ('roi', 'microsoft_paid', ['bing', 'microsoft'], ['cpc', 'paid']),
          ('customer', 'google_paid', ['google'], ['cpc', 'paid', 'paidsearch', 'ppc', 'dg', 'pmx']),
          ('customer', 'meta_paid', ['facebook', 'fb', 'instagram', 'ig', 'meta', 'ig.me'], ['cpc', 'paid', 'social', 'organic_social']),
          ('customer', 'yahoo_paid', ['yahoo'], ['cpc', 'paid', 'dsa']),
          ('customer', 'microsoft_paid', ['bing', 'microsoft'], ['cpc', 'paid']),
          ('basic', 'google_paid', ['google'], ['cpc', 'paid', 'paidsearch', 'ppc']),
          ('basic', 'meta_paid', ['facebook', 'instagram'], ['cpc', 'paid']),
          ('basic', 'yahoo_paid', ['yahoo'], ['cpc', 'paid']),
          ('basic', 'microsoft_paid', ['bing', 'microsoft'], ['cpc', 'paid'])) t(rules, label, sources, mediums)),
    paid_pair AS (SELECT rules, label, src, unnest(mediums) AS med FROM paid)""",
    "found": """found(variant, place, host, label) AS (VALUES
        ('roi', 1, 'instagram.com', 'instagram_organic'), ('roi', 2, 'google.com', 'seo_google'),
        ('roi', 3, 'yahoo.co.jp', 'seo_yahoo'), ('roi', 4, 'youtube.com', 'social_youtube'),
        ('customer', 1, 'instagram.com', 'instagram_organic'), ('customer', 2, 'google.com', 'seo_google'),
        ('customer', 3, 'yahoo.co.jp', 'seo_yahoo'), ('customer', 4, 'bing.com', 'seo_bing'),
        ('customer', 5, 'youtube.com', 'social_youtube'),
        ('basic', 1, 'instagram.com', 'instagram_organic'), ('basic', 2, 'google.com', 'seo_google'),
        ('basic', 3, 'yahoo.co.jp', 'seo_yahoo'))""",
    "costs": """sightings AS (
        SELECT DISTINCT l_partkey::VARCHAR AS sku, l_shipdate::DATE AS day,
               (floor(p_retailprice) + 50 * (year(l_shipdate) % 2))::BIGINT AS price
        FROM lineitem JOIN part ON l_partkey = p_partkey),
    flagged AS (
        SELECT *, CASE WHEN price IS DISTINCT FROM lag(price) OVER (PARTITION BY sku ORDER BY day) THEN 1 ELSE 0 END AS starts
        FROM sightings),
    grouped AS (SELECT *, sum(starts) OVER (PARTITION BY sku ORDER BY day) AS run FROM flagged),
    runs AS (SELECT sku, run, any_value(price) AS price, min(day) AS day FROM grouped GROUP BY sku, run),
    costs AS (
        SELECT sku, price AS cost_price,
               CASE WHEN run = 1 THEN DATE '1990-01-01' ELSE day END AS valid_from,
               coalesce(lead(day) OVER (PARTITION BY sku ORDER BY run) - 1, DATE '2099-12-31')::DATE AS valid_to
        FROM runs)""",
    "rules": """rules(valid_from, valid_to, fee) AS (VALUES (DATE '1990-01-01', DATE '1998-12-31', 900),
        (DATE '1999-01-01', DATE '2099-12-31', 1000))""",
    "ads": """ads AS (
        SELECT CASE WHEN l_returnflag = 'R' THEN 'google_paid' WHEN l_returnflag = 'A' THEN 'meta_paid'
                    WHEN l_linestatus = 'O' THEN 'yahoo_paid' WHEN l_linestatus = 'F' THEN 'microsoft_paid' END AS channel,
               l_shipdate::DATE AS day, l_suppkey::VARCHAR AS campaign_id, l_quantity::BIGINT AS clicks,
               (l_quantity * 20)::BIGINT AS impressions, round(l_tax * l_extendedprice)::BIGINT AS cost,
               floor(l_discount * 100 + 0.5::DOUBLE) AS conversions
        FROM lineitem)""",
    "campaigns": """campaigns AS (
        SELECT 'c' || s_suppkey AS campaign_id, s_name AS campaign_name,
               CASE WHEN s_acctbal >= 0 THEN TIMESTAMP '1995-01-10' + to_days((s_suppkey * 23 % 2380)::INTEGER)
                    + to_hours(s_suppkey % 24) END AS sent_at,
               s_suppkey + 500 AS recipients, s_suppkey % 8 / 8.0::DOUBLE AS open_rate,
               s_suppkey % 16 / 16.0::DOUBLE AS click_rate, s_suppkey * 100 AS revenue
        FROM supplier)""",
    "stock": """stock AS (
        SELECT day::DATE AS snapshot_date, CASE WHEN p_type <> 'MEDIUM' THEN p_partkey::VARCHAR END AS sku, p_name AS item_name,
               p_size::BIGINT AS quantity, CASE WHEN p_type <> 'PROMO' THEN (p_size - 5)::BIGINT END AS available,
               (p_size % 3)::BIGINT AS backordered, (p_size % 4)::BIGINT AS processing, (p_size % 5)::BIGINT AS shipping
        FROM part, (VALUES (DATE '2001-07-30'), (DATE '2001-07-31'), (DATE '2001-08-01')) d(day))""",
    "sizes": """sizes AS (
        SELECT p_partkey::VARCHAR AS sku, DATE '1990-01-01' AS a, DATE '2001-07-30' AS b,
               CASE WHEN p_size < 15 THEN '60' WHEN p_size < 30 THEN '80' ELSE '100' END AS size
        FROM part WHERE p_type <> 'LARGE'
        UNION ALL
        SELECT p_partkey::VARCHAR, DATE '2001-07-31', DATE '9999-12-31',
               CASE WHEN p_size < 15 THEN '60' WHEN p_size < 35 THEN '80' WHEN p_size < 45 THEN '100' ELSE '150' END
        FROM part WHERE p_type <> 'LARGE')""",
    "rates": f"rates(size, daily, monthly, a, b) AS (VALUES {_values(STORAGE_RATES)})",
    "history": f"""history AS (
        SELECT (ts::DATE - (8217 + event_id % 14 * 28)::INTEGER)::DATE AS day, '{OWN_URL}' AS site_url,
               'https://shop.example.com/p/' || (user_id % 20) AS url,
               CASE WHEN k % 10 = 0 THEN 'acme ' ELSE 'q' END || k AS query,
               clicks, clicks + 20 + k AS impressions, floor(value / 20) + 1 AS position
        FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k,
                     CASE WHEN event_type = 'click' THEN user_id % 7 * 10 + 1 ELSE 0 END AS clicks FROM events))""",
    "keywords": f"""keywords AS (
        SELECT CASE WHEN event_type = 'signup' THEN DATE '2001-07-25' ELSE DATE '2001-08-01' END AS fetched,
               CASE WHEN k % 3 = 0 AND user_id % 7 = 0 THEN '{OWN_URL}'
                    ELSE ({list(RIVAL_URLS)})[user_id % 6 + 1] END AS target, 'q' || k AS keyword,
               CASE WHEN k % 17 <> 0 THEN k * 310 END AS volume,
               CASE WHEN k % 11 <> 5 THEN k % 50 + user_id % 9 END AS difficulty, k * 0.5::DOUBLE AS cpc
        FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events))""",
    "deals": f"""deals AS (
        SELECT o_orderkey AS id, o_custkey AS property_id,
               ({list(DEAL_STATES)})[1 + CASE o_orderstatus WHEN 'O' THEN u - 1
                    WHEN 'P' THEN CASE WHEN u <= 2 THEN 5 ELSE 6 END ELSE CASE WHEN u <= 3 THEN 7 ELSE 6 END END] AS status,
               CASE WHEN u <> 3 THEN floor(o_totalprice)::BIGINT END AS rent,
               CASE WHEN u <> 4 THEN o_orderkey % 13 END AS assignee,
               o_orderdate + to_hours(o_orderkey % 24) AS created_at, o_orderdate + to_hours(o_orderkey % 2400) AS updated_at
        FROM (SELECT *, left(o_orderpriority, 1)::INTEGER AS u FROM orders))""",
    "tenants": """tenants AS (
        SELECT c_custkey AS id, TIMESTAMP '2001-08-01 03:00:00' - to_hours(c_custkey * 7 % 12000) AS created_at,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Web form' WHEN 'FURNITURE' THEN 'SEO search'
                    WHEN 'HOUSEHOLD' THEN 'phone' WHEN 'MACHINERY' THEN 'HP referral' END AS source
        FROM customer)""",
    "export": """export AS (
        SELECT (ts::DATE - 8217)::DATE AS day, 'https://lease.example.com/b/' || (user_id % 30) AS page,
               CASE WHEN event_type <> 'error' THEN 'office ' || k END AS query, clicks,
               CASE WHEN event_type = 'signup' THEN 0 ELSE clicks + k END AS impressions, floor(value / 20) + 1 AS rank
        FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k,
                     CASE WHEN event_type = 'click' THEN user_id % 5 + 1 ELSE 0 END AS clicks FROM events)),
    traffic AS (
        SELECT day, page, query, clicks, impressions,
               (impressions * rank)::DOUBLE / nullif(impressions, 0)::DOUBLE AS position
        FROM export WHERE query IS NOT NULL)""",
}
NEEDS = {"lines": ["visit"], "tagged": ["visit", "lines"]}
BRAND_PATTERN = "|".join(BRANDS)


def with_parts(names: str, body: str) -> str:
    order: list[str] = []
    for n in names.split():
        for m in [*NEEDS.get(n, []), n]:
            if m not in order:
                order.append(m)
    if not order:
        return "WITH " + body
    return "WITH " + ",\n".join(PARTS[n] for n in order) + "\n" + body


def labelled(variant: str, raw_organic: bool = True, unknown: bool = False, resolve: bool = True, more: str = "") -> str:
    """Subquery over tagged: every line with its channel by one rule set, looked up in tables."""
    src, med = ("src", "med") if resolve else ("utm_source", "utm_medium")
    osrc, omed = ("utm_source", "utm_medium") if raw_organic else ("src", "med")
    blank = "WHEN t.landing_site IS NULL THEN 'unknown'" if unknown else ""
    return f"""(SELECT t.* {more}, CASE WHEN t.{src} = 'klaviyo' THEN 'email_klaviyo' ELSE coalesce(p.label,
            (SELECT first(f.label ORDER BY f.place) FROM found f
             WHERE f.variant = '{variant}' AND contains(t.referring_site, f.host) AND t.{omed} IS NULL),
            CASE WHEN t.referring_site IS NOT NULL OR t.{osrc} IS NOT NULL THEN 'other' {blank} ELSE 'direct' END) END AS channel
        FROM tagged t LEFT JOIN paid_pair p ON p.rules = '{variant}' AND p.src = t.{src} AND p.med = t.{med})"""
