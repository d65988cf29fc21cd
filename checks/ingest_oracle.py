"""SQL for the ingest jobs: what the payloads were made of, without the detour through JSON."""

from __future__ import annotations

from checks.oracle import ORACLE, div, rnd, sql
from checks.sql import PARTS
from martloom.sources.given import OWN_URL

PARTS["pairs"] = "pairs AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN visit v ON v.k = o_orderkey % 24)"


def param(url: str, name: str) -> str:
    query = f"regexp_extract({url}, '\\?([^#]*)', 1)"
    return f"nullif(url_decode(replace(regexp_extract({query}, '(?:^|&){name}=([^&]*)', 1), '+', ' ')), '')"


UTM = ("utm_source", "utm_medium", "utm_campaign")

_REST = f"""
    SELECT o_orderkey::VARCHAR AS order_id, '#' || o_orderkey AS order_name, o_orderdate - INTERVAL 9 HOUR AS created_at,
           o_orderdate::DATE AS order_date, CASE WHEN o_orderpriority < '4' THEN o_custkey::VARCHAR END AS customer_id,
           CASE WHEN o_orderpriority < '4' THEN '' ELSE 'guest-' END || 'customer' || o_custkey || '@example.com' AS customer_email,
           lower(o_orderstatus) AS financial_status, floor(o_totalprice + 0.5::DOUBLE)::BIGINT AS total_price,
           floor(o_totalprice)::BIGINT + 1 AS subtotal_price,
           CASE WHEN o_orderpriority NOT LIKE '2%' THEN floor(o_totalprice / 10)::BIGINT END AS total_discounts,
           CASE WHEN o_orderpriority NOT LIKE '3%' THEN floor(o_totalprice / 20)::BIGINT END AS total_tax,
           l_partkey || 'v' AS variant_id, CASE WHEN l_linestatus = 'O' THEN 'open' END AS variant_title,
           CASE WHEN o_orderpriority NOT LIKE '1%' THEN 'web' END AS source_name,
           'https://ref.example.org/' || (o_orderkey % 9) AS referring_site,
           l_orderkey || '-' || l_linenumber || '-' || x AS line_item_id, l_partkey::VARCHAR AS product_id,
           CASE WHEN x = 'a' THEN l_partkey::VARCHAR ELSE '' END AS sku, 'Part ' || l_partkey AS sku_title,
           l_quantity::BIGINT AS quantity, floor(l_extendedprice + 0.5::DOUBLE)::BIGINT AS unit_price,
           CASE WHEN x = 'a' AND l_discount > 0 THEN floor(l_extendedprice * l_discount)::BIGINT + 1 END AS line_discount,
           l_returnflag = 'R' AS is_refunded, CASE WHEN l_returnflag = 'R' THEN l_shipdate::DATE END AS refund_date,
           CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice)::BIGINT + 1 END AS refund_amount,
           CASE WHEN l_returnflag = 'R' THEN 'damaged' END AS refund_reason, landing_site::VARCHAR AS landing_site,
           {', '.join(f'{param("landing_site::VARCHAR", n)} AS {n}' for n in UTM)}, NULL::VARCHAR AS tags
    FROM pairs, (VALUES ('a'), ('b')) t(x)
    WHERE o_orderpriority < '5' AND (x = 'a' OR l_tax > 0.04::DOUBLE)"""
sql("ingest_orders_rest", "visit pairs", _REST)
sql("stream_append", "visit pairs", _REST)

sql(
    "ingest_orders_bulk",
    "",
    """first_refund AS (
        SELECT l_orderkey, l_shipdate::DATE AS d, 'part ' || l_partkey AS note FROM lineitem WHERE l_returnflag = 'R'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, note) = 1)
    SELECT o_orderkey::VARCHAR AS order_id, '#' || o_orderkey AS order_name, o_orderdate::DATE AS order_date,
           o_custkey::VARCHAR AS customer_id, 'customer' || o_custkey || '@example.com' AS customer_email,
           CASE o_orderstatus WHEN 'P' THEN NULL ELSE lower(o_orderstatus) END AS financial_status,
           (floor(o_totalprice) + floor(o_totalprice) % 2)::BIGINT AS total_price,
           l.l_orderkey || '-' || l_linenumber || '-' || l_partkey AS line_item_id, l_partkey::VARCHAR AS product_id,
           l_partkey::VARCHAR AS sku, l_quantity::BIGINT AS quantity, round_even(l_extendedprice, 0)::BIGINT AS unit_price,
           (floor(l_discount * 100 + 0.5::DOUBLE) + floor(l_discount * 100 + 0.5::DOUBLE) % 2)::BIGINT AS line_discount,
           f.d IS NOT NULL AS is_refunded, f.d AS refund_date,
           CASE WHEN f.d IS NOT NULL THEN floor(o_totalprice / 2)::BIGINT END AS refund_amount, f.note AS refund_reason,
           'a,b' AS tags, o_orderdate AS created_at, floor(o_totalprice / 3)::BIGINT AS subtotal_price,
           floor(o_totalprice / 10)::BIGINT AS total_discounts,
           CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice / 20)::BIGINT END AS total_tax,
           l_partkey || 'v' AS variant_id, 'Part ' || l_partkey AS sku_title,
           CASE WHEN l_linestatus = 'O' THEN 'open' END AS variant_title, 'web' AS source_name,
           '/p/' || (o_custkey % 9) || '?utm_source=news&utm_medium=email' AS landing_site,
           'https://ref.example.org/' AS referring_site, 'news' AS utm_source, 'email' AS utm_medium,
           NULL::VARCHAR AS utm_campaign
    FROM lineitem l JOIN orders ON l.l_orderkey = o_orderkey LEFT JOIN first_refund f ON f.l_orderkey = o_orderkey
    WHERE o_orderpriority <> '5-LOW'""",
)

sql(
    "ingest_product_snapshot",
    "",
    """v(x) AS (VALUES ('a'), ('b'))
    SELECT DATE '2001-08-01' AS fetched_date, p_partkey::VARCHAR AS product_id, p_name AS product_title,
           p_partkey || x AS variant_id, CASE x WHEN 'a' THEN p_partkey::VARCHAR END AS sku, p_type AS variant_title,
           floor(p_retailprice + 0.5::DOUBLE)::BIGINT AS price, CASE x WHEN 'a' THEN floor(p_retailprice)::BIGINT + 1 END AS cost_price,
           CASE x WHEN 'a' THEN p_partkey::VARCHAR ELSE p_partkey || 'x' END AS inventory_item_id,
           CASE x WHEN 'a' THEN 'USD' ELSE 'JPY' END AS currency
    FROM part, v""",
)
sql(
    "ingest_stock_snapshot",
    "",
    f"""i AS (SELECT *, '{{"id":' || p_partkey || ',"code":"' || p_brand || '","name":"' || p_name || '","stock":{{"quantity":'
                    || p_size || ',"available":"' || (p_size - 5) || '"}}}}' AS raw FROM part)
    SELECT DATE '2001-08-01' AS snapshot_date, p_partkey::VARCHAR AS item_id, p_brand AS sku, p_name AS item_name,
           p_size::BIGINT AS quantity, (p_size - 5)::BIGINT AS available,
           {', '.join(f'NULL::BIGINT AS {c}' for c in ('shipping', 'requesting', 'processing', 'reserved', 'backordered', 'unallocatable'))},
           raw AS raw_payload FROM i""",
)
sql(
    "ingest_keywords",
    "",
    """t(full_item) AS (VALUES (true), (false))
    SELECT DATE '2001-08-01' AS fetched_date, 'https://site' || (user_id % 7) || '.example.net/shop/' AS target_url,
           'sub_domain' AS match_type, 'site' || (user_id % 7) || '.example.net' AS domain,
           CASE WHEN full_item THEN 'kw ' || event_id ELSE '' END AS keyword, CASE WHEN full_item THEN user_id END AS search_volume,
           CASE WHEN full_item AND event_type <> 'view' THEN user_id % 9 END AS seo_difficulty,
           CASE WHEN full_item THEN value END AS cpc, NULL::DOUBLE AS competition, NULL::BIGINT AS rank, NULL::DOUBLE AS etv
    FROM events, t""",
)
sql(
    "ingest_email_campaigns",
    "",
    """s AS (
        SELECT *, s_nationkey < 20 AS known, CASE WHEN s_acctbal > 0 OR s_nationkey > 5 THEN
               TIMESTAMP '2001-01-01 00:30:00' + to_days((s_suppkey % 200)::INTEGER) + to_hours(s_suppkey % 24) END AS sent_at
        FROM supplier)
    SELECT 'c' || s_suppkey AS campaign_id, s_name AS campaign_name, sent_at, dayname(sent_at) AS sent_day_of_week,
           hour(sent_at) AS sent_hour, CASE WHEN known THEN s_suppkey * 6 END AS recipients,
           CASE WHEN known THEN s_suppkey * CASE WHEN s_suppkey % 2 = 0 THEN 6 ELSE 3 END END AS opens,
           CASE WHEN known THEN s_suppkey % 4 / 4.0::DOUBLE END AS open_rate, NULL::BIGINT AS clicks, NULL::DOUBLE AS click_rate,
           NULL::BIGINT AS conversions, CASE WHEN known THEN s_suppkey * 6 + 1 END AS revenue, NULL::BIGINT AS unsubscribes
    FROM s""",
)
sql(
    "ingest_email_profiles",
    "",
    """p AS (SELECT *, TIMESTAMP '2000-01-01 01:02:03' + to_days((c_custkey % 500)::INTEGER) AS born FROM customer)
    SELECT c_custkey::VARCHAR AS profile_id, c_name || '@example.com' AS email, NULL::VARCHAR AS first_name, c_name AS last_name,
           floor(c_acctbal + 0.5::DOUBLE)::BIGINT AS total_revenue, born AS created_at,
           CASE WHEN c_nationkey > 10 THEN TIMESTAMP '2001-01-01' WHEN c_nationkey > 5 THEN TIMESTAMP '2001-03-01' ELSE born END AS updated_at
    FROM p WHERE c_mktsegment <> 'MACHINERY'""",
)
sql(
    "ingest_social_posts",
    "",
    f"""p AS (SELECT *, p_partkey % 50 AS seen FROM part WHERE p_type <> 'LARGE')
    SELECT p_partkey::VARCHAR AS post_id, DATE '2001-08-01' AS date, 'https://social.example.com/' || p_partkey AS post_url,
           p_type AS media_type, TIMESTAMP '2001-07-30 10:00:00' AS posted_at, p_partkey + 7 AS impressions, seen AS reach,
           p_size::BIGINT AS likes, NULL::BIGINT AS comments, CASE WHEN p_size > 10 THEN p_size::BIGINT END AS saves,
           {rnd(div('p_size', 'seen'), 6)} AS engagement_rate FROM p""",
)
sql(
    "ingest_search_rows",
    "",
    f"""e AS (SELECT * FROM events)
    SELECT ts::DATE AS data_date, '{OWN_URL}' AS site_url, '{OWN_URL}p/' || user_id AS url, props AS query,
           CASE WHEN event_type = 'click' THEN 1 ELSE 0 END::BIGINT AS clicks, user_id AS impressions, 0.0::DOUBLE AS ctr,
           value AS position FROM e""",
)
sql(
    "ingest_ad_report",
    "",
    """r AS (SELECT * FROM lineitem WHERE l_returnflag <> 'A')
    SELECT l_shipdate::DATE AS date, l_suppkey::VARCHAR AS campaign_id, 'camp, ' || l_suppkey AS campaign_name,
           'display' AS campaign_type, NULL::VARCHAR AS ad_group_id, l_quantity::BIGINT AS impressions,
           (1000 + l_linenumber)::BIGINT AS clicks, floor(l_extendedprice)::BIGINT + 1 AS cost,
           CASE WHEN l_discount > 0.02::DOUBLE THEN l_discount ELSE 0 END AS conversions,
           floor(l_extendedprice + 0.5::DOUBLE)::BIGINT AS revenue FROM r""",
)
sql(
    "ingest_ad_report_with_preamble",
    "",
    """r AS (SELECT * FROM lineitem)
    SELECT l_shipdate::DATE AS date, l_suppkey::VARCHAR AS campaign_id, 'Name, ' || l_partkey AS campaign_name,
           'Search' AS campaign_type, NULL::VARCHAR AS ad_group_id, l_quantity::BIGINT AS impressions,
           l_linenumber::BIGINT AS clicks, floor(l_extendedprice)::BIGINT + 1 AS cost, l_discount AS conversions, 0::BIGINT AS revenue
    FROM r""",
)
sql(
    "google_ads_view",
    "",
    """loads AS (
        SELECT s_suppkey, d::DATE AS d, s_name || ' ' || d::DATE AS name
        FROM (SELECT s_suppkey, s_name, unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01',
                     to_months((1 + s_suppkey % 5)::INTEGER))) AS d FROM supplier)),
    best AS (
        SELECT *, l_shipdate::DATE AS day FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_shipdate::DATE, l_suppkey
            ORDER BY l_quantity DESC, floor(l_extendedprice) DESC, l_discount DESC, l_extendedprice DESC) = 1)
    SELECT day AS date, l_suppkey::VARCHAR AS campaign_id, name AS campaign_name, 'SEARCH' AS campaign_type,
           NULL::VARCHAR AS ad_group_id, (l_quantity * 10)::BIGINT AS impressions, l_quantity::BIGINT AS clicks,
           floor(l_extendedprice)::BIGINT + 1 AS cost, l_discount AS conversions, round(l_extendedprice)::BIGINT AS revenue
    FROM best JOIN loads ON loads.s_suppkey = l_suppkey AND day - d BETWEEN 0 AND 60
    QUALIFY row_number() OVER (PARTITION BY day, l_suppkey ORDER BY d DESC) = 1""",
)
sql(
    "meta_ads_view",
    "",
    """a AS (
        SELECT l_shipdate::DATE AS d, l_suppkey AS k, sum(CASE WHEN l_linestatus = 'O' THEN l_linenumber END)::DOUBLE AS n
        FROM lineitem GROUP BY ALL)
    SELECT l_shipdate::DATE AS date, l_suppkey::VARCHAR AS campaign_id, 'camp ' || l_suppkey AS campaign_name,
           l_linenumber::VARCHAR AS ad_set_id, CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT END AS impressions,
           l_linenumber::BIGINT AS clicks, floor(l_extendedprice)::BIGINT + 1 AS cost, coalesce(n, 0) AS conversions,
           NULL::BIGINT AS revenue
    FROM lineitem LEFT JOIN a ON a.d = l_shipdate::DATE AND a.k = l_suppkey""",
)
sql(
    "search_console_view",
    "export",
    f"SELECT day AS date, page, query, clicks, impressions, {div('clicks', 'impressions')} AS ctr, position FROM traffic",
)
sql(
    "ingest_entities",
    "",
    """c AS (SELECT * FROM customer)
    SELECT c_custkey AS id, c_name AS company_name, c_acctbal AS budget, c_acctbal > 0 AS contact_opened,
           '{"nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}' AS extra, '[' || c_nationkey || ',7]' AS areas,
           (DATE '2000-01-01' + c_nationkey)::DATE::VARCHAR AS since FROM c""",
)

_DRIFTING = """c AS (SELECT c_custkey AS k, c_nationkey AS nation, c_acctbal AS acctbal FROM customer),
    d AS (SELECT k, k % 8 = 5 AS texts,
        CASE WHEN k % 8 = 5 THEN 'n/a' WHEN k % 4 = 0 THEN floor(acctbal)::BIGINT::VARCHAR END AS budget,
        CASE WHEN k % 4 = 1 AND k % 8 <> 5 THEN '{"nation":' || nation || ',"note":"x"}' END AS extra,
        CASE WHEN k % 4 = 2 THEN k % 8 = 2 END AS opened,
        CASE WHEN k % 8 = 5 THEN 'none' WHEN k % 4 = 2 THEN '[' || nation || ',7]' END AS areas,
        CASE WHEN k % 4 = 3 THEN '2020-01-01' END AS since,
        CASE WHEN k % 8 = 5 THEN nation::DECIMAL(10, 2) WHEN k % 4 = 3 THEN nation + 0.25 END AS rate, nation
        FROM c)"""
sql(
    "entities_of_any_shape",
    "",
    _DRIFTING
    + """ SELECT k AS source_row, k AS id, budget, extra, opened AS "contact opened", areas, since,
        rate::DECIMAL(4, 2) AS rate, NULL::VARCHAR AS rejected FROM d WHERE k % 11 <> 0
    UNION ALL SELECT k, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
        '{"id":' || k || CASE WHEN budget IS NULL THEN '' WHEN texts THEN ',"budget":"n/a"' ELSE ',"budget":' || budget END
        || CASE WHEN extra IS NULL THEN '' ELSE ',"extra":' || extra END
        || CASE WHEN opened IS NULL THEN '' ELSE ',"contact opened":' || opened END
        || CASE WHEN areas IS NULL THEN '' WHEN texts THEN ',"areas":"none"' ELSE ',"areas":' || areas END
        || CASE WHEN since IS NULL THEN '' ELSE ',"since":"2020-01-01"' END
        || CASE WHEN rate IS NULL THEN '' WHEN texts THEN ',"rate":' || nation ELSE ',"rate":' || rate END
    FROM d WHERE k % 11 = 0""",
)
sql(
    "entity_fields",
    "",
    _DRIFTING
    + """, f AS (
        SELECT 'id' AS field, 'number' AS kind, k::VARCHAR AS value, k FROM d
        UNION ALL SELECT 'budget', CASE WHEN texts THEN 'string' ELSE 'number' END, budget, k FROM d WHERE budget IS NOT NULL
        UNION ALL SELECT 'extra', 'object', extra, k FROM d WHERE extra IS NOT NULL
        UNION ALL SELECT 'contact opened', 'boolean', opened::VARCHAR, k FROM d WHERE opened IS NOT NULL
        UNION ALL SELECT 'areas', CASE WHEN texts THEN 'string' ELSE 'array' END, areas, k FROM d WHERE areas IS NOT NULL
        UNION ALL SELECT 'since', 'string', since, k FROM d WHERE since IS NOT NULL
        UNION ALL SELECT 'rate', 'number', CASE WHEN texts THEN nation::VARCHAR ELSE rate::VARCHAR END, k FROM d WHERE rate IS NOT NULL)
    SELECT field, kind, count(*) AS n, min(value) AS least, max(value) AS greatest FROM f WHERE k % 11 <> 0 GROUP BY ALL""",
)
sql(
    "price_quartiles_from_sketches",
    "",
    "x AS (SELECT 1) SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n, true AS all_near FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL",
)
sql(
    "heavy_suppliers_from_sketches",
    "",
    """n AS (SELECT l_suppkey AS supplier, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT supplier, n FROM n WHERE n > (SELECT avg(n) FROM n)""",
)

_HEADS = "h AS (SELECT o_orderkey AS order_id, o_orderstatus, o_orderdate AS created_at FROM orders)"
_MARK = "(SELECT max(created_at) FROM h WHERE o_orderstatus = 'F' AND created_at < TIMESTAMP '2001-01-01')"
sql("increment_from_mark", "", f"{_HEADS} SELECT * FROM h WHERE created_at >= {_MARK}")
sql("increment_after_mark", "", f"{_HEADS} SELECT * FROM h WHERE created_at > {_MARK}")
sql("backfill_chunk", "", f"{_HEADS} SELECT * FROM h WHERE year(created_at) = 1997 AND created_at > TIMESTAMP '1997-01-01'")
sql(
    "latest_wins",
    "lines",
    """SELECT order_id, line_item_id, inserted_at, sku, quantity, unit_price FROM lines
    QUALIFY row_number() OVER (PARTITION BY order_id, line_item_id
            ORDER BY inserted_at DESC, sku DESC, quantity DESC, unit_price DESC) = 1""",
)
sql(
    "keyed_upsert",
    "",
    """c AS (
        SELECT o_custkey + 100 AS key, o_orderpriority AS value, o_orderdate AS t,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC) AS n,
               count(*) OVER (PARTITION BY o_custkey) AS changes
        FROM orders)
    SELECT coalesce(c_custkey, key) AS key, coalesce(value, c_mktsegment) AS value,
           (CASE WHEN c_custkey IS NULL THEN 0 ELSE 1 END + coalesce(changes, 0))::BIGINT AS version,
           coalesce(t, TIMESTAMP '1990-01-01') AS updated_at
    FROM customer FULL JOIN (SELECT * FROM c WHERE n = 1) x ON key = c_custkey""",
)
sql(
    "utm_from_url",
    "",
    "p AS (SELECT * FROM pages) SELECT page_id, "
    + ", ".join(f"nullif(regexp_extract(url, '[?&]{n}=([^&]+)', 1), '') AS {n}_raw, {param('url', n)} AS {n}" for n in UTM)
    + """, split_part(url, '/', 3) AS host,
        CASE WHEN len(string_split(url, '/')) > 3 THEN substr(url, len(split_part(url, '/', 1)) + len(split_part(url, '/', 3)) + 3) END AS path
    FROM p""",
)

# ------------------------------------------------------------------ files written and read back

sql(
    "ndjson_append_and_load",
    "deals",
    """, twice AS (SELECT * FROM deals UNION ALL SELECT * FROM deals WHERE status = 'LOST')
    SELECT id, 'D-' || id AS deal_number, property_id AS tenant_id, property_id, status, CASE WHEN id % 3 = 0 THEN 'high' END AS priority,
           rent AS proposed_rent, updated_at::DATE AS desired_move_in, CASE WHEN status = 'LOST' THEN 'said "no", again' END AS lost_reason,
           assignee AS assigned_user_id, created_at, updated_at, updated_at AS inserted_at FROM twice""",
)
sql(
    "csv_master_load",
    "sizes",
    "SELECT sku, size AS size_category, a AS valid_from, b AS valid_to, NULL::VARCHAR AS notes FROM sizes",
)
sql(
    "day_partitions_restated",
    "history",
    """SELECT day AS data_date, (sum(clicks) + CASE WHEN DATE '2001-08-01' - day BETWEEN 0 AND 6 THEN count(*) ELSE 0 END)::BIGINT AS clicks,
              count(*) AS n FROM history WHERE day <> DATE '2001-07-30' GROUP BY day""",
)
sql(
    "backfill_resumed",
    "history",
    """SELECT day AS data_date, (sum(clicks) + CASE WHEN DATE '2001-08-01' - day BETWEEN 0 AND 250 THEN count(*) ELSE 0 END)::BIGINT AS clicks,
              count(*) AS n, '-1,2' AS loaded FROM history WHERE day <> DATE '2001-08-01' - 100 GROUP BY day""",
)
ORACLE["profile_from_buckets"] = ORACLE["ec_customer_profile"]
sql(
    "documents_and_rejects",
    "",
    """x AS (SELECT 1)
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 > 1 THEN floor(o_totalprice)::BIGINT END AS price, o_orderkey % 7 <= 1 AS rejected
    FROM orders""",
)
sql(
    "stream_latest_state",
    "",
    """s AS (
        SELECT DISTINCT l_partkey::VARCHAR AS sku, l_shipdate AS inserted_at,
               (floor(p_retailprice) + 50 * (year(l_shipdate) % 2))::BIGINT AS cost_price
        FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY sku ORDER BY inserted_at DESC) = 1""",
)

ORACLE["stream_state_compacted"] = ORACLE["stream_latest_state"]
sql(
    "stream_append_once",
    "",
    "x AS (SELECT 1) SELECT o_orderkey AS order_id, o_orderstatus, o_orderdate::TIMESTAMP AS created_at FROM orders",
)
sql(
    "stream_two_sides",
    "",
    """d AS (SELECT CASE WHEN o_orderkey < 1000 THEN 0 ELSE 1 END AS v, o_orderkey AS id,
        CASE WHEN o_orderkey % 7 > 1 THEN floor(o_totalprice)::BIGINT END AS price FROM orders)
    SELECT v, CASE WHEN price IS NULL THEN 'rejected' ELSE 'row' END AS kind, id, price FROM d
    UNION ALL SELECT v, 'log', count(*), count(price) FROM d GROUP BY v""",
)

sql(
    "declared_scan_rebuilt",
    "history",
    "SELECT day AS data_date, site_url, url, query, clicks, impressions, NULL::DOUBLE AS ctr, position FROM history",
)
ORACLE["report_rebuilt_as_table"] = ORACLE["ec_weekly_summary"]
sql("table_created_if_missing", "costs", "SELECT *, true AS created, false AS created_again FROM costs")
sql(
    "append_with_stamp",
    "deals",
    """SELECT id, status, rent AS proposed_rent, TIMESTAMP '2001-08-01 03:00:00' AS inserted_at FROM deals
    UNION ALL SELECT id, status, rent, TIMESTAMP '2001-07-31 03:00:00' FROM deals WHERE status = 'LOST'""",
)
sql("view_recomputed", "costs", "SELECT sku, count(*) AS periods, max(cost_price) AS highest, true AS grew FROM costs GROUP BY sku")
sql(
    "high_water_mark_text",
    "",
    """s(status) AS (VALUES ('F'), ('O'), ('P'), ('never'))
    SELECT status, coalesce(strftime((SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = status), '%Y-%m-%dT%H:%M:%SZ'),
                            '2020-01-01T00:00:00Z') AS since FROM s""",
)
_TRIES = """tries AS (
        SELECT o_custkey + 100 AS key, o_orderpriority AS value, o_orderdate AS t,
               CASE WHEN o_orderstatus = 'O' THEN 'refused ' || o_orderpriority END AS error FROM orders)"""
sql(
    "keyed_upsert_state",
    "",
    f"""{_TRIES},
    done AS (
        SELECT key, value, t, row_number() OVER (PARTITION BY key ORDER BY t DESC, value DESC) AS n, count(*) OVER (PARTITION BY key) AS changes
        FROM tries WHERE error IS NULL),
    last AS (SELECT key, error FROM tries QUALIFY row_number() OVER (PARTITION BY key ORDER BY t DESC, error DESC NULLS LAST) = 1),
    state AS (
        SELECT coalesce(c_custkey, key) AS key, coalesce(value, c_mktsegment) AS value,
               (CASE WHEN c_custkey IS NULL THEN 0 ELSE 1 END + coalesce(changes, 0))::BIGINT AS version,
               coalesce(t, TIMESTAMP '1990-01-01') AS updated_at
        FROM customer FULL JOIN (SELECT * FROM done WHERE n = 1) x ON key = c_custkey)
    SELECT state.*, CASE WHEN last.key IS NULL THEN 'old error' ELSE last.error END AS error FROM state LEFT JOIN last USING (key)""",
)
sql(
    "keyed_upsert_history",
    "",
    f"""{_TRIES} SELECT key, CASE WHEN error IS NULL THEN value END AS value, t AS updated_at, error, error IS NULL AS succeeded FROM tries""",
)

ORACLE["ec_channel_roi_from_raw"] = ORACLE["ec_channel_roi"]
ORACLE["ec_ad_performance_from_raw"] = ORACLE["ec_ad_performance"]
ORACLE["ec_cohort_ltv_from_raw"] = ORACLE["ec_cohort_ltv"]
ORACLE["ec_customer_profile_from_raw"] = ORACLE["ec_customer_profile"]
ORACLE["ad_cost_feed_from_raw"] = ORACLE["ad_cost_feed"]
sql(
    "orders_required_and_rejects",
    "lines",
    """SELECT order_id, line_item_id, sku, quantity,
              nullif(concat_ws(',', CASE WHEN landing_site IS NULL THEN 'landing_site' END,
                               CASE WHEN referring_site IS NULL THEN 'referring_site' END), '') AS missing FROM lines""",
)
