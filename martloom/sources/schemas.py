"""Declared tables. One line per table, "name type" with ! for a required column.

Types: S string, I long, F double, B boolean, D date, T timestamp (UTC).
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "S": T.StringType(),
    "I": T.LongType(),
    "F": T.DoubleType(),
    "B": T.BooleanType(),
    "D": T.DateType(),
    "T": T.TimestampType(),
}

_AD_ROW = "date D!, campaign_id S!, campaign_name S, campaign_type S, ad_group_id S, impressions I, clicks I, cost I, conversions F, revenue I, inserted_at T!"

# ---- fixed values: column names and types of the stored tables ----
TABLES = {
    # shop, as fetched
    "ec_backlog_issues": "issue_id S!, project_id S, issue_type S, title S, status S, priority S, assignee S, due_date D, created_at T, updated_at T, resolved_at T, inserted_at T!",
    "ec_google_ads": _AD_ROW,
    "ec_yahoo_ads": _AD_ROW,
    "ec_microsoft_ads": _AD_ROW,
    "ec_meta_ads": "date D!, campaign_id S!, campaign_name S, ad_set_id S, impressions I, clicks I, cost I, conversions F, revenue I, inserted_at T!",
    "ec_instagram_organic": "post_id S!, date D!, post_url S, media_type S, posted_at T, impressions I, reach I, likes I, comments I, saves I, engagement_rate F, inserted_at T!",
    "ec_klaviyo_campaigns": "campaign_id S!, campaign_name S, sent_at T, sent_day_of_week S, sent_hour I, recipients I, opens I, open_rate F, clicks I, click_rate F, conversions I, revenue I, unsubscribes I, inserted_at T!",
    "ec_klaviyo_profiles": "profile_id S!, email S!, first_name S, last_name S, total_revenue I, created_at T, updated_at T, inserted_at T!",
    "ec_openlogi_inventory_daily": "snapshot_date D!, item_id S!, sku S, item_name S, quantity I, available I, shipping I, requesting I, processing I, reserved I, backordered I, unallocatable I, raw_payload S, inserted_at T!",
    "ec_search_console": "date D!, page S!, query S!, clicks I, impressions I, ctr F, position F, inserted_at T!",
    "ec_shopify_customers": "customer_id S!, email S!, created_at T!, orders_count I, total_spent I, accepts_marketing B, tags S, inserted_at T!",
    "ec_shopify_orders": "order_id S!, order_name S, created_at T!, order_date D!, customer_id S, customer_email S!, financial_status S, total_price I!, subtotal_price I, total_discounts I, total_tax I, line_item_id S!, product_id S, variant_id S, sku S!, sku_title S, variant_title S, quantity I!, unit_price I!, line_discount I, is_refunded B!, refund_date D, refund_amount I, refund_reason S, source_name S, landing_site S, referring_site S, utm_source S, utm_medium S, utm_campaign S, tags S, inserted_at T!",
    "ec_shopify_products_daily": "fetched_date D!, product_id S!, product_title S, variant_id S!, sku S, variant_title S, price I, cost_price I, inventory_item_id S, currency S, inserted_at T!",
    "rakko_inflow_keywords": "fetched_date D!, target_url S!, match_type S, domain S, keyword S!, search_volume I, seo_difficulty I, cpc F, competition F, rank I, etv F, inserted_at T!",
    "sc_history": "data_date D!, site_url S!, url S, query S, clicks I!, impressions I!, ctr F, position F",
    # shop, masters
    "ec_cost_master": "sku S!, cost_price I!, valid_from D!, valid_to D!",
    "ec_shipping_rules": "valid_from D!, valid_to D!, shipping_fee_per_order I!",
    "ec_openlogi_sku_size_map": "sku S!, size_category S!, valid_from D!, valid_to D!, notes S",
    "ec_openlogi_storage_rate": "size_category S!, daily_rate_yen F!, monthly_rate_yen I!, dimensions_spec S, weight_limit S, valid_from D!, valid_to D!, notes S",
    # leasing
    "re_activities": "id I!, deal_id I, property_id I, tenant_id I, owner_id I, activity_type S!, direction S, subject S!, activity_date T!, created_by I!, created_at T!, inserted_at T!",
    "re_deals": "id I!, deal_number S!, tenant_id I!, property_id I!, status S!, priority S, proposed_rent I, desired_move_in D, lost_reason S, assigned_user_id I, created_at T!, updated_at T!, inserted_at T!",
    "re_owners": "id I!, owner_type S!, company_name S, representative_name S, contact_name S, contact_email S, contact_phone S, address S, management_company S, assigned_user_id I, created_at T!, updated_at T!, inserted_at T!",
    "re_properties": "id I!, owner_id I!, property_name S!, property_type S!, postal_code S, address S, nearest_station S, floor S, floor_area F, rent_amount I, management_fee I, deposit S, key_money S, available_from D, listing_status S!, is_reins B, commission_motoduke S, commission_kyakuduke S, priority S, assigned_user_id I, created_at T!, updated_at T!, inserted_at T!",
    "re_tenants": "id I!, tenant_type S, company_name S, contact_name S, contact_email S, contact_phone S, industry S, desired_area S, budget_max I, source S, status S, priority S, assigned_user_id I, contact_opened B, created_at T!, updated_at T!, inserted_at T!",
    "re_search_console": "date D!, page S!, query S!, clicks I, impressions I, ctr F, position F, inserted_at T!",
}
# ---- end of fixed values ----


def struct(columns: str) -> T.StructType:
    fields = [c.strip().split(" ") for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t.rstrip("!")], not t.endswith("!")) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {name: struct(columns) for name, columns in TABLES.items()}


_AD_KEY = ("date", "campaign_id", "ad_group_id")

# ---- fixed values: columns that name a row of a raw table; of several loads of it the newest counts ----
KEYS: dict[str, tuple[str, ...]] = {
    "ec_google_ads": _AD_KEY,
    "ec_yahoo_ads": _AD_KEY,
    "ec_microsoft_ads": _AD_KEY,
    "ec_meta_ads": ("date", "campaign_id", "ad_set_id"),
    "ec_klaviyo_campaigns": ("campaign_id",),
    "ec_klaviyo_profiles": ("profile_id",),
    "ec_openlogi_inventory_daily": ("snapshot_date", "item_id"),
    "ec_shopify_orders": ("order_id", "line_item_id"),
    "ec_shopify_products_daily": ("fetched_date", "variant_id"),
    "re_deals": ("id",),
    "re_properties": ("id",),
    "re_tenants": ("id",),
}
# ---- end of fixed values ----
