"""Shop payloads to raw rows: orders (two shapes), product and stock snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import utm
from martloom.functions.scalars import blank_to_null, last_segment, number, once, to_int_half_even, to_int_half_up
from martloom.ingest.payloads import STOCK_FIELDS, STOCK_ITEM, STRICT
from martloom.operators.keyed import latest_wins
from martloom.operators.skew import SALT, spread_hot_keys

# ---- fixed values ----
DEFAULT_CURRENCY = "JPY"
PRODUCT_ID, VARIANT_ID, STOCK_ID = (
    "gid://shopify/Product/",
    "gid://shopify/ProductVariant/",
    "gid://shopify/InventoryItem/",
)
# ---- end of fixed values ----


def run_stamp(run_at: dt.datetime) -> Column:
    return F.lit(run_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp").alias("inserted_at")


def _day(iso: Column) -> Column:
    """The calendar day as written, whatever the offset."""
    return F.substring_index(iso, "T", 1).try_cast("date")


def _sum_amounts(items: Column, amount: Callable[[Column], Column]) -> Column:
    zero = F.lit(0.0)
    return F.aggregate(
        F.coalesce(items, F.array()), zero, lambda total, x: total + F.coalesce(amount(x).try_cast("double"), zero)
    )


def orders_from_rest(payloads: DataFrame, run_at: dt.datetime) -> DataFrame:
    """One row per line item. Orders without any email are left out; the first refund tells date, amount
    and reason."""
    yen = lambda c: to_int_half_up(c.try_cast("double"))
    email = F.coalesce(blank_to_null(F.col("customer.email")), blank_to_null(F.col("email")))
    refund = F.get("refunds", F.lit(0))
    lines = (
        payloads.withColumn("customer_email", email)
        .filter(F.col("customer_email").isNotNull())
        .withColumn("refund", refund)
        .withColumn("refunded", F.coalesce(F.size("refunds") > 0, F.lit(False)))
        .withColumn("li", F.explode("line_items"))
    )
    discount = _sum_amounts(F.col("li.discount_allocations"), lambda d: d["amount"])
    refund_sum = _sum_amounts(F.col("refund.transactions"), lambda t: t["amount"])
    landing = F.col("landing_site")
    text = lambda c: blank_to_null(F.col(c))
    return lines.select(
        F.col("id").alias("order_id"),
        text("name").alias("order_name"),
        F.col("created_at").try_cast("timestamp").alias("created_at"),
        _day(F.col("created_at")).alias("order_date"),
        F.col("customer.id").alias("customer_id"),
        "customer_email",
        text("financial_status").alias("financial_status"),
        *[yen(F.col(c)).alias(c) for c in ("total_price", "subtotal_price", "total_discounts", "total_tax")],
        F.col("li.id").alias("line_item_id"),
        F.col("li.product_id").alias("product_id"),
        F.col("li.variant_id").alias("variant_id"),
        F.coalesce(F.col("li.sku"), F.lit("")).alias("sku"),
        text("li.title").alias("sku_title"),
        text("li.variant_title").alias("variant_title"),
        F.col("li.quantity").alias("quantity"),
        yen(F.col("li.price")).alias("unit_price"),
        F.when(discount > 0, to_int_half_up(discount)).alias("line_discount"),
        F.col("refunded").alias("is_refunded"),
        _day(F.col("refund.created_at")).alias("refund_date"),
        F.when(F.col("refunded"), to_int_half_up(refund_sum)).alias("refund_amount"),
        text("refund.note").alias("refund_reason"),
        text("source_name").alias("source_name"),
        text("landing_site").alias("landing_site"),
        text("referring_site").alias("referring_site"),
        *[utm.decoded_param(landing, f).alias(f) for f in utm.FIELDS],
        text("tags").alias("tags"),
        run_stamp(run_at),
    )


def orders_from_bulk(rows: DataFrame, run_at: dt.datetime) -> DataFrame:
    """The same rows out of a bulk export, in which lines and refunds point to their order by id.

    rows carries seq, the position in the export: of two copies of an order the later one counts, of
    several refunds the first one. Stage a large export first (payloads.staged_bulk): its kinds are read one by one.
    """
    staged = "kind" in rows.columns  # see payloads.staged_bulk
    is_a = lambda kind: F.col("kind") == kind if staged else F.col("id").contains(f"/{kind}/")
    money = lambda c: to_int_half_even(F.col(f"{c}.shopMoney.amount").try_cast("double"))

    parentless = F.col("__parentId").isNull() | (F.col("__parentId") == "")
    heads = rows.filter(is_a("Order") & parentless).select(
        F.col("id").alias("order_gid"),
        "seq",
        F.col("name").alias("order_name"),
        "createdAt",
        F.coalesce(blank_to_null(F.col("customer.email")), blank_to_null(F.col("email"))).alias("customer_email"),
        last_segment(F.col("customer.id")).alias("customer_id"),
        F.lower("displayFinancialStatus").alias("financial_status"),
        money("totalPriceSet").alias("total_price"),
        money("subtotalPriceSet").alias("subtotal_price"),
        money("totalDiscountsSet").alias("total_discounts"),
        money("totalTaxSet").alias("total_tax"),
        money("totalRefundedSet").alias("total_refunded"),
        F.col("sourceName").alias("source_name"),
        F.col("landingPageUrl").alias("landing_site"),
        F.col("referrerUrl").alias("referring_site"),
        # a list arrives as its JSON text
        F.when(F.col("tags").startswith("["), F.array_join(F.from_json("tags", "array<string>"), ","))
        .otherwise(F.col("tags"))
        .alias("tags"),
    )
    heads = latest_wins(heads, ["order_gid"], "seq", ties=[]).filter(F.col("customer_email").isNotNull())

    discount = _sum_amounts(F.col("discountAllocations"), lambda d: d["allocatedAmountSet"]["shopMoney"]["amount"])
    lines = rows.filter(is_a("LineItem")).select(
        F.col("__parentId").alias("order_gid"),
        last_segment(F.col("id")).alias("line_item_id"),
        last_segment(F.col("product.id")).alias("product_id"),
        last_segment(F.col("variant.id")).alias("variant_id"),
        F.coalesce(F.col("sku"), F.lit("")).alias("sku"),
        F.col("title").alias("sku_title"),
        F.col("variantTitle").alias("variant_title"),
        "quantity",
        money("originalUnitPriceSet").alias("unit_price"),
        F.when(discount > 0, to_int_half_even(discount)).alias("line_discount"),
    )
    refunds = (
        rows.filter(is_a("Refund"))
        .groupBy(F.col("__parentId").alias("order_gid"))
        .agg(F.min(F.struct("seq", "createdAt", "note")).alias("refund"))
    )
    refunded = F.col("refund").isNotNull()
    heads = heads.join(refunds, "order_gid", "left")
    lines, heads = spread_hot_keys(lines, heads, ["order_gid"], ["line_item_id"])
    return (
        lines.join(heads, ["order_gid", SALT])
        .select(
            last_segment(F.col("order_gid")).alias("order_id"),
            "order_name",
            F.col("createdAt").try_cast("timestamp").alias("created_at"),
            _day(F.col("createdAt")).alias("order_date"),
            "customer_id",
            "customer_email",
            blank_to_null(F.col("financial_status")).alias("financial_status"),
            "total_price",
            "subtotal_price",
            "total_discounts",
            "total_tax",
            "line_item_id",
            "product_id",
            "variant_id",
            "sku",
            "sku_title",
            "variant_title",
            "quantity",
            "unit_price",
            "line_discount",
            refunded.alias("is_refunded"),
            _day(F.col("refund.createdAt")).alias("refund_date"),
            F.when(refunded, F.col("total_refunded")).alias("refund_amount"),
            F.col("refund.note").alias("refund_reason"),
            "source_name",
            "landing_site",
            "referring_site",
            *[utm.decoded_param(F.col("landing_site"), f).alias(f) for f in utm.FIELDS],
            "tags",
            run_stamp(run_at),
        )
    )


def product_snapshot(payloads: DataFrame, fetched_date: dt.date, run_at: dt.datetime) -> DataFrame:
    """One row per product variant."""
    strip = lambda c, prefix: F.regexp_replace(F.col(c), f"^{prefix}", "")
    yen = lambda c: to_int_half_up(F.col(c).try_cast("double"))
    return (
        payloads.select(F.explode("data.products.edges.node").alias("p"))
        .select("p.id", "p.title", F.explode("p.variants.edges.node").alias("v"))
        .select(
            F.lit(fetched_date).alias("fetched_date"),
            strip("id", PRODUCT_ID).alias("product_id"),
            F.col("title").alias("product_title"),
            strip("v.id", VARIANT_ID).alias("variant_id"),
            blank_to_null(F.col("v.sku")).alias("sku"),
            blank_to_null(F.col("v.title")).alias("variant_title"),
            yen("v.price").alias("price"),
            yen("v.inventoryItem.unitCost.amount").alias("cost_price"),
            strip("v.inventoryItem.id", STOCK_ID).alias("inventory_item_id"),
            F.coalesce(
                blank_to_null(F.col("v.inventoryItem.unitCost.currencyCode")), F.lit(DEFAULT_CURRENCY)
            ).alias("currency"),
            run_stamp(run_at),
        )
    )


def stock_snapshot(bodies: DataFrame, snapshot_date: dt.date, run_at: dt.datetime) -> DataFrame:
    """One row per stock item out of a body text that is either {"items": [..]} or a bare list. The item's
    own JSON text is kept."""
    is_list = F.ltrim("body").startswith("[")
    items = F.when(is_list, F.from_json("body", "array<string>", STRICT)).otherwise(
        F.from_json("body", "items array<string>", STRICT)["items"]
    )
    count = lambda f: number(F.col(f"i.stock.{f}")).cast("long").alias(f)
    return (
        bodies.select(once(items).alias("items"))
        .select(F.explode("items").alias("raw_payload"))
        .select("raw_payload", once(F.from_json("raw_payload", STOCK_ITEM, STRICT)).alias("i"))
        .select(
            F.lit(snapshot_date).alias("snapshot_date"),
            F.coalesce(F.col("i.id"), F.lit("")).alias("item_id"),
            blank_to_null(F.col("i.code")).alias("sku"),
            blank_to_null(F.col("i.name")).alias("item_name"),
            *map(count, STOCK_FIELDS),
            "raw_payload",
            run_stamp(run_at),
        )
    )
