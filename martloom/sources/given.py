"""The given star-schema tables seen as shop and leasing tables.

Every method maps whole tables, row by row, to the declared shape; nothing is sampled. Values that the
star schema does not have (landing pages, tags, sources) are derived from its keys.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import stored_bytes

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")
SHOP_DAY = dt.date(2001, 8, 1)
SHOP_NOW = dt.datetime(2001, 8, 1, 3, 0, 0)
EPOCH = dt.date(1990, 1, 1)
OWN_URL = "https://shop.example.com/"
RIVAL_URLS = tuple(f"https://rival{i}.example.net/" for i in range(1, 7))
EVENT_SHIFT_DAYS = 8217  # brings the event month to the end of the order years
BRANDS = ("acme", "akme")

# (landing_site, referring_site, utm_source, utm_medium, utm_campaign)
VISITS = (
    ("/", None, None, None, None),
    (None, None, None, None, None),
    ("/p/3?utm_source=klaviyo&utm_medium=email&utm_campaign=spring%20sale+x", None, None, None, None),
    ("/p/1", None, "klaviyo", "email", "letter"),
    ("/p/2?utm_source=google&utm_medium=cpc&utm_campaign=brand", "https://www.google.com/", None, None, None),
    ("/p/12", None, "google", "pmx", "all"),
    ("/p/4?x=1&utm_source=ig&utm_medium=social", "https://l.instagram.com/", None, None, None),
    ("/", None, "facebook", "paid", "retarget"),
    ("/p/5", "https://search.yahoo.co.jp/search", None, None, None),
    ("/p/6", "https://www.google.com/", None, None, None),
    ("/p/7", "https://www.bing.com/", None, None, None),
    ("/p/8", "https://www.youtube.com/watch", None, None, None),
    ("/p/9", "https://www.instagram.com/", None, None, None),
    ("/?utm_source=news&utm_medium=email", "https://www.google.com/", None, None, None),
    ("/p/10?utm_source=news&utm_medium=email", None, None, None, None),
    ("/p/11", None, "yahoo", "dsa", "y1"),
    ("/p/13", None, "yahoo", "cpc", "y2"),
    ("/p/14?utm_source=bing&utm_medium=cpc", None, None, None, None),
    ("/collections/all", "https://example.org/", None, None, None),
    (None, "https://www.google.com/", None, None, None),
    ("https://shop.example.com/p/15?utm_source=google&utm_medium=ppc", None, None, None, None),
    ("/p/16?utm_campaign=solo", None, None, None, None),
    ("?utm_source=google&utm_medium=dg", None, None, None, None),
    ("/p/17", None, "google", "organic", None),
)
VISIT_FIELDS = ("landing_site", "referring_site", "utm_source", "utm_medium", "utm_campaign")

DEAL_STATES = (
    "INQUIRY", "VIEWING_PLANNED", "VIEWED", "APPLIED", "SCREENING", "CONTRACTING", "CONTRACTED", "LOST",
)
STORAGE_RATES = (
    # size, daily, monthly, from, to
    ("60", 1.0, 30, "1990-01-01", "9999-12-31"),
    ("80", 2.5, 75, "1990-01-01", "2001-07-31"),
    ("80", 2.75, 80, "2001-08-01", "9999-12-31"),
    ("100", 4.0, 120, "1990-01-01", "9999-12-31"),
    ("140", 10.0, 300, "1990-01-01", "9999-12-31"),
)
def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _instant(c: str) -> Column:
    return F.col(c).cast("timestamp")


def _add_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours.cast("int"), ts)


class Given:
    """Tables of one scale factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def size(self) -> int:
        """Bytes of the tables that reports read."""
        return stored_bytes(self.spark, [f"{self.dir}/{name}.parquet" for name in TABLES])

    # -------------------------------------------------------------- shop

    @cached_property
    def orders(self) -> DataFrame:
        """Order lines: one row per line item, order columns repeated."""
        visits = F.array(
            *[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(VISIT_FIELDS, row)]) for row in VISITS]
        )
        visit = F.get(visits, F.pmod(F.col("o_orderkey"), F.lit(len(VISITS))).cast("int"))
        refunded = F.col("l_returnflag") == "R"
        total = F.round("o_totalprice").cast("long")
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("visit", visit)
            .select(
                _text("o_orderkey").alias("order_id"),
                F.concat(F.lit("#"), "o_orderkey").alias("order_name"),
                _instant("o_orderdate").alias("created_at"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                _text("o_custkey").alias("customer_id"),
                F.concat(F.lit("customer"), "o_custkey", F.lit("@example.com")).alias("customer_email"),
                F.lower("o_orderstatus").alias("financial_status"),
                total.alias("total_price"),
                F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_item_id"),
                _text("l_partkey").alias("product_id"),
                _text("l_partkey").alias("variant_id"),
                _text("l_partkey").alias("sku"),
                F.concat(F.lit("Part "), "l_partkey").alias("sku_title"),
                F.col("l_quantity").cast("long").alias("quantity"),
                F.floor("l_extendedprice").cast("long").alias("unit_price"),
                refunded.alias("is_refunded"),
                F.when(refunded, F.col("l_shipdate").cast("date")).alias("refund_date"),
                F.when(refunded, F.floor(F.col("o_totalprice") * 0.5).cast("long")).alias("refund_amount"),
                *[F.col(f"visit.{f}").alias(f) for f in VISIT_FIELDS],
                F.when(F.col("o_orderpriority") == "1-URGENT", "ギフト設定,vip")
                .when(F.col("o_orderpriority") == "2-HIGH", "vip")
                .alias("tags"),
                _instant("l_shipdate").alias("inserted_at"),
            )
        )

    @cached_property
    def products_daily(self) -> DataFrame:
        """A price sighting per shipped line; the price alternates with the year."""
        return (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_shipdate").cast("date").alias("fetched_date"),
                _text("l_partkey").alias("sku"),
                (F.floor("p_retailprice") + 50 * (F.year("l_shipdate") % 2)).cast("long").alias("cost_price"),
                _instant("l_shipdate").alias("inserted_at"),
            )
        )

    @cached_property
    def shipping_rules(self) -> DataFrame:
        rows = [(EPOCH, dt.date(1998, 12, 31), 900), (dt.date(1999, 1, 1), dt.date(2099, 12, 31), 1000)]
        return self.spark.createDataFrame(rows, "valid_from date, valid_to date, shipping_fee_per_order bigint")

    def ads(self, flag: str, status: str | None = None) -> DataFrame:
        """One advertising source per return flag (and line status)."""
        rows = self.table("lineitem").filter(F.col("l_returnflag") == flag)
        if status:
            rows = rows.filter(F.col("l_linestatus") == status)
        return rows.select(
            F.col("l_shipdate").cast("date").alias("date"),
            _text("l_suppkey").alias("campaign_id"),
            F.col("l_quantity").cast("long").alias("clicks"),
            (F.col("l_quantity") * 20).cast("long").alias("impressions"),
            F.round(F.col("l_tax") * F.col("l_extendedprice")).cast("long").alias("cost"),
            F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("conversions"),
        )

    @cached_property
    def ad_sources(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.ads("R"), self.ads("A"), self.ads("N", "O"), self.ads("N", "F")

    @cached_property
    def campaigns(self) -> DataFrame:
        """An email campaign per supplier, some not sent."""
        k = F.col("s_suppkey")
        day = F.date_add(F.lit(dt.date(1995, 1, 10)), (k * 23 % 2380).cast("int"))
        return self.table("supplier").select(
            F.concat(F.lit("c"), k).alias("campaign_id"),
            F.col("s_name").alias("campaign_name"),
            F.when(F.col("s_acctbal") >= 0, _add_hours(day.cast("timestamp"), k % 24)).alias("sent_at"),
            (k + 500).alias("recipients"),
            (k % 8 / 8.0).alias("open_rate"),
            (k % 16 / 16.0).alias("click_rate"),
            (k * 100).alias("revenue"),
        )

    @cached_property
    def profiles(self) -> DataFrame:
        return (
            self.table("customer")
            .filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE", "HOUSEHOLD"))
            .select(F.concat(F.lit("customer"), "c_custkey", F.lit("@example.com")).alias("email"))
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """Three days of stock per part; the medium class has no SKU code, the promo class no free count."""
        days = F.explode(F.sequence(F.lit(SHOP_DAY - dt.timedelta(days=2)), F.lit(SHOP_DAY)))
        return self.table("part").select(
            days.alias("snapshot_date"),
            _text("p_partkey").alias("item_id"),
            F.when(F.col("p_type") != "MEDIUM", _text("p_partkey")).alias("sku"),
            F.col("p_name").alias("item_name"),
            F.col("p_size").cast("long").alias("quantity"),
            F.when(F.col("p_type") != "PROMO", (F.col("p_size") - 5).cast("long")).alias("available"),
            (F.col("p_size") % 3).cast("long").alias("backordered"),
            (F.col("p_size") % 4).cast("long").alias("processing"),
            (F.col("p_size") % 5).cast("long").alias("shipping"),
        )

    @cached_property
    def size_map(self) -> DataFrame:
        """Size class per part and half of the time axis; the large class is not mapped."""
        size = F.col("p_size")
        before = F.when(size < 15, "60").when(size < 30, "80").otherwise("100")
        after = F.when(size < 15, "60").when(size < 35, "80").when(size < 45, "100").otherwise("150")
        spans = F.array(
            F.struct(
                F.lit(EPOCH).alias("valid_from"), F.lit(dt.date(2001, 7, 30)).alias("valid_to"), before.alias("size_category")
            ),
            F.struct(
                F.lit(dt.date(2001, 7, 31)).alias("valid_from"),
                F.lit(dt.date(9999, 12, 31)).alias("valid_to"),
                after.alias("size_category"),
            ),
        )
        return (
            self.table("part")
            .filter(F.col("p_type") != "LARGE")
            .select(_text("p_partkey").alias("sku"), F.explode(spans).alias("s"))
            .select("sku", "s.*")
        )

    @cached_property
    def storage_rate(self) -> DataFrame:
        rows = [(s, d, m, dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for s, d, m, a, b in STORAGE_RATES]
        return self.spark.createDataFrame(
            rows, "size_category string, daily_rate_yen double, monthly_rate_yen bigint, valid_from date, valid_to date"
        )

    # -------------------------------------------------------------- search

    @cached_property
    def sc_history(self) -> DataFrame:
        """A search row per event, spread over fourteen months."""
        k = F.get_json_object("props", "$.k").cast("long")
        clicks = F.when(F.col("event_type") == "click", F.col("user_id") % 7 * 10 + 1).otherwise(0)
        back = (F.col("event_id") % 14 * 28).cast("int") + EVENT_SHIFT_DAYS
        return (
            self.table("events")
            .withColumn("k", k)
            .select(
                F.date_sub(F.col("ts").cast("date"), back).alias("data_date"),
                F.lit(OWN_URL).alias("site_url"),
                F.concat(F.lit("https://shop.example.com/p/"), F.col("user_id") % 20).alias("url"),
                F.concat(F.when(F.col("k") % 10 == 0, "acme ").otherwise("q"), F.col("k")).alias("query"),
                clicks.alias("clicks"),
                (clicks + 20 + F.col("k")).alias("impressions"),
                (F.floor(F.col("value") / 20) + 1).cast("double").alias("position"),
            )
        )

    @cached_property
    def keywords(self) -> DataFrame:
        """A keyword sighting per event on the own site or one of six others, in two fetches."""
        k = F.get_json_object("props", "$.k").cast("long")
        rivals = F.array(*map(F.lit, RIVAL_URLS))
        rival = F.get(rivals, (F.col("user_id") % 6).cast("int"))
        own = (F.col("k") % 3 == 0) & (F.col("user_id") % 7 == 0)
        return (
            self.table("events")
            .withColumn("k", k)
            .select(
                F.when(F.col("event_type") == "signup", F.lit(SHOP_DAY - dt.timedelta(days=7)))
                .otherwise(F.lit(SHOP_DAY))
                .alias("fetched_date"),
                F.when(own, F.lit(OWN_URL)).otherwise(rival).alias("target_url"),
                F.regexp_extract(F.when(own, F.lit(OWN_URL)).otherwise(rival), "//([^/]+)", 1).alias("domain"),
                F.concat(F.lit("q"), F.col("k")).alias("keyword"),
                F.when(F.col("k") % 17 != 0, F.col("k") * 310).alias("search_volume"),
                F.when(F.col("k") % 11 != 5, F.col("k") % 50 + F.col("user_id") % 9).alias("seo_difficulty"),
                (F.col("k") * 0.5).alias("cpc"),
            )
        )

    # -------------------------------------------------------------- leasing

    @cached_property
    def deals(self) -> DataFrame:
        k = F.col("o_orderkey")
        urgency = F.substring("o_orderpriority", 1, 1).cast("int")
        state = (
            F.when(F.col("o_orderstatus") == "O", urgency - 1)
            .when(F.col("o_orderstatus") == "P", F.when(urgency <= 2, 5).otherwise(6))
            .otherwise(F.when(urgency <= 3, 7).otherwise(6))
        )
        return self.table("orders").select(
            k.alias("id"),
            F.col("o_custkey").alias("tenant_id"),
            F.col("o_custkey").alias("property_id"),
            F.get(F.array(*map(F.lit, DEAL_STATES)), state).alias("status"),
            F.when(urgency != 3, F.floor("o_totalprice")).alias("proposed_rent"),
            F.when(urgency != 4, k % 13).alias("assigned_user_id"),
            _add_hours(_instant("o_orderdate"), k % 24).alias("created_at"),
            _add_hours(_instant("o_orderdate"), k % 2400).alias("updated_at"),
        )

    @cached_property
    def tenants(self) -> DataFrame:
        k = F.col("c_custkey")
        segment = F.col("c_mktsegment")
        source = (
            F.when(segment == "BUILDING", "Web form")
            .when(segment == "FURNITURE", "SEO search")
            .when(segment == "HOUSEHOLD", "phone")
            .when(segment == "MACHINERY", "HP referral")
        )
        return self.table("customer").select(
            k.alias("id"),
            source.alias("source"),
            _add_hours(F.lit(SHOP_NOW.isoformat(" ")).cast("timestamp"), -(k * 7 % 12000)).alias("created_at"),
        )

    @cached_property
    def properties(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.alias("id"),
            (k % 97).alias("owner_id"),
            F.col("p_name").alias("property_name"),
            F.col("p_type").alias("property_type"),
            F.col("p_brand").alias("listing_status"),
            (F.floor("p_retailprice") * 100).cast("long").alias("rent_amount"),
            _add_hours(F.lit(SHOP_NOW.isoformat(" ")).cast("timestamp"), -(k * 11 % 20000)).alias("created_at"),
        )

    @cached_property
    def activities(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("property_id"),
            F.when(F.col("event_type") == "view", "VIEWING").otherwise(F.upper("event_type")).alias("activity_type"),
        )

    @cached_property
    def url_impressions(self) -> DataFrame:
        """The leasing site's search export; errors stand for anonymised queries."""
        k = F.get_json_object("props", "$.k").cast("long")
        clicks = F.when(F.col("event_type") == "click", F.col("user_id") % 5 + 1).otherwise(0)
        return (
            self.table("events")
            .withColumn("k", k)
            .select(
                F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT_DAYS).alias("data_date"),
                F.concat(F.lit("https://lease.example.com/b/"), F.col("user_id") % 30).alias("url"),
                F.when(F.col("event_type") != "error", F.concat(F.lit("office "), F.col("k"))).alias("query"),
                clicks.alias("clicks"),
                F.when(F.col("event_type") == "signup", 0).otherwise(clicks + F.col("k")).alias("impressions"),
                (F.floor(F.col("value") / 20) + 1).alias("rank"),
            )
            .withColumn("sum_position", (F.col("impressions") * F.col("rank")).cast("double"))
            .drop("rank")
        )
