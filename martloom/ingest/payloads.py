"""Shapes of the landed payloads (only the fields that are read) and how to read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.scalars import once
from martloom.session import using

ORDER = """
id string, name string, created_at string, email string, customer struct<id: string, email: string>,
financial_status string, total_price string, subtotal_price string, total_discounts string, total_tax string,
landing_site string, referring_site string, source_name string, tags string,
refunds array<struct<created_at: string, note: string, transactions: array<struct<amount: string>>>>,
line_items array<struct<id: string, product_id: string, variant_id: string, sku: string, title: string,
  variant_title: string, quantity: bigint, price: string, discount_allocations: array<struct<amount: string>>>>
"""

_MONEY = "struct<shopMoney: struct<amount: string>>"
BULK = f"""
id string, __parentId string, name string, createdAt string, email string, note string,
customer struct<id: string, email: string>, displayFinancialStatus string,
totalPriceSet {_MONEY}, subtotalPriceSet {_MONEY}, totalDiscountsSet {_MONEY}, totalTaxSet {_MONEY},
totalRefundedSet {_MONEY}, landingPageUrl string, referrerUrl string, sourceName string, tags string,
sku string, title string, variantTitle string, quantity bigint, originalUnitPriceSet {_MONEY},
product struct<id: string>, variant struct<id: string>,
discountAllocations array<struct<allocatedAmountSet: {_MONEY}>>
"""

PRODUCTS = """
data struct<products: struct<edges: array<struct<node: struct<id: string, title: string, variants: struct<edges:
  array<struct<node: struct<id: string, sku: string, title: string, price: string, inventoryItem: struct<id: string,
    unitCost: struct<amount: string, currencyCode: string>>>>>>>>>>>
"""

STOCK_FIELDS = (
    "quantity", "available", "shipping", "requesting", "processing", "reserved", "backordered", "unallocatable",
)
STOCK_ITEM = "id string, code string, name string, stock struct<" + ", ".join(f"{f}: string" for f in STOCK_FIELDS) + ">"

KEYWORDS = """
data struct<items: array<struct<keyword: string, metrics: struct<searchVolume: double, seoDifficulty: double,
  cpc: double, competition: double, rank: double, etv: double>>>>
"""

CAMPAIGNS = "data array<struct<id: string, attributes: struct<name: string, send_time: string, scheduled_at: string>>>"
CAMPAIGN_STATS = """
data struct<attributes: struct<results: array<struct<groupings: struct<campaign_id: string>, statistics: struct<
  recipients: double, opens_unique: double, opens: double, open_rate: double, clicks_unique: double, clicks: double,
  click_rate: double, conversion_uniques: double, conversions: double, conversion_value: double, revenue: double,
  unsubscribes: double>>>>>
"""

PROFILES = """
data array<struct<id: string, attributes: struct<email: string, first_name: string, last_name: string,
  created: string, updated: string, updated_at: string, last_event_date: string,
  predictive_analytics: struct<historic_clv: double>>>>
"""

MEDIA = """
data array<struct<id: string, permalink: string, media_type: string, timestamp: string, like_count: bigint,
  comments_count: bigint>>
"""
INSIGHTS = "data array<struct<name: string, values: array<struct<value: string>>>>"

SEARCH_ROWS = "rows array<struct<keys: array<string>, clicks: double, impressions: double, ctr: double, position: double>>"


STRICT = {"mode": "FAILFAST"}


def parse(df: DataFrame, schema: str, text: str = "body") -> DataFrame:
    """Replace a JSON text column by its fields. A document that does not fit fails the load, as in read_json."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, once(F.from_json(text, schema, STRICT)).alias("_p")).select(*others, "_p.*")


def judged(df: DataFrame, schema: str, text: str = "body") -> DataFrame:
    """df with `doc`, the fields of the document, and `rejected`: whether the text is null or does not fit."""
    shape = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("_corrupt", T.StringType())])
    parsed = df.select("*", once(F.from_json(text, shape, {"columnNameOfCorruptRecord": "_corrupt"})).alias("doc"))
    bad = F.col("doc").isNull() | F.col("doc._corrupt").isNotNull()
    return parsed.withColumn("rejected", bad).withColumn("doc", F.when(~bad, F.col("doc").dropFields("_corrupt")))


def parse_or_reject(df: DataFrame, schema: str, text: str = "body") -> tuple[DataFrame, DataFrame]:
    """Fields of the documents that fit, and the rows of those that don't, for loads that go on without them.

    Every row of df is in exactly one of the two; a null text is rejected.
    """
    both = judged(df, schema, text)
    others = [c for c in df.columns if c != text]
    return both.filter("NOT rejected").select(*others, "doc.*"), both.filter("rejected").select(*df.columns)


def read_json(spark: SparkSession, path: str, schema: str, one_per_file: bool = False) -> DataFrame:
    """Landed payloads with a declared shape, one document per line or per file. A document that does not
    fit fails the load instead of turning into nulls."""
    return spark.read.schema(schema).option("multiLine", one_per_file).option("mode", "FAILFAST").json(path)


def with_position(df: DataFrame, name: str = "seq") -> DataFrame:
    """Position of a row in the landed files: file, block of the file, row within the block."""
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """A bulk export: orders, line items and refunds mixed in one file, with their position."""
    return with_position(spark.read.schema(BULK).option("mode", "FAILFAST").json(path))


BULK_KINDS = ("Order", "LineItem", "Refund")

# A megabyte of stored input is seconds of parsing, so a task takes little of it; a file per kind is open at a time, and
# the rows need no sort by kind.
STAGING = {
    "spark.sql.files.maxPartitionBytes": "4m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.maxConcurrentOutputFileWriters": str(len(BULK_KINDS)),
}


def staged_bulk(rows: DataFrame, folder: str) -> DataFrame:
    """The rows of a bulk export written to a new shared folder by kind, and read from there.

    The texts are parsed once; every later step scans its kind only, and of it the columns it needs. Kinds that no job
    reads are not written.
    """
    kind = F.lit(None).cast("string")
    for k in BULK_KINDS:
        kind = F.when(F.col("id").contains(f"/{k}/"), k).otherwise(kind)
    with using(rows.sparkSession, STAGING):
        rows.withColumn("kind", kind).filter("kind IS NOT NULL").write.partitionBy("kind").parquet(folder)
    shape = T.StructType([*rows.schema.fields, T.StructField("kind", T.StringType())])
    return rows.sparkSession.read.schema(shape).parquet(folder)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, line) of text reports; splits of a large file are read by different tasks."""
    return with_position(spark.read.text(path), "at").select(
        F.col("at.file").alias("file"),
        F.struct("at.block", "at.row").alias("pos"),
        F.regexp_replace("value", "^﻿|\r$", "").alias("line"),
    )
