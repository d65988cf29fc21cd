"""Checks on raw tables and masters. Each returns the offending rows or counts, never raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.periods import overlaps


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def overlapping_periods(master: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Master rows that are valid on a day on which an earlier row of the same key is valid as well."""
    if keys:
        return overlaps(master, list(keys))
    # two periods that share a day share its year, which serves as the key; equal rows overlap each other as well
    columns = master.columns
    rules = master.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_year = rules.withColumn("_year", F.explode(F.sequence(F.year("valid_from"), F.year("valid_to"))))
    w = Window.partitionBy("_year").orderBy("valid_from", "valid_to", *[c for c in columns if c not in ("valid_from", "valid_to")])
    reach = F.max("valid_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = per_year.withColumn("_hit", F.coalesce(F.col("valid_from") <= reach, F.lit(False)))
    hits = flagged.groupBy(*columns, "_copies").agg(F.max("_hit").alias("_hit"))
    times = F.when(F.col("_hit"), F.col("_copies")).otherwise(F.col("_copies") - 1).cast("int")
    return hits.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))).select(*columns)


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, null_rows) per required column of the declared schema."""
    required = [f.name for f in schema.fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_rows")


def skus_without_master(skus: DataFrame, master: DataFrame) -> DataFrame:
    """SKUs that are sold or stocked but have no row in a master table."""
    named = skus.filter(F.col("sku").isNotNull() & (F.col("sku") != "")).select("sku").distinct()
    return named.join(master.select("sku"), "sku", "left_anti")


def yearly_orders(orders: DataFrame) -> DataFrame:
    """Line rows and distinct orders per year, for reconciling a backfill with the shop's own count."""
    return orders.groupBy(F.year("created_at").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("line_rows"), F.count_distinct("order_id").alias("orders")
    )
