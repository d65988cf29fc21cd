"""Periods of equal value out of a daily snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_periods(
    daily: DataFrame, key: str, value: str, day: str, epoch: dt.date, horizon: dt.date
) -> DataFrame:
    """(key, value, valid_from, valid_to): one row per run of equal values. A value that returns later
    starts a new period. The first period reaches back to epoch, the last one to horizon.

    daily holds one row per key and day. A run starts where the value differs from the day before, so
    the starts alone carry all that is needed; both windows share one shuffle and one sort.
    """
    w = Window.partitionBy(key).orderBy(day)
    before = F.lag(value).over(w)
    starts = daily.select(key, value, day, before.alias("_before")).filter(
        F.col("_before").isNull() | (F.col("_before") != F.col(value))
    )
    return starts.select(
        key,
        value,
        F.when(F.lag(day).over(w).isNull(), F.lit(epoch)).otherwise(F.col(day)).alias("valid_from"),
        F.coalesce(F.date_sub(F.lead(day).over(w), 1), F.lit(horizon)).alias("valid_to"),
    )


def overlaps(master: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose period reaches into the start of the next one of the same key."""
    w = Window.partitionBy(*keys).orderBy("valid_from", "valid_to")
    return (
        # the furthest end so far, so that a long period is caught behind a short one as well
        master.withColumn("_reach", F.max("valid_to").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .filter(F.col("valid_from") <= F.col("_reach"))
        .drop("_reach")
    )
