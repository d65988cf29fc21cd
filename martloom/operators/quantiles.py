"""Exact quartiles of small integers (days between orders), from a histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def histogram_quartiles(histogram: DataFrame, by: str, value: str, count: str) -> DataFrame:
    """p25, p50 and p75 per group: the smallest value at which the running count reaches k/4 of the total.

    The histogram has at most one row per (group, value); its size is set by the range of the values,
    not by the number of rows behind it.
    """
    w = Window.partitionBy(by)
    running = F.sum(count).over(w.orderBy(value))
    total = F.sum(count).over(w)
    ranked = histogram.select(by, value, running.alias("_running"), total.alias("_total"))
    reached = lambda k: F.min(F.when(F.col("_running") * 4 >= F.col("_total") * k, F.col(value)))
    return ranked.groupBy(by).agg(reached(1).alias("p25"), reached(2).alias("p50"), reached(3).alias("p75"))
