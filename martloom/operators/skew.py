"""Joins whose key may hold a large share of the facts.

AQE splits hot partitions of a join only where both sides come straight out of a shuffle. Where the lookup
side is the result of an aggregation or a window on the same key it cannot, so the split is made here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def hot_keys(facts: DataFrame, keys: Sequence[str], by: Sequence[str], fraction: float, partitions: int) -> DataFrame:
    """(keys, _splits) of the keys that hold more than two average partitions' worth of the facts.

    Read from a sample of the key columns, drawn by a hash of the columns `by`, so that every evaluation of the plan
    draws the same rows; it only decides how rows are spread. Fewer than partitions / 2 keys can qualify, however
    large the facts are.
    """
    drawn = F.pmod(F.xxhash64(*by), F.lit(1_000_000)) < fraction * 1_000_000
    counts = facts.filter(drawn).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    share = F.col("_n") / total
    return counts.filter(share > F.lit(2.0 / partitions)).select(
        *keys, F.ceil(share * F.lit(float(partitions))).cast("int").alias("_splits")
    )


def spread_hot_keys(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    key_source: DataFrame | None = None,
    fraction: float = 0.01,
    partitions: int | None = None,
    hot: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a _salt column to join on beside the keys; the join result is the same as without.

    Rows of a hot key are dealt out by the spread columns and the task they come from, both of which are
    the same when a lost task runs again. The lookup rows of a hot key are repeated once per salt.
    key_source names a cheaper frame to count the keys on, when facts is itself a long computation; hot gives the hot
    keys where they are known (sketches.hot_from_summaries), so that nothing is counted.
    """
    if partitions is None:
        partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        source = facts if key_source is None else key_source
        content = [c for c in spread if c in source.columns and c not in keys] or source.columns
        hot = hot_keys(source, keys, content, fraction, partitions)
    hot = F.broadcast(hot)  # bounded by the number of shuffle partitions, see hot_keys

    def with_splits(df: DataFrame) -> DataFrame:
        renamed = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_splits")
        same: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
        return df.join(F.broadcast(renamed), same, "left").drop(*[f"_hot_{k}" for k in keys])

    dealt = F.pmod(F.xxhash64(*spread, F.spark_partition_id()), F.coalesce(F.col("_splits"), F.lit(1)))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_splits"), F.lit(1)) - 1))
    return (
        with_splits(facts).withColumn(SALT, dealt.cast("int")).drop("_splits"),
        with_splits(lookup).withColumn(SALT, every).drop("_splits"),
    )
