"""Mixing sources to target weights: hash-random order within each source, distributed prefix sums, an exact cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.text import SPACES, documents, saved

ROWS_PER_RANGE = 2_000  # mean rows of a range; ranges are as even as the hash
BROADCAST_SOURCES = 100_000  # a plan of at most so many rows is broadcast; a longer one is joined by shuffle


def source_targets(totals: DataFrame, weights: Column | None = None, epochs: int = 3) -> DataFrame:
    """target of each row of `totals` (source, source_size): shares of all sizes by weight, at most `epochs` times the size.

    Default weights are 1, 2, 3, repeating, over the sources by code point, null last. A source is stopped when its
    limit per unit of weight is below what the rest gets per unit; sorted by that ratio, stopped sources come first, so
    running sums find them without repeated resharing. The windows see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = totals.withColumn("weight", weights if weights is not None else (F.row_number().over(by_name) - 1) % 3 + 1)
    limit = epochs * F.col("source_size")
    by_ratio = Window.orderBy((limit.cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    state = weighted.select(
        "*",
        limit.alias("limit"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).alias("stopped_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("all_weight"),
    )
    left, weight_left = F.col("total") - F.col("stopped_before"), F.col("all_weight") - F.col("weight_before")
    marked = state.withColumn("stopped", left * F.col("weight") >= F.col("limit") * weight_left)
    rest = marked.select(
        "*",
        F.sum(F.when(F.col("stopped"), F.col("limit")).otherwise(0)).over(everything).alias("given"),
        F.sum(F.when(F.col("stopped"), F.col("weight")).otherwise(0)).over(everything).alias("given_weight"),
    )
    share = ((F.col("total") - F.col("given")) * F.col("weight")).cast("double") / (F.col("all_weight") - F.col("given_weight"))
    return rest.select("source", "source_size", F.when(F.col("stopped"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = 3) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, epochs_whole, taken.

    Size is the number of blank-separated words. Every whole pass over a source takes all of it; what is left of the
    target is taken in the order of the MD5 of the id, cut inside the document where the budget ends, so that a source's
    taken words are its target rounded to a whole word. A source is dealt into ranges of that random key, as many as its
    rows call for: a source with a third of all rows is spread like the others. Totals per range, running over ranges,
    plus running sums inside a range, give the prefix sums.

    Null text has size 0, a null source is a source of its own, a null id sorts as the empty text. Repeated rows count
    each; equal keys go by size. With no words at all every target is 0. Other columns are ignored.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"),
    )
    sized = saved(sized)
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = source_targets(totals.select("source", "source_size"), epochs=epochs)
    plan = saved(
        totals.select("source", F.ceil(F.col("rows") / ROWS_PER_RANGE).alias("ranges"))
        .join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs_whole", whole.cast("long"))
    plan = plan.withColumn("budget", F.floor(F.col("target") + 0.5).cast("long") - F.col("epochs_whole") * F.col("source_size"))

    part = (F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 2.0**32 * F.col("ranges")).cast("long")
    plan = plan.withColumnRenamed("source", "s")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    dealt = sized.join(plan, sized["source"].eqNullSafe(plan["s"])).drop("s").withColumn("range", part)
    per_range = dealt.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select("source", "range", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("offset"))
    offsets = offsets.select(F.col("source").alias("s"), F.col("range").alias("r"), "offset")
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, placed["source"].eqNullSafe(offsets["s"]) & (placed["range"] == offsets["r"]))
    room = F.col("budget") - F.col("offset") - F.col("ahead")
    taken = F.col("epochs_whole") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), room))
    return placed.select("doc_id", "source", "size", "source_size", "target", "epochs_whole", taken.cast("long").alias("taken"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 3 * source_size AS lim, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
         coalesce(sum(3 * source_size) OVER p, 0) AS lim_before, coalesce(sum(w) OVER p, 0) AS w_before
  FROM s WINDOW p AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), m AS (
  SELECT *, (total - lim_before) * w >= lim * (all_w - w_before) AS stopped FROM r
), g AS (
  SELECT *, sum(CASE WHEN stopped THEN lim ELSE 0 END) OVER () AS given, sum(CASE WHEN stopped THEN w ELSE 0 END) OVER () AS given_w FROM m
), t AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN CAST(lim AS DOUBLE)
              ELSE CAST((total - given) * w AS DOUBLE) / CAST(all_w - given_w AS DOUBLE) END AS target FROM g
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t
), x AS (
  SELECT d.doc_id, d.source, d.size, u.source_size, u.target, u.epochs,
         CAST(floor(u.target + 0.5) AS BIGINT) - u.epochs * u.source_size AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - ahead)) AS BIGINT) AS taken
FROM x
"""
