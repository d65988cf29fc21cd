"""Connected components of a table of links, by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.text import saved


def _star(pairs: DataFrame, keep_equal: bool) -> DataFrame:
    """For each u of (u, v): link every v, or u itself, to the smallest node of the neighbourhood.

    The minimum of a hub leaves each task as one row. Both sides of the join come straight out of a shuffle, so a hub
    that holds much of the table can be split at run time.
    """
    smallest = saved(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    joined = pairs.join(smallest, "u")
    if keep_equal:  # small star: u is the larger end of each pair
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select("u", F.col("m").alias("v")))
    else:  # large star: only neighbours above u move
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), root the smallest node reachable; nodes of any one orderable type.

    Each round halves the distance to the root at least in the usual case and never loses a link's connection; it ends when a
    round changes nothing. Rounds are written to the shared folder. Links of a node with itself, repeated links and
    links with a null end are ignored; an empty table gives an empty result.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a <> b").distinct()
    pairs, seen = saved(pairs), None
    while True:
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = mark
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = saved(_star(saved(_star(both, keep_equal=False)), keep_equal=True))
