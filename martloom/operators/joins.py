"""Joins on validity periods, day windows and text prefixes, each rewritten to an equality Spark can hash.

No broadcast is forced: the planner and AQE broadcast a side once its size is known to be small and
otherwise shuffle, where AQE splits hot partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.skew import SALT, spread_hot_keys


def point_in_time(
    facts: DataFrame,
    master: DataFrame,
    key: str,
    day: str,
    bring: Sequence[str],
    how: str = "left",
    spread: Sequence[str] = (),
) -> DataFrame:
    """Columns of the master row of the same key that is valid on the fact's day.

    Hash join on the key with the period as residual condition. Overlapping periods multiply rows.
    spread: columns by which the facts of a hot key are dealt out (facts that were not summed before).
    """
    side = master.select(key, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *bring)
    salted = F.lit(True)
    if spread:
        facts, side = spread_hot_keys(facts, side, [key], spread)
        side = side.withColumnRenamed(SALT, "_side_salt")
        salted = F.col(SALT) == F.col("_side_salt")
    side = side.withColumnRenamed(key, "_key")
    on = (F.col(key) == F.col("_key")) & salted & F.col(day).between(F.col("_from"), F.col("_to"))
    return facts.join(side, on, how).drop("_key", "_from", "_to", SALT, "_side_salt")


EDGES = 1_023  # cells that a fact is placed in by a search; finer periods share a cell


def _edges(rules: DataFrame) -> DataFrame:
    """One row, one column: the sorted days on which a rule begins or has ended; a calendar bounds them, however many rules
    there are."""
    days = rules.select(F.explode(F.array("valid_from", F.date_add("valid_to", 1))).alias("_day")).filter("_day IS NOT NULL")
    return days.distinct().agg(F.sort_array(F.collect_list("_day")).alias("_edges"))


def _cell_size(edges: Column, cells: int) -> Column:
    """Segments of a cell."""
    return F.greatest(F.ceil(F.size(edges) / cells).cast("int"), F.lit(1))


def segments(rules: DataFrame, bring: Sequence[str], cells: int) -> DataFrame:
    """Rules cut at every day on which any of them begins or has ended: (_cell, _from, _to, bring), one row per rule and
    segment. Segments don't overlap; those of a cell follow each other, and a cell is one segment if `cells` allow."""
    edges = F.col("_edges")
    known = rules.filter("valid_from <= valid_to").withColumn("_edges", _edges(rules).scalar())
    first, last = F.array_position(edges, F.col("valid_from")), F.array_position(edges, F.date_add("valid_to", 1))
    listed = known.select("*", F.explode(F.sequence((first - 1).cast("int"), (last - 2).cast("int"))).alias("_no"))
    return listed.select(
        F.floor(F.col("_no") / _cell_size(edges, cells)).cast("int").alias("_cell"), F.get(edges, F.col("_no")).alias("_from"),
        F.date_sub(F.get(edges, F.col("_no") + 1), 1).alias("_to"), *bring,
    )


def place(sorted_values: Column, x: Column, most: int) -> Column:
    """Place of the last of the sorted values (`most` of them at most) that is not above x, from 0; -1 if all are, or x is
    null. A binary search: each step tries to go on by half the distance of the one before."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])

    def search(values: Column) -> Column:
        onward = lambda at, step: F.when(F.get(values, at + step) <= x, at + step).otherwise(at)
        return F.aggregate(steps, F.lit(-1), onward)

    # a transform of one element names the array inside the expression
    return F.get(F.transform(F.array(sorted_values), search), F.lit(0))


def valid_on(facts: DataFrame, rules: DataFrame, day: str, bring: Sequence[str], cells: int = EDGES) -> DataFrame:
    """Every rule valid on the fact's day; facts without a rule drop out, overlapping rules multiply.

    A period has no key to join on. The rules are cut into segments, the segments dealt over cells, and a search in the
    first days of the cells, a bounded array, gives each fact the cell it falls into: that is the equality of the join.
    Within a cell the segment's own days decide, so a fact meets each rule once. Facts spread over as many keys as there
    are segments, `cells` at most. Rules without a first or last day are valid never.
    """
    edges = F.col("_edges")
    starts = _edges(rules).select(F.filter(edges, lambda _, i: i % _cell_size(edges, cells) == 0).alias("starts"))
    known = facts.withColumn("_starts", starts.scalar())
    placed = known.withColumn("_fact_cell", place(F.col("_starts"), F.col(day), cells)).drop("_starts")
    on = (F.col("_fact_cell") == F.col("_cell")) & F.col(day).between(F.col("_from"), F.col("_to"))
    return placed.join(segments(rules, bring, cells), on, "inner").drop("_fact_cell", "_cell", "_from", "_to")


def list_days(df: DataFrame, start: Column, days: int, name: str) -> DataFrame:
    """One row per day of [start, start + days]. Rows without a start stay once with a null day.

    Turns "date between start and start + n" into an equality on the day.
    """
    return df.withColumn(name, F.explode_outer(F.sequence(start, F.date_add(start, days))))


BITS = 1 << 19  # of the filter of a month, 64 KB


def _bits_of(text: Column, bits: int) -> tuple[Column, Column]:
    """Two bits for a text, from the two halves of its hash."""
    h = F.xxhash64(text)
    return h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))


def _word(bit: Column) -> Column:
    return F.shiftright(bit, 6).cast("int")


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))


def text_filters(texts: DataFrame, text: str, group: str, bits: int = BITS) -> DataFrame:
    """(group, _words): for each group a Bloom filter of its texts, `bits` bits as an array of 64-bit words.

    Bits are combined word by word before and after the shuffle, so a group costs a task as many rows as it has words
    at most, however many texts it has. Null texts are left out.
    """
    known = texts.filter(F.col(text).isNotNull() & F.col(group).isNotNull())
    marks = known.select(group, F.explode(F.array(*_bits_of(F.col(text), bits))).alias("_bit"))
    words = marks.groupBy(group, _word(F.col("_bit")).alias("_no")).agg(F.bit_or(_mask(F.col("_bit"))).alias("_word"))
    every = F.explode(F.sequence(F.lit(0), F.lit(bits // 64 - 1))).alias("_no")
    empty = words.select(group).distinct().select(group, every, F.lit(0).cast("long").alias("_word"))
    dense = words.unionByName(empty).groupBy(group, "_no").agg(F.bit_or("_word").alias("_word"))
    in_order = F.sort_array(F.collect_list(F.struct("_no", "_word")))
    return dense.groupBy(group).agg(in_order.getField("_word").alias("_words"))


def may_hold(words: Column, text: Column, bits: int = BITS) -> Column:
    """Whether a text is in a filter; true for some texts that are not. Plain array access, so it stays in generated code."""
    one, two = (F.get(words, _word(b)).bitwiseAND(_mask(b)) != 0 for b in _bits_of(text, bits))
    return one & two


def prefix_totals(
    texts: DataFrame,
    text: str,
    prefixes: DataFrame,
    prefix: str,
    month: str,
    sums: Mapping[str, str],
    bits: int = BITS,
) -> DataFrame:
    """Per (month, prefix): sums over all texts of the month that start with the prefix.

    Instead of comparing every text with every prefix, each text is cut at the lengths that occur among
    the month's prefixes and the pieces are summed. A filter of the month's prefixes drops the pieces that are none of
    them before they are summed and shuffled; the few it lets through by chance are rows of the result that no prefix
    looks up. Summing combines before the shuffle, so a prefix that matches everything ("/") costs one row per task.
    """
    known = prefixes.select(month, prefix).distinct()
    lengths = (
        known.select(month, F.length(prefix).alias("_length"))
        .distinct()
        .groupBy(month)
        .agg(F.collect_list("_length").alias("_lengths"))
    )
    # both sides have one row per calendar month: as many lengths as the longest URL has characters at most, and one filter
    cut = (
        texts.join(F.broadcast(lengths), month)
        .withColumn("_n", F.explode(F.filter("_lengths", lambda n: n <= F.length(text))))
        .withColumn(prefix, F.substring(F.col(text), F.lit(1), F.col("_n")))
        .drop("_lengths", "_n")
        .join(F.broadcast(text_filters(known, prefix, month, bits)), month)
        .filter(may_hold(F.col("_words"), F.col(prefix), bits))
    )
    return cut.groupBy(month, prefix).agg(*[F.sum(src).alias(out) for out, src in sums.items()])


def newest_before(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    version_day: str,
    max_age_days: int,
    bring: Sequence[str],
) -> DataFrame:
    """As-of join: each (day, key) of the facts with the newest version loaded on or before that day and
    not older than max_age_days. Facts without such a version drop out.

    The versions of a key are first turned into the periods in which they are the newest one, so the
    facts meet at most one version and need no ranking after the join.
    """
    w = Window.partitionBy(key).orderBy(version_day)
    one_a_day = versions.groupBy(key, version_day).agg(F.max(F.struct(*bring)).alias("_v"))
    periods = one_a_day.select(
        key,
        F.col(version_day).alias("valid_from"),
        F.least(
            F.date_add(F.col(version_day), max_age_days),
            F.date_sub(F.lead(version_day).over(w), 1),
        ).alias("valid_to"),
        *[F.col(f"_v.{c}").alias(c) for c in bring],
    )
    return point_in_time(facts, periods, key, day, bring, "inner")
