"""State kept per key: newest row, upsert, increments since a mark."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.scalars import iso_z


def latest_wins(
    df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[str] | None = None, together: Sequence[str] = ()
) -> DataFrame:
    """One row per key, the one with the newest stamp. Equal stamps are decided by the remaining columns
    so that the result does not depend on row order.

    row_number() = 1 lets Spark keep one candidate per key and task before the shuffle, so a key with
    very many copies does not pile up in one task.

    With `together`, some of the keys, rows that share those are shuffled side by side, so what they have in common is
    compressed away. For keys whose parts are bounded, as the lines of an order: all of them meet in one task. Rows where
    these are null are dealt by the whole key.
    """
    rest = ties if ties is not None else [c for c in df.columns if c not in {*keys, newest}]
    order = [F.col(newest).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]]
    if together:
        loose = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in together])
        share = F.when(loose, F.xxhash64(*keys)).otherwise(F.lit(0).cast("long"))
        df = df.withColumn("_share", share).repartition(*together, "_share")
        keys = [*keys, "_share"]  # follows from the key; the window takes rows as they were dealt
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_share")


def high_water_mark(existing: DataFrame, column: str, default: str) -> DataFrame:
    """One row, one column "since": the highest stored stamp as ISO text, for the fetcher of the next payloads."""
    highest = F.coalesce(F.max(column), F.lit(default).cast("timestamp"))
    return existing.agg(iso_z(highest).alias("since"))


def since_mark(
    incoming: DataFrame, existing: DataFrame, column: str, default: str, inclusive: bool, existing_column: str | None = None
) -> DataFrame:
    """Rows of incoming at or after (inclusive) / after the highest stamp already stored.

    The mark is a scalar subquery, resolved inside the plan and pushed to the scan of incoming.
    """
    mark = existing.agg(F.coalesce(F.max(existing_column or column), F.lit(default).cast("timestamp"))).scalar()
    return incoming.filter(F.col(column) >= mark if inclusive else F.col(column) > mark)


def between_stamps(incoming: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """One chunk of a backfill: start and end are both exclusive."""
    return incoming.filter((F.col(column) > start) & (F.col(column) < end))


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], values: Sequence[str], counter: str, updated_at: str
) -> DataFrame:
    """New state after a batch of changes: a changed key takes its newest values and adds the number of
    changes to its counter, a new key starts counting at its number of changes, the rest stays.

    current holds each key once. Changes are reduced to a row per key before they are joined.
    """
    # "updated_at first" makes the newest change the greatest struct; the values settle equal stamps
    batch = changes.groupBy(*keys).agg(
        F.max(F.struct(updated_at, *values)).alias("_new"), F.count(F.lit(1)).alias("_changes")
    )
    old = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in (*values, counter, updated_at)])
    changed = F.col("_changes").isNotNull()
    pick = lambda c: F.when(changed, F.col(f"_new.{c}")).otherwise(F.col(f"_old_{c}")).alias(c)
    count = F.coalesce(F.col(f"_old_{counter}"), F.lit(0)) + F.coalesce(F.col("_changes"), F.lit(0))
    return old.join(batch, list(keys), "full").select(
        *keys, *[pick(c) for c in values], count.cast("long").alias(counter), pick(updated_at)
    )


def upsert_with_history(
    current: DataFrame, attempts: DataFrame, keys: Sequence[str], values: Sequence[str], counter: str, updated_at: str, error: str
) -> tuple[DataFrame, DataFrame]:
    """State and history after a batch of attempted changes, of which some failed (`error` is not null).

    Successful attempts change the state as `upsert` does and clear the error of their key. A failed one leaves value,
    counter and stamp alone: a key whose newest attempt failed only carries its error; if the key is not known yet there
    is no row for it. The history has one row per attempt, to be appended: keys, values (null where it failed), stamp,
    error and whether it succeeded. Of attempts with equal stamps a failed one counts as the newest.
    """
    done = F.col(error).isNull()
    state = upsert(current, attempts.filter(done), keys, values, counter, updated_at)
    # newest attempt of each key: whether it failed and how; an aggregation combines before the shuffle
    last = attempts.groupBy(*keys).agg(F.max(F.struct(updated_at, error)).alias("_last"))
    before = current.select(*keys, F.col(error).alias("_before")) if error in current.columns else current.select(*keys, F.lit(None).cast("string").alias("_before"))
    now = F.when(F.col("_last").isNotNull(), F.col(f"_last.{error}")).otherwise(F.col("_before")).alias(error)
    state = state.join(last, list(keys), "left").join(before, list(keys), "left").select(*state.columns, now)
    history = attempts.select(*keys, *[F.when(done, F.col(c)).alias(c) for c in values], updated_at, error, done.alias("succeeded"))
    return state, history
