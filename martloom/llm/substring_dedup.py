"""Repeated passages by content-defined chunks: a gear rolling hash sets the cuts, chunks are matched by digest.

A cut stands where the rolling hash of the last bytes is smaller than at every place near by, so cuts depend on the
bytes around them only: text inserted before a passage shifts it and leaves the cuts inside it as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from martloom.llm.text import documents, saved, stored

REACH = 16  # bytes the rolling hash sees
NEAR = 20  # a cut's hash is the smallest of so many places before and after; chunks are twice as long on average
SHORTEST = 48  # characters of a passage that is reported
GEAR = np.random.default_rng(64).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: sum of GEAR over the last REACH bytes, two bits up for each byte back, 32 bits.

    Doubling the reach joins each sum with the one before it, so it takes four steps instead of sixteen.
    """
    h = GEAR[data]
    reach = 1
    while reach < REACH:
        joined = h.copy()
        joined[reach:] += h[:-reach] << np.uint32(2 * reach)
        h, reach = joined, 2 * reach
    return h


def spaced(places: np.ndarray) -> np.ndarray:
    """Sorted places without those that are within NEAR of the one kept before.

    Only equal hashes stand so close: a text that repeats itself. Its cuts keep the rhythm of the repetition, so all its
    chunks but the first and the last are the same, wherever the repetition starts and however long it is.
    """
    if not len(places) or (np.diff(places) > NEAR).all():
        return places
    kept, last = [], -NEAR - 1
    for p in places.tolist():
        if p - last > NEAR:
            kept.append(p)
            last = p
    return np.array(kept, np.int64)


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of chunks, the last one the end of the data; before a character's first byte, never inside one."""
    n = len(data)
    if n <= 2 * NEAR:
        return np.array([n], np.int64) if n else np.zeros(0, np.int64)
    h = rolling(data)
    low, span = h, 1
    while span * 2 <= NEAR + 1:  # low[i]: smallest of the places i to i + span - 1
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    ahead = np.minimum(low[: n - NEAR], low[NEAR + 1 - span :])  # of i to i + NEAR, for i < n - NEAR
    inner = np.arange(NEAR, n - NEAR)
    before = ahead[inner - NEAR]  # of i - NEAR to i
    after = ahead[inner]
    at = inner[(h[inner] == np.minimum(before, after))]
    ends = spaced(at) + 1
    inside = (data[np.minimum(ends, n - 1)] & 0xC0) == 0x80
    while inside.any():
        ends = ends + inside
        inside = (ends < n) & ((data[np.minimum(ends, n - 1)] & 0xC0) == 0x80)
    ends = np.unique(ends[ends < n])
    return np.append(ends, n)


def chunks_of(text: str) -> tuple[list[int], list[int], np.ndarray]:
    """(starts, ends) in code points and 128-bit digests as pairs of longs, of every chunk of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    ends = cuts(data)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    digests = b"".join([xxhash.xxh3_128_digest(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist())])
    return chars[starts].tolist(), chars[ends].tolist(), np.frombuffer(digests, "<i8").reshape(-1, 2)


CHUNKS = "row long, id long, start int, end int, again boolean, d1 long, d2 long"


def _chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of texts; `again` marks those that the text holds further up as well."""
    for batch in batches:
        for at in range(0, len(batch), 500):
            rows, ids, starts, ends, again, digests = [], [], [], [], [], [np.zeros((0, 2), np.int64)]
            part = batch.iloc[at : at + 500]
            for row, i, text in zip(part.row, part.id, part.text):
                s, e, d = chunks_of(text)
                rows += [row] * len(s)
                ids += [i] * len(s)
                starts += s
                ends += e
                repeats = np.ones(len(s), bool)
                repeats[np.unique(d.view("V16").ravel(), return_index=True)[1]] = False
                again += repeats.tolist()
                digests.append(d)
            d = np.concatenate(digests)
            yield pd.DataFrame({"row": rows, "id": ids, "start": starts, "end": ends, "again": again, "d1": d[:, 0], "d2": d[:, 1]})


NO_ID = -(1 << 63)  # stands for a null id


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with a text: row (a number no other row has), id, text. The number holds only until it is read again."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    return rows.filter(F.length("text") > 0)


def _passages(rows: DataFrame, shortest: int, within: bool) -> DataFrame:
    """Passages of numbered rows, ended where chunks that stay meet others: row, id, start, end, n_chunks, n_removed, n_own, first."""
    chunks = stored(rows.mapInPandas(_chunked, CHUNKS))
    # numbers of fixed width only, so digests are counted by hash before and after the shuffle, without a sort
    counted = chunks.groupBy("d1", "d2").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.min_by("row", "id").alias("first_row"),
        F.min("row").alias("low"), F.max("row").alias("high"),
    )
    alone = F.col("low") == F.col("high")
    shared = stored(counted.filter("n > 1" if within else "low < high").select("d1", "d2", "first", "first_row", alone.alias("alone")))
    removed = F.col("again") | (F.col("first_row") != F.col("row"))
    found = chunks.join(shared, ["d1", "d2"]).select("row", "id", "start", "end", "first", "alone", removed.cast("int").alias("removed"))
    by_place = Window.partitionBy("row").orderBy("start")
    opened = found.withColumn("opens", (F.coalesce(F.lag("end").over(by_place), F.lit(-1)) < F.col("start")).cast("int"))
    turned = opened.withColumn("turns", F.greatest("opens", F.abs(F.col("removed") - F.lag("removed", 1, 0).over(by_place))))
    so_far = by_place.rowsBetween(Window.unboundedPreceding, 0)
    numbered = turned.withColumn("stretch", F.sum("opens").over(so_far)).withColumn("passage", F.sum("turns").over(so_far))
    passages = numbered.groupBy("row", "stretch", "passage").agg(
        F.min("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_chunks"),
        F.sum("removed").alias("n_removed"), F.count_if("alone").alias("n_own"), F.min("first").alias("first"),
    )
    whole = Window.partitionBy("row", "stretch")
    sized = passages.withColumn("size", F.max("end").over(whole) - F.min("start").over(whole))
    return sized.filter(F.col("size") >= shortest).drop("size", "stretch", "passage")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, within: bool = False
) -> DataFrame:
    """Passages that other rows hold too: doc_id, start, end (code points), n_chunks, n_removed, n_own, first_doc_id, kept.

    A chunk is repeated when its digest occurs in two rows or more, or, with `within`, at two places of the same row;
    neighbouring repeated chunks are reported from `shortest` characters on. Each chunk stays at its first place, in the
    row with the smallest id; where chunks that stay meet chunks that don't, a passage ends and the next begins, so
    `kept` holds for all of a passage (n_removed is 0, or n_chunks) and one copy of everything is kept. first_doc_id is
    the smallest id its chunks stay in. n_own of the chunks are repeated within this row only: a passage of which all are
    is the row's own repetition, no other row has a part of it. A passage's first and last chunk may reach beyond it in a document
    where its surroundings differ, so up to about 60 characters at either end are not reported.

    Digests are counted before the shuffle, and the join that finds repeated chunks has both sides straight from a
    shuffle, so a chunk that every document has is split at run time. Null and empty texts have no chunks. Every row is
    a document of its own: of rows that share an id, or have none, one comes first, by chunk. Null ids are smaller than all
    others. An empty table gives an empty result; other columns are ignored.
    """
    passages = _passages(_numbered(docs, id_col, text_col), shortest, within)
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return passages.select(
        named("id").alias("doc_id"), "start", "end", "n_chunks", "n_removed", "n_own", named("first").alias("first_doc_id"), (F.col("n_removed") == 0).alias("kept")
    )


@F.pandas_udf(StringType())
def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Texts without their spans, which are sorted and apart."""
    cut = ["".join(t[a:b] for a, b in zip([0, *e], [*s, len(t)])) for t, s, e in zip(texts, starts, ends)]
    return pd.Series(cut, dtype=object)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """The rows of `docs`, with the passages that are not kept cut out of their texts; a text may become empty.

    Repeats within a row count as well. Of every repeated chunk one copy stays. Null and empty texts pass as they are.
    Columns of `docs` may have any names.
    """
    number = F.monotonically_increasing_id().alias("row")
    whole = stored(docs.select(F.struct(*docs.columns).alias("whole"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), number))
    numbered = whole.filter(F.length("text") > 0).select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "text")
    gone = _passages(numbered, shortest, True).filter("n_removed > 0")
    gone = saved(gone.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone")))
    found = whole.join(gone, "row", "left")
    left = found.filter("gone IS NOT NULL").withColumn("left", _cut(F.col("text"), F.col("gone.start"), F.col("gone.end")))
    left = left.unionByName(found.filter("gone IS NULL").withColumn("left", F.col("text")))
    return left.select(*[F.col("left").alias(c) if c == text_col else F.col("whole")[c].alias(c) for c in docs.columns])


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir), within=True)
