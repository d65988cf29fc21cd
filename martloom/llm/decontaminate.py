"""Benchmark decontamination: Wu-Manber search of whole texts for windows of test items, with words as symbols."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.text import WORD, documents, stored

WINDOW = 10
BLOCK = 2  # words of a shift block
SET_WINDOWS = 200_000  # windows of one pattern set; more are searched for in further sets

_WORDS = re.compile(WORD.encode())  # on UTF-8 bytes: every byte from 0x80 on is a word byte


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased; null has none."""
    return _WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())


def windows_of(text: str | None, size: int = WINDOW) -> set[tuple[bytes, ...]]:
    """Every run of `size` words of an item; all of a shorter one."""
    words = words_of(text)
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


class Patterns:
    """Wu-Manber tables for windows of one length.

    `shift` has, for each block of words in a window, how far the window's end is from the block's last place; a block
    that is in no window allows the longest step. `suffix` has, for each block that ends a window, the windows by first
    word; only those that share both are compared word by word.
    """

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.length = len(next(iter(windows)))
        self.block = min(BLOCK, self.length)
        self.step = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.suffix: dict[tuple[bytes, ...], dict[bytes, list[tuple[tuple[bytes, ...], set[str]]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, self.length + 1):
                key = window[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.step), self.length - end)
            self.suffix.setdefault(window[self.length - self.block :], {}).setdefault(window[0], []).append((window, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(start, items) of each occurrence, in order."""
        shift, step, block, length = self.shift, self.step, self.block, self.length
        end, n = length, len(words)
        while end <= n:
            key = tuple(words[end - block : end])
            jump = shift.get(key, step)
            if jump:
                end += jump
                continue
            start = end - length
            for window, items in self.suffix[key].get(words[start], ()):
                if tuple(words[start:end]) == window:
                    yield start, items
                    break  # windows are distinct
            end += 1


def pattern_sets(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> Iterator[list[Patterns]]:
    """Tables for at most about `limit` windows at a time; items arrive at the driver one partition at a time."""

    def tables(found: dict[tuple[bytes, ...], set[str]]) -> list[Patterns]:
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for w, items in found.items():
            by_length.setdefault(len(w), {})[w] = items
        return [Patterns(by_length[k]) for k in sorted(by_length)]

    found: dict[tuple[bytes, ...], set[str]] = {}
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    for row in items.toLocalIterator():
        for w in windows_of(row.text, window):
            found.setdefault(w, set()).add(row.item or "")
            if len(found) >= limit:
                yield tables(found)
                found = {}
    if found:
        yield tables(found)


SCANNED = "n_words long, items array<string>, hits array<struct<start:int,end:int>>"


def scanner(shared: Broadcast[list[Patterns]]):
    """Column function: number of words, items found, and the hit stretches of words (merged, end exclusive)."""

    @F.pandas_udf(SCANNED)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for text in batch:
                words = words_of(text)
                items: set[str] = set()
                places: list[tuple[int, int]] = []
                for p in shared.value:
                    for start, names in p.search(words):
                        items |= names
                        places.append((start, start + p.length))
                out.append((len(words), sorted(items), merged(places)))
            yield pd.DataFrame(out, columns=["n_words", "items", "hits"])

    return scan


def merged(places: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Overlapping and touching stretches joined."""
    out: list[list[int]] = []
    for start, end in sorted(places):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": a, "end": b} for a, b in out]


def _covered(hits: Column) -> Column:
    """Number of words in sorted stretches that may overlap."""
    start = F.expr("named_struct('at', 0, 'n', 0L)")

    def step(acc: Column, h: Column) -> Column:
        fresh = F.greatest(h.end - F.greatest(acc.at, h.start), F.lit(0))
        return F.struct(F.greatest(acc.at, h.end).alias("at"), (acc.n + fresh).alias("n"))

    return F.aggregate(F.array_sort(hits), start, step, lambda a: a.n)


def contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, set_windows: int = SET_WINDOWS
) -> DataFrame:
    """`docs` with a struct column `contamination`: n_words, n_hit, items (sorted), hits (stretches of words), contaminated.

    A document word inside any occurrence of a window of `window` consecutive words of an item is hit; an item with
    fewer words is one window. The search is a map over the documents: nothing is shuffled. What is broadcast holds at most
    about `set_windows` windows. A larger benchmark takes several sets, one after the other: the documents are stored once,
    each set's hits are stored before the next set is made, and the last one's tables are let go, so neither the driver
    nor a worker ever holds more than a set.

    Null texts and texts without words have no words and no hits; null item texts have no windows; a null item id is
    named by the empty text; items that share an id count once. An empty benchmark hits nothing. Repeated rows are each
    searched. Other columns of `docs` are passed on, whatever their names (one named `contamination` is replaced).
    """
    spark = docs.sparkSession
    row = F.struct(*[c for c in docs.columns if c != "contamination"]).alias("row")
    sets = pattern_sets(benchmark, "item_id", "text", window, set_windows)
    shared = spark.sparkContext.broadcast(next(sets, []))
    following = next(sets, None)
    if following is None:
        return _told(docs.select(row, scanner(shared)(F.col(text_col)).alias("scan")))
    texts = stored(docs.select(row, F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("number")))
    scans = []
    while True:
        found = texts.select("number", scanner(shared)(F.col("text")).alias("scan"))
        scans.append(stored(found.filter(F.size("scan.hits") > 0) if scans else found))
        shared.destroy()
        if following is None:
            break
        shared = spark.sparkContext.broadcast(following)
        following = next(sets, None)
    flat = lambda c: F.flatten(F.collect_list(f"scan.{c}")).alias(c)  # noqa: E731  (one entry for each set at most)
    scan = F.struct(F.max("scan.n_words").alias("n_words"), flat("items"), flat("hits")).alias("scan")
    together = reduce(DataFrame.unionByName, scans).groupBy("number").agg(scan)
    return _told(texts.join(together, "number").select("row", "scan"))


def _told(scanned: DataFrame) -> DataFrame:
    """Rows with their contamination, from (row, scan)."""
    items, hits = F.array_sort(F.array_distinct("scan.items")), F.col("scan.hits")
    found = F.struct(
        F.col("scan.n_words").alias("n_words"), _covered(hits).alias("n_hit"), items.alias("items"), hits.alias("hits"),
        (F.size(hits) > 0).alias("contaminated"),
    )
    return scanned.select("row.*", found.alias("contamination"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` in which no window of the benchmark occurs."""
    return contamination(docs, benchmark, text_col).filter(~F.col("contamination.contaminated")).drop("contamination")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(documents(spark, sf_dir).select("doc_id", "text"), benchmark)
    c = F.col("contamination")
    return found.select(
        "doc_id", c.n_words.alias("n_words"), c.n_hit.alias("n_hit"), F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"), c.contaminated.alias("contaminated"),
    )


OP3_SQL = r"""
WITH lowered AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), d AS (
  SELECT doc_id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), iw AS (
  SELECT item_id, least(10, len(w)) AS k, unnest(range(1, CAST(len(w) - least(10, len(w)) + 2 AS BIGINT))) AS a, w FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[a:a + k - 1], ' ') AS s FROM iw
), lengths AS (
  SELECT DISTINCT k FROM windows
), dw AS (
  SELECT doc_id, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS a, w FROM d, lengths WHERE len(w) >= k
), found AS (
  SELECT dw.doc_id, windows.item_id, dw.a, dw.k
  FROM dw JOIN windows ON dw.k = windows.k AND array_to_string(dw.w[dw.a:dw.a + dw.k - 1], ' ') = windows.s
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS list
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""
