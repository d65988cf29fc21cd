"""Spelling variants: frequent words one edit apart, found through words written in a few symbols.

Letters are hashed to a handful of symbols. All words one edit away from a reduced word are listed (there are few, as there
are few symbols) and met with the reduced vocabulary; words behind a meeting are candidates, compared letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from martloom.llm.text import LOWER, UPPER, documents, saved

LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = "abcdef"
SHORTEST = 5  # code points of a word
RAREST = 3  # occurrences of a word
CLEARLY = 2  # times as frequent as the word it is the form of
BENT = 97  # one in so many (document, word) pairs loses a letter
CROWD = 64  # words of one reduced word; beyond, they meet in halves
FLUSH = 400_000  # words a task counts before it hands them on
LONG = 1 << 20  # characters of a text whose words are not listed at once
CELLS = 1 << 20  # hashes made at a time
KEY = 16  # longer reduced words are known by their digest

_RUNS = re.compile(f"[a-z{LETTERS[26]}-{LETTERS[-1]}]+")
_LOWER = str.maketrans(UPPER, LOWER)


# ------------------------------------------------------------------ vocabulary


def runs_of(doc_id: object, text: str | None) -> dict[str, int]:
    """Occurrences of each run of letters, A-Z lower-cased; a hash of document and run takes a letter out of some."""
    text = (text or "").translate(_LOWER)
    found = Counter(_RUNS.findall(text) if len(text) < LONG else (m.group() for m in _RUNS.finditer(text)))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    bent = [(run, h) for run in found if not (h := zlib.crc32(run.encode(), start)) % BENT]
    # all are taken out before any goes back: a run that loses a letter may become another of them, and loses one only
    for (run, h), n in zip(bent, [found.pop(run) for run, _ in bent], strict=True):
        at = h % len(run)
        bent_run = run[:at] + run[at + 1 :]
        if bent_run:
            found[bent_run] += n
    return found


def count_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            for run, n in runs_of(doc_id, text).items():
                if len(run) >= SHORTEST:
                    counts[run] += n
            if len(counts) > FLUSH:
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                counts.clear()
    if counts:
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): distinct words of all texts. Tasks count first, so a word that is everywhere leaves each as a few rows."""
    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = read.mapInPandas(count_runs, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= RAREST)


# ------------------------------------------------------------------ reduced words

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
BACK = pow(BASE, -1, 1 << 64)


def reduced(word: Column) -> Column:
    """The word in symbols; a letter's symbol comes from a hash of it."""
    symbols = "".join(SYMBOLS[(zlib.crc32(c.encode()) >> 8) % len(SYMBOLS)] for c in LETTERS)
    return F.translate(word, LETTERS, symbols)


def _hashed(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of BASE, each digit's term, and the sums of the terms before each place, of rows of equal length."""
    powers = np.full(digits.shape[1] + 1, BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    terms = digits * powers[:-1]
    sums = np.zeros((len(digits), digits.shape[1] + 1), np.uint64)
    np.cumsum(terms, axis=1, dtype=np.uint64, out=sums[:, 1:])
    return powers, terms, sums


def neighbourhood(digits: np.ndarray) -> np.ndarray:
    """Hashes of the words themselves and of all words one edit away, a row for each; words are digits 1 to len(SYMBOLS).

    A word's hash is the sum of its digits times powers of BASE, modulo 2 ** 64, so each edit changes it in one step: what
    stands before a place stays, what stands after it moves by one power.
    """
    powers, terms, sums = _hashed(digits)
    whole, alphabet = sums[:, -1:], np.arange(1, len(SYMBOLS) + 1, dtype=np.uint64)
    after = whole - sums
    parts = [whole, sums[:, :-1] + after[:, 1:] * np.uint64(BACK)]
    for digit in alphabet:
        parts.append(whole - terms + digit * powers[:-1])
        parts.append(sums + digit * powers + after * np.uint64(BASE))
    return np.concatenate(parts, axis=1)


def _by_length(words: pd.Series, of) -> list:
    """`of` (rows of digits to rows of hashes) for words grouped by length, a bounded number at a time."""
    out: list = [None] * len(words)
    sizes = words.str.len().to_numpy()
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        step = max(1, CELLS // (int(size) * 2 * len(SYMBOLS)))
        for i in range(0, len(places), step):
            some = places[i : i + step]
            body = np.frombuffer("".join(words.iloc[some]).encode(), np.uint8).reshape(len(some), size)
            for place, row in zip(some, of((body - (ord(SYMBOLS[0]) - 1)).astype(np.uint64)), strict=True):
                out[place] = row
    return out


@F.pandas_udf(LongType())
def word_hash(words: pd.Series) -> pd.Series:
    return pd.Series(np.array(_by_length(words, lambda d: _hashed(d)[2][:, -1]), np.uint64).view(np.int64))


@F.pandas_udf(ArrayType(LongType()))
def neighbour_hashes(words: pd.Series) -> pd.Series:
    return pd.Series(_by_length(words, lambda d: [np.unique(r).view(np.int64) for r in neighbourhood(d)]))


def reduced_links(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reduced vocabulary (key, size, length, hash) and its links (key, other, shorter): one edit or none apart.

    Each reduced word is there once however many words it stands for, so no key of this join is crowded. Of the two ends
    of a link the larger (by length, then key) lists it; `shorter` is the smaller of both lengths.
    """
    short = words.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first("reduced").alias("reduced"))
    short = saved(short.select("key", "size", "reduced", F.length("reduced").alias("length"), word_hash("reduced").alias("hash")))
    near = short.select("key", "length", F.explode(neighbour_hashes("reduced")).alias("hash"))
    ends = short.select(F.col("key").alias("other"), F.col("length").alias("shorter"), "hash")
    below = (F.col("shorter") < F.col("length")) | ((F.col("shorter") == F.col("length")) & (F.col("other") <= F.col("key")))
    return short.drop("reduced"), near.join(ends, "hash").filter(below).select("key", "other", "shorter")


# ------------------------------------------------------------------ words one edit apart


def _meeting(word: Column, crowded: Column, halves: list[Column]) -> Column:
    """Where the word waits for words under a reduced word: in one place, or by its halves if the place is crowded.

    One edit leaves the first or the last half of the shorter length as it is, so two near words share a half.
    """
    kind = "array<struct<half:int,side:int,letters:string>>"
    sides = [
        F.struct(h.alias("half"), F.lit(side).alias("side"), letters.alias("letters"))
        for h in halves
        for side, letters in enumerate((F.substr(word, F.lit(1), h), F.substr(word, -h)))
    ]
    together = F.struct(F.lit(0).alias("half"), F.lit(0).alias("side"), F.lit("").alias("letters"))
    return F.when(crowded, F.array_distinct(F.array(*sides)).cast(kind)).otherwise(F.array(together).cast(kind))


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, a_n, b, b_n), each pair of words (word, n) exactly one inserted, deleted or replaced code point apart, once.

    `crowd` sets the layout only: reduced words that stand for more words than that are met by reduced word and half.
    """
    words = words.withColumn("reduced", reduced(F.col("word")))
    words = saved(words.withColumn("key", F.when(F.length("reduced") <= KEY, F.col("reduced")).otherwise(F.md5("reduced"))))
    short, links = reduced_links(words)
    sizes = short.select("key", (F.col("size") > crowd).alias("crowded"), "length")
    # links know how their other end is laid out
    links = links.join(sizes.select(F.col("key").alias("other"), "crowded"), "other")

    def half(length: Column) -> Column:
        return F.floor(length / 2).cast("int")

    here = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), "key").join(links, "key")
    here = here.withColumn("at", F.explode(_meeting(F.col("a"), F.col("crowded"), [half(F.col("shorter"))])))
    there = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), "key").join(sizes, "key")
    own, less = half(F.col("length")), half(F.col("length") - 1)
    there = there.withColumn("at", F.explode(_meeting(F.col("b"), F.col("crowded"), [own, less])))
    here = here.select("a", "a_n", "key", "other", "shorter", "at.*")
    there = there.select("b", "b_n", F.col("key").alias("other"), "at.*")
    met = here.join(there, ["other", "half", "side", "letters"])
    # words of one reduced word meet both ways round; words that share both halves meet in the first
    once = (F.col("key") != F.col("other")) | (F.col("a") < F.col("b"))
    first = (F.col("side") == 0) | (F.substr("a", F.lit(1), F.col("half")) != F.substr("b", F.lit(1), F.col("half")))
    return met.filter(once & first & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last.

    Each round doubles the steps taken. A form is at least CLEARLY times as frequent as its word, so there is no
    circle, and 64 steps, six rounds, pass any count.
    """
    found = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = saved(found.join(step, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.isnotnull("beyond").alias("moved")))
        found = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return found


def spelling_variants(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row per word of the texts: word, n, n_near, form, form_n, root.

    Words are runs of letters with A-Z lower-cased, of 5 code points and 3 occurrences at least; near words are one
    edit apart. The form is the most frequent near word (of equal ones the first in code-point order), if it is at least
    twice as frequent as the word; root follows forms to the end. Null and empty texts have no words, a null id counts
    as the empty one, repeated rows count as often as they are there; an empty table gives an empty result. Words of
    any length are treated alike; columns of `docs` other than doc_id and text are not looked at.
    """
    words = saved(vocabulary(docs))
    pairs = near_words(words, crowd)
    ends = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    ).alias("end")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    near = pairs.select(ends).select("end.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    clear = -F.col("best.order") >= CLEARLY * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(clear, F.col("best.near")).alias("form"), F.when(clear, -F.col("best.order")).alias("form_n"),
    )
    found = saved(found)
    ended = roots(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(ended, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")
