"""License scan: ordered signature rules behind keyword checks, overlaps resolved by tier and containment.

DataFrame functions only, each document inside its own row: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.license_rules import STEMS, rules
from martloom.llm.text import ascii_lower, documents, let, match_spans, running

# base phrases and their labels: fixed values
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TIER_SCORE = (1.0, 0.95, 0.8, 0.5)
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def in_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, one blank before, between and after them."""
    inner = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def at_borders(pattern: Column) -> Column:
    return F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Word numbers at which a phrase stands. Blanks are counted piece by piece between its places."""
    inside = phrase.count(" ")
    pieces = F.split(words, at_borders(F.lit(phrase)), -1)
    blanks = let(pieces, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), _blanks))
    found = F.transform(running(blanks), lambda n, i: n + i * inside - 1)
    return F.when(F.contains(words, F.lit(f" {phrase} ")), found).otherwise(F.expr("CAST(array() AS array<int>)"))


SPANS = "array<struct<start:int,back:int,tier:int,label:string>>"


def detections(words: Column) -> Column:
    """Places of all rules whose keyword occurs, in order of start, longer first; `back` is minus the end."""
    table = F.array(*[F.struct(F.lit(r.tier).alias("tier"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern")) for r in rules()])
    due = F.filter(table, lambda r: F.contains(words, r.keyword))
    placed = F.transform(
        due,
        lambda r: F.transform(
            match_spans(words, at_borders(r.pattern)),
            lambda s: F.struct(s.start.alias("start"), (-s.end).alias("back"), r.tier.alias("tier"), r.label.alias("label")),
        ),
    )
    return F.array_sort(F.flatten(placed))


def resolved(spans: Column) -> Column:
    """(labels, best): labels of the places that remain and their best tier, from places in order of start.

    A place gives way when it lies inside an earlier one of its own or a better tier. One pass keeps the furthest end
    for each tier, so the work grows with the number of places, not with their pairs.
    """
    tiers = range(len(TIER_SCORE))
    ends = ", ".join(f"'end{t}', -1" for t in tiers)
    start = F.expr(f"named_struct({ends}, 'labels', CAST(array() AS array<string>), 'best', {len(TIER_SCORE)})")

    def step(acc: Column, s: Column) -> Column:
        end = -s.back
        inside = F.lit(False)
        for t in tiers:
            inside = inside | ((s.tier >= t) & (acc[f"end{t}"] >= end))
        return F.struct(
            *[F.when(s.tier == t, F.greatest(acc[f"end{t}"], end)).otherwise(acc[f"end{t}"]).alias(f"end{t}") for t in tiers],
            F.when(inside | F.array_contains(acc.labels, s.label), acc.labels).otherwise(F.array_append(acc.labels, s.label)).alias("labels"),
            F.when(inside, acc.best).otherwise(F.least(acc.best, s.tier)).alias("best"),
        )

    return F.aggregate(spans, start, step, lambda a: F.struct(a.labels.alias("labels"), a.best.alias("best")))


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, starts (word numbers of base phrases), base_labels, labels, score.

    Base phrases always count; labels of the rules are added to theirs. score is the confidence of the best tier that
    remains (sentences of a notice 1, tags 0.95, names with a version 0.8, bare names and base phrases 0.5, nothing 0).

    Null and empty texts have no words, no labels and score 0; repeated rows are judged each; an empty table gives an
    empty result; other columns are ignored. Of two places with the same extent the better tier stays, then the label
    that sorts first.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), in_words(F.col(text_col)).alias("words"))
    any_stem = F.lit(False)
    for stem in STEMS:
        any_stem = any_stem | F.contains("words", F.lit(stem))
    rows = rows.select("doc_id", (_blanks(F.col("words")) - 1).alias("n_words"), "words", any_stem.alias("due"))
    nothing = F.expr(f"named_struct('labels', CAST(array() AS array<string>), 'best', {len(TIER_SCORE)})")
    rows = rows.select(
        "doc_id", "n_words", F.struct(*[phrase_starts(F.col("words"), p).alias(label) for p, label in PHRASES.items()]).alias("at"),
        F.when(F.col("due"), resolved(detections(F.col("words")))).otherwise(nothing).alias("found"),
    )
    base = F.array_compact(F.array(*[F.when(F.size(F.col("at")[label]) > 0, F.lit(label)) for label in PHRASES.values()]))
    rows = rows.select("doc_id", "n_words", F.concat(*[F.col("at")[label] for label in PHRASES.values()]).alias("starts"), base.alias("base_labels"), "found")
    scores = F.array(*[F.lit(x) for x in TIER_SCORE], F.lit(0.0))
    score = F.greatest(F.get(scores, F.col("found.best")), F.when(F.size("starts") > 0, F.lit(TIER_SCORE[-1])).otherwise(F.lit(0.0)))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", "found.labels")))
    return rows.select("doc_id", "n_words", "starts", F.array_sort("base_labels").alias("base_labels"), labels.alias("labels"), score.alias("score"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir)).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )
