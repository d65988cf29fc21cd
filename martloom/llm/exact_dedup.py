"""Exact duplicates: rows grouped by a 128-bit content hash, texts compared byte by byte inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.text import ascii_lower, documents, saved

CLASS = ("keep_id", "group_size")


def content(text: str) -> Column:
    """What is compared: the text with A-Z lower-cased; null counts as empty."""
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = F.md5, keep: str = "largest"
) -> DataFrame:
    """One row per row of `docs`: its id, digest, text_sha256, keep_id, group_size and kept.

    Copies meet in an aggregation by (digest, text) whose first half runs before the shuffle: a group that holds a third
    of all rows leaves each task as one row, and equal digests of different texts stay apart because the key comparison
    is on the bytes. Rows then look their group up by digest alone; digests shared by different texts (none is known for
    MD5; a weak digest in the tests has many) are looked up by digest and text.

    Null text is the empty text; a null id is smaller than any other and is kept only by a group without ids. Rows that
    repeat an id with the same text are the same document: both are kept or dropped, and both count in group_size.
    An empty table gives an empty result; other columns of `docs` are not looked at.
    """
    best = F.max if keep == "largest" else F.min
    read = docs.select(F.col(id_col).alias("doc_id"), content(text_col).alias("content")).withColumn("digest", digest(F.col("content")))
    texts = read.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("group_size"), best("doc_id").alias("keep_id"))
    groups = saved(
        texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    )
    rows = read.withColumn("text_sha256", F.sha2("content", 256))
    narrow = rows.select("doc_id", "digest", "text_sha256")
    found = narrow.join(groups.filter("texts = 1").drop("texts"), "digest")
    clashes = groups.filter("texts > 1").select("digest")
    if not clashes.isEmpty():
        apart = saved(texts.join(clashes, "digest", "left_semi"))
        found = found.unionByName(rows.join(apart, ["digest", "content"]).drop("content"))
    return found.select("doc_id", "digest", "text_sha256", *CLASS, F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row of each group of equal texts, with all columns of `docs`: one that has the id that is kept.

    The join is on id and digest, so a group of copies is spread. Where several rows of a group have that id (repeated rows,
    or none has an id) the one whose columns hash lowest stays. Columns of `docs` may have any names.
    """
    kept = duplicate_classes(docs, id_col, text_col, keep=keep).filter("kept")
    kept = saved(kept.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.md5(content(text_col)).alias("own"))
    same = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["own"] == kept["digest"])
    once = rows.join(kept.filter("n = 1"), same, "left_semi").select("row.*")
    if kept.filter("n > 1").isEmpty():
        return once
    several = rows.join(kept.filter("n > 1"), same, "left_semi").withColumn("place", F.xxhash64("row"))
    # keeps one candidate per key and task before the shuffle
    first = F.row_number().over(Window.partitionBy("id", "own").orderBy("place"))
    return once.unionByName(several.withColumn("first", first).filter("first = 1").select("row.*"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = duplicate_classes(documents(spark, sf_dir))
    return classes.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", "text_sha256")


OP4_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
