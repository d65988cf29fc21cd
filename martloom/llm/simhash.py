"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two halves. Two fingerprints that differ in at most three bits differ in at most one
bit of one half: each half is stored as it is and probed with every value that sets one more bit (of a pair that differs
in one bit, one side has it clear), so the probe table has about 34 rows per fingerprint, whatever the corpus. Matches
are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from martloom.llm.components import components
from martloom.llm.text import documents, saved, stored

SEED = 42
RADIUS = 3
SHINGLE = 3
CROWD = 300  # stored fingerprints of one half from which on balls are cheaper than pairs
PIECE = 100_000  # shingles whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, as a signed number: bit i is set when it is set in over half the shingle hashes; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, blanks are \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), PIECE):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + PIECE], ends[at : at + PIECE])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(packed.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


HALF = (1 << 32) - 1


def _halves(prints: DataFrame) -> DataFrame:
    """Both halves of each fingerprint as rows (side, part, rest, fp)."""
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(F.lit(HALF))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), high.alias("part"), low.alias("rest")),
        F.struct(F.lit(1).alias("side"), low.alias("part"), high.alias("rest")),
    )
    return prints.select("fp", F.inline(sides)).select("side", "part", "rest", "fp")


def _balls(halves: DataFrame, column: str, out: str, exact: bool = True) -> DataFrame:
    """Every value that sets one clear bit of a 32-bit column, besides the value itself."""
    bit = lambda i: F.expr(f"shiftleft(1L, {i})")
    near = [F.when(F.col(column).bitwiseAND(bit(i)) == 0, F.col(column).bitwiseOR(bit(i))) for i in range(32)]
    values = F.array(*([F.col(column)] if exact else []), *near)
    return halves.withColumn(out, F.explode(F.array_compact(values)))


def _crowd_links(stored: DataFrame, probes: DataFrame) -> DataFrame:
    """Links of crowded halves without pairing their members.

    Members of a crowd are known to be 0 (stored) or 1 bit (probing) from its half. What is left to compare is the other
    half, where each member enters all values within two bits (stored) or one bit (probing) of its own. If a value v
    has a stored member a within one bit, every stored member within two bits of v, and every probing member within one
    bit, is within three bits of a: linking them all to one such a keeps every connection and adds none.
    Two stored members within three bits always meet at such a value, and so do a stored and a probing one within two.
    """
    bit = lambda i: F.expr(f"shiftleft(1L, {i})")
    flips1 = [bit(i) for i in range(32)]
    flips2 = [F.expr(f"shiftleft(1L, {i}) | shiftleft(1L, {j})") for i in range(32) for j in range(i)]

    def ring(rows: DataFrame, masks: list, tag: int) -> DataFrame:
        return rows.select("side", "part", "fp", "rest", F.explode(F.array(*masks)).alias("mask")).select(
            "side", "part", F.col("rest").bitwiseXOR(F.col("mask")).alias("v"), "fp", F.lit(tag).alias("away")
        )

    near = ring(stored, [F.lit(0).cast("long"), *flips1], 1)
    far = ring(stored, flips2, 2)
    other = ring(probes, [F.lit(0).cast("long"), *flips1], 2)
    keys = ["side", "part", "v"]
    hubs = saved(near.groupBy(*keys).agg(F.min("fp").alias("hub")))
    meet = near.union(far).union(other)
    return meet.join(hubs, keys).select(F.col("hub").alias("a"), F.col("fp").alias("b")).filter("a <> b").distinct()


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of "differ in at most three bits".

    Pairs are compared one by one except inside a crowd, a half that over `crowd` fingerprints share: those are linked
    through common near values, which costs a fixed number of rows for each member instead of one for each pair.
    """
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # each half becomes up to 33 rows below: spread now, as small tables are put into few tasks
    halves = saved(_halves(prints.filter("fp IS NOT NULL").select("fp").distinct()).repartition(partitions, "fp"))
    crowds = saved(halves.groupBy("side", "part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("side", "part"))
    sparse, probes, extra = halves, _balls(halves, "part", "probe"), None
    if not crowds.isEmpty():
        at = crowds.withColumnRenamed("part", "probe")
        extra = _crowd_links(
            halves.join(crowds, ["side", "part"], "left_semi"),
            _neighbours(halves).join(at, ["side", "probe"], "left_semi").drop("part").withColumnRenamed("probe", "part"),
        )
        sparse = halves.join(crowds, ["side", "part"], "left_anti")
        probes = probes.join(at, ["side", "probe"], "left_anti")
    a, b = probes.alias("a"), sparse.alias("b")
    differ = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    once = (F.col("a.probe") != F.col("a.part")) | (F.col("a.fp") < F.col("b.fp"))
    met = a.join(b, (F.col("a.side") == F.col("b.side")) & (F.col("a.probe") == F.col("b.part")) & (differ <= RADIUS) & once)
    met = met.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    return met if extra is None else met.unionByName(extra)


def _neighbours(stored: DataFrame) -> DataFrame:
    """Every value exactly one bit from a half, set or cleared."""
    bit = lambda i: F.expr(f"shiftleft(1L, {i})")
    return stored.withColumn("probe", F.explode(F.array(*[F.col("part").bitwiseXOR(bit(i)) for i in range(32)])))


def _named(rows: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of rows (doc_id, fp)."""
    prints = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(prints)).select(F.col("node").alias("fp"), "root")
    named = saved(prints.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = saved(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return saved(named.join(smallest, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, fp (64 bits as a long) and component_id, the smallest id reachable by links.

    Copies of a fingerprint are one node, so only different fingerprints are compared. Null and empty texts have
    fingerprint 0, which links like any other. Null ids do not name a component unless all its ids are null; repeated
    rows are returned as often as they come; an empty table gives an empty result; other columns are ignored.
    """
    rows = saved(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col)).alias("fp")))
    return rows.join(_named(rows), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns of `docs`: one that has the smallest id of the component.

    Rows are stored with their fingerprint and a number, which stays as it is from there: of several rows with that id
    (repeated rows, or none has an id) the lowest number stays. Columns of `docs` may have any names.
    """
    number = F.monotonically_increasing_id().alias("number")
    marked = stored(docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col)).alias("fp"), number))
    rows = marked.select("doc_id", "fp", "number")
    named = _named(rows.select("doc_id", "fp"))
    first = rows.join(named, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("number").alias("number"))
    return marked.join(saved(first.select("number")), "number", "left_semi").select("row.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
