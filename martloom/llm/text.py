"""Column helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = r"\x20\x09-\x0D"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing: digits, a-z and everything beyond ASCII


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else. Texts of ASCII only take the faster built-in, which does the same to them."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, made the checkpoint folder of the session if none is.

    Where the setting is missing a local session, as in some tests, takes one beside its tables; on a cluster, whose
    machines may not share that, it is an error.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there by everything after.

    Cuts the lineage so that a lost executor costs no recomputation, and keeps later steps from running earlier ones
    twice.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As saved, for many rows: Parquet in the shared folder, compressed, of which later steps read the columns they need."""
    folder = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


RUN = 64  # elements folded by appending, which copies what is there


def running(values: Column, kind: str = "int", step: Callable[[Column, Column], Column] = lambda a, x: a + x, levels: int = 2) -> Column:
    """What `step` makes of each element and all before it: running sums, or maxima with F.greatest.

    Long arrays are folded in runs of RUN elements, the runs' last results in the same way, so the work grows with the
    elements and not with their square (up to RUN ** (levels + 1) of them; slowly beyond).
    """
    none = F.expr(f"CAST(array() AS array<{kind}>)")

    def folded(a: Column) -> Column:
        start = F.struct(F.lit(None).cast(kind).alias("last"), none.alias("all"))

        def onward(acc: Column, x: Column) -> Column:
            last = F.when(acc["last"].isNull(), x).otherwise(step(acc["last"], x))
            return F.struct(last.alias("last"), F.array_append(acc["all"], last).alias("all"))

        return F.aggregate(a, start, onward, lambda acc: acc["all"])

    def in_runs(a: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.size(a) - 1, F.lit(RUN))
        runs = F.transform(firsts, lambda i: folded(F.transform(F.sequence(i, F.least(i + RUN, F.size(a)) - 1), lambda j: F.get(a, j))))

        def joined(r: Column) -> Column:
            ends = running(F.transform(r, lambda x: F.element_at(x, -1)), kind, step, levels - 1)

            def onto(e: Column) -> Column:
                before = lambda x, i: F.when(i > 0, F.transform(x, lambda y: step(F.get(e, i - 1), y))).otherwise(x)
                return F.flatten(F.transform(r, before))

            return let(ends, onto)

        return let(runs, joined)

    if not levels:
        return folded(values)
    return let(values, lambda a: F.when(F.size(a) > RUN, in_runs(a)).otherwise(folded(a)))


def match_spans(text: Column, pattern: str | Column) -> Column:
    """Array of (start, end) in code points, end exclusive: all leftmost non-overlapping matches of a pattern.

    The pieces between matches and the matches themselves alternate, so their lengths give the places.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    return spans_from(gaps, sizes)


def spans_from(gaps: Column, sizes: Column) -> Column:
    """Spans from the lengths of the pieces between matches (one more than matches) and of the matches."""
    empty = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")

    def spans(sizes: Column) -> Column:
        both = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, s: g + s)
        return F.zip_with(running(both), sizes, lambda e, s: F.struct((e - s).alias("start"), e.alias("end")))

    return let(sizes, lambda s: F.when(F.size(s) > 0, spans(s)).otherwise(empty))


def outermost(spans: Column) -> Column:
    """The spans (start, end first, none twice) that lie in no other, in order: of those before it in the order of start,
    then the longer first, the furthest end tells."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), (-s.end).alias("back"))))

    def kept(o: Column) -> Column:
        reach = running(F.transform(o, lambda s: -s.back), step=F.greatest)
        return let(reach, lambda r: F.filter(o, lambda s, i: (i == 0) | (F.get(r, i - 1) < -s.back)))

    return F.transform(let(ordered, kept), lambda s: F.struct(s.start.alias("start"), (-s.back).alias("end")))
