"""Places of matches in texts that hold very many, and running results over long arrays."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from martloom.llm import licenses, secrets, text


def one(spark, values, column, kind="array<int>"):
    return spark.createDataFrame([(values,)], f"v {kind}").select(column(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 4_096, 4_097, 9_000])
def test_running(spark, size):
    rnd = random.Random(size)
    values = [rnd.randint(-50, 99) for _ in range(size)]
    sums, top = [], []
    for v in values:
        sums.append((sums[-1] if sums else 0) + v)
        top.append(max(top[-1], v) if top else v)
    assert one(spark, values, text.running) == sums
    assert one(spark, values, lambda c: text.running(c, step=F.greatest)) == top


def test_outermost(spark):
    rnd = random.Random(1)
    for size in (0, 1, 5, 30, 300):
        spans = sorted({(a := rnd.randint(0, 3 * size), a + rnd.randint(1, 30)) for _ in range(size)}, key=lambda _: rnd.random())
        kind = "array<struct<start:int,end:int>>"
        want = sorted(s for s in spans if not any(o != s and o[0] <= s[0] and o[1] >= s[1] for o in spans))
        assert [tuple(s) for s in one(spark, spans, text.outermost, kind)] == want


def dense(spark, make, job, sizes):
    """Seconds for texts of so many matches, and the results."""
    out = []
    for n in sizes:
        frame = spark.createDataFrame([(1, make(n))], "doc_id long, text string")
        start = time.time()
        out.append((job(frame).collect()[0], time.time() - start))
    return out


def test_license_phrases_without_end(spark):
    job = lambda df: licenses.licenses(df).select(F.size("starts"), F.array_max("starts"), "labels", "score")
    dense(spark, lambda n: "mit license x " * n, job, [10])
    (a, first), (b, second) = dense(spark, lambda n: "mit license x " * n, job, [40_000, 80_000])
    assert a[:2] == (40_000, 3 * 40_000 - 3) and b[:2] == (80_000, 3 * 80_000 - 3) and a.labels == b.labels
    assert second < 3 * first + 2 and second < 60


def test_keys_without_end(spark):
    rnd = random.Random(6)
    keys = [f"{rnd.getrandbits(160):040x}" for _ in range(8_000)]
    job = lambda df: secrets.secrets(df).select(F.size("hex"), F.size("found"), F.element_at("hex", -1))
    dense(spark, lambda n: "\n".join(keys[:n]), job, [10])
    (a, first), (b, second) = dense(spark, lambda n: "\n".join(keys[:n]), job, [4_000, 8_000])
    assert a[0] == 4_000 and b[0] == 8_000 and tuple(b[2]) == (41 * 7_999, 41 * 8_000 - 1)
    assert a[1] > 7_000 and b[1] > 14_000
    assert second < 3 * first + 2 and second < 60


def test_matches_without_end(spark):
    words = ("ab é日 cab " * 40_000).strip()
    frame = spark.createDataFrame([(words,)], "t string")
    got = frame.select(text.match_spans(F.col("t"), "[ab日]+").alias("s")).first().s
    assert [tuple(s) for s in got] == [m.span() for m in re.finditer("[ab日]+", words)]
