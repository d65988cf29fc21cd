"""Documents without a declaration, and summaries kept per day."""

import random

import duckdb
from pyspark.sql import functions as F

from __spark_entry__ import ORACLE, QUERIES
from checks.compare import difference
from martloom.ingest import entities
from martloom.operators import sketches
from martloom.operators.skew import SALT, hot_keys, spread_hot_keys
from tests.conftest import D, T, rows

RUN = T("2024-07-01T00:00:00")
BODIES = [
    '{"id":1,"b":2.5,"c d":"x","e":{"n":1},"a":[1,7],"m":null,"q\'t":1,"ID2":"k"}', '{"id":2,"b":"n/a","a":"none","t":true,"big":12345678901234567890}',
    '{"id":3', "[1]", '"s"', None, "", "{}", '{"id":1,"id":2}', '{"id":4,"id2":5}', '{"id":null}',
]


def test_fields_are_found_and_typed(spark):
    texts = spark.createDataFrame(list(enumerate(BODIES)), "no int, body string")
    good, bad = entities.read_or_reject(texts)
    assert rows(bad, "no") == [(2,), (3,), (4,), (5,), (6,), (8,)] and bad.columns == texts.columns
    wide = entities.wide_rows(good, entities.shape_of(good), RUN)
    assert wide.columns == ["no", "a", "b", "big", "c d", "e", "id", "ID2", "m", "q't", "t", "inserted_at"]
    by_no = {r.no: r for r in wide.collect()}
    assert set(by_no) == {0, 1, 7, 9, 10}
    one, two = by_no[0], by_no[1]
    assert (one.a, one.b, one["c d"], one.e, one.id, one.ID2, one.m, one["q't"], one.t) == ("[1,7]", "2.5", "x", '{"n":1}', 1, "k", None, 1, None)
    assert (two.a, two.b, int(two.big), two.id, two.t) == ("none", "n/a", 12345678901234567890, 2, True)
    assert by_no[9].ID2 == "5" and all(v is None for v in list(by_no[7])[1:-1]) and by_no[10].id is None


def test_no_documents_and_other_shapes(spark):
    texts = spark.createDataFrame(list(enumerate(BODIES)), "no int, body string")
    good, _ = entities.read_or_reject(texts)
    none = entities.shape_of(good.limit(0))
    assert not none.fields and entities.wide_rows(good, none, RUN).columns == ["no", "inserted_at"]
    # the shape of an earlier load: what does not fit is null, what is new is left out
    early = entities.shape_of(good.filter("no = 9"))
    assert rows(entities.wide_rows(good, early, RUN).filter("no < 9"), "no", "id", "id2") == [(0, 1, None), (1, 2, None), (7, None, None)]


def test_a_row_per_field(spark):
    good, _ = entities.read_or_reject(spark.createDataFrame(list(enumerate(BODIES)), "no int, body string"))
    long = entities.long_rows(good)
    assert long.columns == ["no", "field", "kind", "value"]
    assert rows(long.filter("no = 0 AND field IN ('a', 'b', 'e', 'm')"), "field", "kind", "value") == [
        ("a", "array", "[1,7]"), ("b", "number", "2.5"), ("e", "object", '{"n":1}'), ("m", "void", None),
    ]
    assert long.filter("no = 7").isEmpty()


def test_quantiles_of_merged_days(spark):
    rnd = random.Random(2)
    data = [(D(f"2024-01-{i % 28 + 1:02}"), int(rnd.lognormvariate(7, 2)), f"k{i % 50}") for i in range(30_000)] + [(D("2024-01-01"), None, None)]
    days = sketches.day_summaries(spark.createDataFrame(data, "day date, v long, k string").repartition(7), "day", "v", "k")
    at = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = sketches.merged_quantiles(days, [F.month("day").alias("m")], at, ["a", "b", "c", "d", "e"]).first()
    values = sorted(v for _, v, _ in data if v is not None)
    for p, q in zip(at, got[2:], strict=True):
        below, up_to = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
        assert below - 0.007 <= p <= up_to + 0.007
    assert got.n == 30_001


def test_hot_keys_without_a_second_look(spark):
    """The lists of the days name the keys that a count of all rows names, and the layout is the one they ask for."""
    data = [(D(f"2024-01-{i % 28 + 1:02}"), i, "hot" if i % 3 == 0 else "warm" if i % 5 == 0 else f"k{i}") for i in range(9_000)]
    facts = spark.createDataFrame(data, "day date, v long, k string").repartition(6)
    days = sketches.day_summaries(facts, "day", "v", "k")
    hot = sketches.hot_from_summaries(days, "k", 16)
    assert rows(hot) == rows(hot_keys(facts, ["k"], ["v"], 1.0, 16)) == [("hot", 6), ("warm", 3)]
    top = {r.k: r.n for r in sketches.heavy_keys(days, "k", 3).collect()}
    assert top["hot"] == 3_000 and top["warm"] == 1_200 and len(top) == 3
    lookup = spark.createDataFrame([("hot", 1), ("warm", 2), ("k1", 3)], "k string, w int")
    left, right = spread_hot_keys(facts, lookup, ["k"], ["v"], partitions=16, hot=hot)
    joined = left.join(right, ["k", SALT])
    assert rows(joined.groupBy("k").count()) == [("hot", 3_000), ("k1", 1), ("warm", 1_200)]
    assert joined.filter("k = 'hot'").select(SALT).distinct().count() == 6 and right.count() == 6 + 3 + 1


def test_every_key_counts_however_many(spark, tmp_path):
    """More keys than the lists of the days keep: no count is lost, also from summaries that were stored; null is a key."""
    k = F.when(F.col("id") % 1_000 == 7, None).when(F.col("id") % 10 == 0, 5).otherwise(F.col("id") % 25_000)
    facts = spark.range(60_000).select(F.expr("date_add(date'2024-01-01', int(id % 3))").alias("day"), F.col("id").alias("v"), k.alias("k"))
    days = sketches.day_summaries(facts.repartition(6), "day", "v", "k")
    days.write.parquet(f"{tmp_path}/days")
    stored = spark.read.parquet(f"{tmp_path}/days")
    want = rows(facts.groupBy("k").count())
    assert len(want) > 2 * sketches.TRACKED
    for kept in (days, stored):
        assert rows(sketches.heavy_keys(kept, "k", 60_000)) == want
        assert [tuple(r) for r in sketches.heavy_keys(kept, "k", 3).collect()] == [(5, 6_003), (None, 60), (1, 3)]
        assert rows(sketches.hot_from_summaries(kept, "k", 40)) == [(5, 5)]
        assert sketches.merged_quantiles(kept, [F.month("day")], [0.5], ["mid"]).first().n == 60_000
    assert sketches.heavy_keys(stored.limit(0), "k").isEmpty() and sketches.hot_from_summaries(stored.limit(0), "k", 40).isEmpty()


def test_heavy_suppliers_are_all_there(spark, tmp_path):
    """More suppliers than a list of a day keeps, most of them on one day each."""
    lines = spark.range(50_000).select(
        (F.col("id") % 30_000).alias("l_suppkey"), F.col("id").cast("double").alias("l_quantity"),
        F.expr("timestamp_ntz'1996-01-01 00:00:00' + make_interval(0, 0, 0, int(id % 4))").alias("l_shipdate"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    con, name = duckdb.connect(), "heavy_suppliers_from_sketches"
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    found = QUERIES[name](spark, str(tmp_path))
    assert found.count() == 20_000 and difference(found, con, ORACLE[name]) is None
