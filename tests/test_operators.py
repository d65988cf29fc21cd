import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.functions import utm
from martloom.functions.scalars import (
    iso_z,
    jst_date,
    jst_midnight,
    months_between_starts,
    number,
    pct,
    ratio,
    round_at,
    to_int_half_away,
    to_int_half_even,
    to_int_half_up,
    url_path,
    week_start,
)
from martloom.operators.joins import list_days, may_hold, newest_before, place, point_in_time, prefix_totals, segments, text_filters, valid_on
from martloom.operators.keyed import between_stamps, high_water_mark, latest_wins, since_mark, upsert, upsert_with_history
from martloom.operators.periods import overlaps, value_periods
from martloom.operators.quantiles import histogram_quartiles
from martloom.operators.skew import SALT, hot_keys, spread_hot_keys
from tests.conftest import D, T, rows


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_roundings(spark):
    f = lambda v: F.lit(v)
    assert [one(spark, to_int_half_up(f(v))) for v in (2.5, -2.5, 1.4)] == [3, -2, 1]
    assert [one(spark, to_int_half_even(f(v))) for v in (2.5, 3.5)] == [2, 4]
    assert [one(spark, to_int_half_away(f(v))) for v in (2.5, -2.5)] == [3, -3]
    assert one(spark, round_at(f(0.125), 2)) == 0.13
    assert one(spark, ratio(f(1), f(0))) is None
    assert one(spark, pct(f(1), f(3), 2)) == 33.33
    assert one(spark, number(f("1,234.5"))) == 1234.5 and one(spark, number(f("--"))) is None


def test_calendar(spark):
    assert one(spark, week_start(F.lit(D("2024-01-07")))) == D("2024-01-01")
    assert one(spark, months_between_starts(F.lit(D("2024-02-01")), F.lit(D("2022-12-01")))) == 14
    ts = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, jst_date(ts("2024-01-01 14:59:59"))) == D("2024-01-01")
    assert one(spark, jst_date(ts("2024-01-01 15:00:00"))) == D("2024-01-02")
    assert one(spark, iso_z(jst_midnight(D("2024-01-02")))) == "2024-01-01T15:00:00Z"


def test_urls(spark):
    url = F.lit("/a b?utm_source=x%2Fy+z&utm_medium=&utm_campaign=c#utm_campaign=d")
    assert one(spark, utm.raw_param(url, "utm_source")) == "x%2Fy+z"
    assert one(spark, utm.decoded_param(url, "utm_source")) == "x/y z"
    assert one(spark, utm.decoded_param(url, "utm_medium")) is None
    assert one(spark, utm.decoded_param(url, "utm_campaign")) == "c"
    assert one(spark, utm.decoded_param(F.lit("/?utm_source=50%"), "utm_source")) == "50%"
    assert one(spark, url_path(F.lit("https://h.example/p/1?x=2"))) == "/p/1?x=2"
    assert one(spark, url_path(F.lit("https://h.example"))) is None


@pytest.fixture(scope="module")
def master(spark):
    return spark.createDataFrame(
        [("a", 1, D("2024-01-01"), D("2024-01-31")), ("a", 2, D("2024-02-01"), D("9999-12-31")), ("b", 3, D("2024-01-10"), D("2024-01-10"))],
        "sku string, cost int, valid_from date, valid_to date",
    )


@pytest.mark.parametrize("spread", [(), ("n",)])
def test_point_in_time(spark, master, spread):
    facts = spark.createDataFrame(
        [(1, "a", D("2024-01-31")), (2, "a", D("2024-02-01")), (3, "b", D("2024-01-11")), (4, None, D("2024-01-01"))],
        "n int, sku string, day date",
    )
    got = point_in_time(facts, master, "sku", "day", ["cost"], spread=spread)
    assert got.columns == ["n", "sku", "day", "cost"]
    assert rows(got, "n", "cost") == [(1, 1), (2, 2), (3, None), (4, None)]


def test_valid_on_drops_and_multiplies(spark):
    rules = spark.createDataFrame(
        [(D("2023-06-01"), D("2024-06-30"), 10), (D("2024-06-01"), D("2025-01-01"), 20)], "valid_from date, valid_to date, fee int"
    )
    facts = spark.createDataFrame([(1, D("2023-05-31")), (2, D("2024-06-15")), (3, D("2025-01-01"))], "n int, day date")
    assert rows(valid_on(facts, rules, "day", ["fee"]), "n", "fee") == [(2, 10), (2, 20), (3, 20)]


@pytest.mark.parametrize("cells", [1, 3, 7, 1_023])
def test_valid_on_against_all_pairs(spark, cells):
    """Rules that overlap, repeat, touch, end before they begin, last one day or have no end, in few cells and in many."""
    rnd = random.Random(cells)
    at = lambda n: D("2024-01-01") + dt.timedelta(days=n)
    spans = [(a := rnd.randint(0, 300), a + rnd.choice((-1, 0, 0, 5, 40, 200))) for _ in range(40)] + [(10, 20), (10, 20), (21, 30), (600, 640)]
    rules = [(at(a), at(b), i) for i, (a, b) in enumerate(spans)] + [(None, at(5), 98), (at(5), None, 99)]
    facts = [(i, at(rnd.randint(-20, 700))) for i in range(400)] + [(900, None), (901, at(640)), (902, at(641)), (903, at(599))]
    got = valid_on(
        spark.createDataFrame(facts, "n int, day date"), spark.createDataFrame(rules, "valid_from date, valid_to date, fee int"), "day", ["fee"], cells
    )
    assert got.columns == ["n", "day", "fee"]
    assert rows(got, "n", "fee") == sorted(((n, f) for n, d in facts for a, b, f in rules if d and a and b and a <= d <= b), key=str)
    none = spark.createDataFrame([], "valid_from date, valid_to date, fee int")
    assert valid_on(spark.createDataFrame(facts, "n int, day date"), none, "day", ["fee"], cells).count() == 0


def test_facts_meet_segments_by_cell(spark):
    """Overlaps are cut once, and no day falls into two segments of a cell."""
    day = lambda s: D(f"2024-{s}")
    rules = spark.createDataFrame([(day("01-01"), day("03-31"), 1), (day("02-01"), day("02-29"), 2)], "valid_from date, valid_to date, fee int")
    cut = rows(segments(rules, ["fee"], 1_023), "_cell", "_from", "_to", "fee")
    assert cut == [
        (0, day("01-01"), day("01-31"), 1), (1, day("02-01"), day("02-29"), 1), (1, day("02-01"), day("02-29"), 2), (2, day("03-01"), day("03-31"), 1),
    ]
    assert {r[0] for r in rows(segments(rules, ["fee"], 2), "_cell")} == {0, 1}
    places = spark.range(9).select(place(F.array(F.lit(1), F.lit(3), F.lit(6)), F.col("id"), 3).alias("p"))
    assert [r.p for r in places.collect()] == [-1, 0, 0, 1, 1, 1, 2, 2, 2]


def test_list_days_keeps_rows_without_start(spark):
    df = spark.createDataFrame([(1, D("2024-01-01")), (2, None)], "n int, start date")
    got = rows(list_days(df, F.col("start"), 2, "day"), "n", "day")
    assert got == [(1, D("2024-01-01")), (1, D("2024-01-02")), (1, D("2024-01-03")), (2, None)]


@pytest.mark.parametrize("bits", [64, 1 << 19])
def test_prefix_totals_against_all_pairs(spark, bits):
    rnd = random.Random(3)
    word = lambda n: "/" + "".join(rnd.choice("ab/") for _ in range(rnd.randint(0, n)))
    texts = [(m, word(6), rnd.randint(1, 9)) for m in (1, 2, 3) for _ in range(60)]
    prefixes = sorted({(m, word(4)) for m in (1, 2) for _ in range(30)}) + [(1, None)]
    got = prefix_totals(
        spark.createDataFrame(texts, "m int, text string, v long"), "text", spark.createDataFrame(prefixes, "m int, p string"), "p", "m", {"s": "v"}, bits
    )
    got = {(m, p): s for m, p, s in rows(got, "m", "p", "s") if (m, p) in set(prefixes)}
    want = {}
    for m, p in prefixes:
        hits = [v for tm, t, v in texts if p is not None and tm == m and t.startswith(p)]
        if hits:
            want[(m, p)] = sum(hits)
    assert got == want


def test_pieces_that_are_no_prefix_stay_behind(spark):
    """Of 20,000 paths with six pieces each, a hundredth matches: what is summed and shuffled is that and a few by chance."""
    texts = spark.range(20_000).selectExpr("1 AS m", "concat('/shop/', id % 5000, '/item/', id) AS text", "id AS v")
    prefixes = spark.range(2_000).selectExpr("1 AS m", "concat('/', if(id < 50, concat('shop/', id, '/'), concat('help', repeat('x', int(id % 9)), id))) AS p")
    got = prefix_totals(texts, "text", prefixes, "p", "m", {"s": "v"}).join(prefixes, ["m", "p"], "left_anti")
    every = prefix_totals(texts, "text", prefixes, "p", "m", {"s": "v"}, 64)
    assert got.count() < 200 and every.count() > 50_000


def test_filters_hold_what_went_in(spark):
    words = spark.range(3_000).selectExpr("id % 3 AS g", "concat('w', id) AS t").unionByName(spark.createDataFrame([(0, None), (None, "x")], "g long, t string"))
    filters = text_filters(words, "t", "g")
    sizes = filters.select("g", F.size("_words").alias("n")).collect()
    assert {(r.g, r.n) for r in sizes} == {(g, (1 << 19) // 64) for g in range(3)}
    tried = words.unionByName(spark.range(30_000).selectExpr("id % 3 AS g", "concat('other', id) AS t")).join(filters, "g")
    hits = {r.own: r.n for r in tried.filter(may_hold(F.col("_words"), F.col("t"))).groupBy(F.col("t").startswith("w").alias("own")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert hits[True] == 3_000 and hits.get(False, 0) < 20


def test_newest_before_against_all_pairs(spark):
    rnd = random.Random(5)
    day = lambda: D("2024-01-01") + dt.timedelta(days=rnd.randint(0, 200))
    versions = sorted({(rnd.randint(1, 4), day()) for _ in range(25)})
    facts = sorted({(rnd.randint(1, 5), day()) for _ in range(80)})
    got = newest_before(
        spark.createDataFrame(facts, "k int, day date"),
        spark.createDataFrame([(k, d, str(d)) for k, d in versions], "k int, loaded date, name string"),
        "k", "day", "loaded", 60, ["name"],
    )
    want = []
    for k, d in facts:
        seen = [v for vk, v in versions if vk == k and v <= d <= v + dt.timedelta(days=60)]
        if seen:
            want.append((k, d, str(max(seen))))
    assert rows(got, "k", "day", "name") == sorted(want, key=str)


def test_spread_hot_keys_changes_nothing_but_the_layout(spark):
    facts = spark.range(4000).select(
        F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 == 6, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        "id",
    )
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k7", 3), (None, 4)], "k string, v int")
    hot = hot_keys(facts, ["k"], ["id"], 1.0, 16).collect()
    assert [(r["k"], r["_splits"]) for r in hot] == [("hot", 10)]
    left, right = spread_hot_keys(facts, lookup, ["k"], ["id"], fraction=1.0, partitions=16)
    assert left.filter("k = 'hot'").select(SALT).distinct().count() == 10
    for how in ("inner", "left"):
        got = left.join(right, ["k", SALT], how).select("k", "id", "v")
        want = facts.join(lookup, "k", how).select("k", "id", "v")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_latest_wins(spark):
    df = spark.createDataFrame(
        [("1", "a", T("2024-01-01"), 1), ("1", "a", T("2024-01-02"), 2), ("1", "b", T("2024-01-01"), 5), ("1", "b", T("2024-01-01"), 7)],
        "o string, l string, at timestamp, v int",
    )
    once = latest_wins(df, ["o", "l"], "at")
    assert rows(once, "l", "v") == [("a", 2), ("b", 7)]
    assert rows(latest_wins(once.unionByName(once), ["o", "l"], "at")) == rows(once)


def test_marks(spark):
    stored = spark.createDataFrame([(T("2024-01-01"),), (T("2024-01-03"),)], "at timestamp")
    incoming = spark.createDataFrame([(1, T("2024-01-02")), (2, T("2024-01-03")), (3, T("2024-01-04"))], "n int, at timestamp")
    assert rows(since_mark(incoming, stored, "at", "2020-01-01", True), "n") == [(2,), (3,)]
    assert rows(since_mark(incoming, stored, "at", "2020-01-01", False), "n") == [(3,)]
    assert since_mark(incoming, stored.limit(0), "at", "2020-01-01", True).count() == 3
    assert high_water_mark(stored, "at", "2020-01-01").first().since == "2024-01-03T00:00:00Z"
    assert high_water_mark(stored.limit(0), "at", "2020-01-01").first().since == "2020-01-01T00:00:00Z"
    chunk = between_stamps(incoming, "at", F.lit("2024-01-02").cast("timestamp"), F.lit("2024-01-04").cast("timestamp"))
    assert rows(chunk, "n") == [(2,)]


def test_upsert(spark):
    current = spark.createDataFrame([("a", "old", 3, T("2024-01-01")), ("b", "keep", 1, T("2024-01-01"))], "k string, v string, n long, at timestamp")
    changes = spark.createDataFrame(
        [("a", "new", T("2024-02-01")), ("a", "newer", T("2024-02-02")), ("c", None, T("2024-02-01"))], "k string, v string, at timestamp"
    )
    got = rows(upsert(current, changes, ["k"], ["v"], "n", "at"), "k", "v", "n", "at")
    assert got == [("a", "newer", 5, T("2024-02-02")), ("b", "keep", 1, T("2024-01-01")), ("c", None, 1, T("2024-02-01"))]


def test_value_periods(spark):
    d = lambda n: D("2024-01-01") + dt.timedelta(days=n)
    daily = [("const", 5, d(0)), ("const", 5, d(9)), ("aba", 1, d(0)), ("aba", 2, d(3)), ("aba", 1, d(5)), ("one", 7, d(2))]
    got = value_periods(spark.createDataFrame(daily, "sku string, c long, day date"), "sku", "c", "day", D("2020-01-01"), D("2099-12-31"))
    assert rows(got) == [
        ("aba", 1, D("2020-01-01"), d(2)),
        ("aba", 1, d(5), D("2099-12-31")),
        ("aba", 2, d(3), d(4)),
        ("const", 5, D("2020-01-01"), D("2099-12-31")),
        ("one", 7, D("2020-01-01"), D("2099-12-31")),
    ]


def test_overlaps_sees_past_a_short_period(spark):
    spans = [("a", D("2024-01-01"), D("2024-12-31")), ("a", D("2024-02-01"), D("2024-02-02")), ("a", D("2024-03-01"), D("2024-03-02")), ("b", D("2024-01-01"), D("2024-01-31")), ("b", D("2024-02-01"), D("2024-02-28"))]
    got = overlaps(spark.createDataFrame(spans, "k string, valid_from date, valid_to date"), ["k"])
    assert rows(got, "k", "valid_from") == [("a", D("2024-02-01")), ("a", D("2024-03-01"))]


def test_quartiles_against_sorted_lists(spark):
    rnd = random.Random(11)
    groups = {g: [rnd.randint(0, 20) for _ in range(n)] for g, n in enumerate((1, 2, 3, 4, 5, 97), 1)}
    hist = [(g, v, vs.count(v)) for g, vs in groups.items() for v in set(vs)]
    got = rows(histogram_quartiles(spark.createDataFrame(hist, "g int, v long, n long"), "g", "v", "n"))
    want = [(g, *(sorted(vs)[max(0, -(-len(vs) * k // 4) - 1)] for k in (1, 2, 3))) for g, vs in groups.items()]
    assert got == sorted(want, key=str)


def test_upsert_with_history(spark):
    schema = "k string, v string, n long, at timestamp, error string"
    current = spark.createDataFrame([("a", "old", 3, T("2024-01-01"), None), ("b", "old", 1, T("2024-01-01"), "was down"), ("c", "old", 1, T("2024-01-01"), "was down")], schema)
    attempts = spark.createDataFrame(
        [("a", "new", T("2024-01-02"), None), ("a", "lost", T("2024-01-03"), "refused"), ("b", "new", T("2024-01-02"), None), ("d", "x", T("2024-01-02"), "refused")],
        "k string, v string, at timestamp, error string",
    )
    state, history = upsert_with_history(current, attempts, ["k"], ["v"], "n", "at", "error")
    assert rows(state, "k", "v", "n", "error") == [("a", "new", 4, "refused"), ("b", "new", 2, None), ("c", "old", 1, "was down")]
    assert rows(history, "k", "v", "succeeded") == sorted([("a", "new", True), ("a", None, False), ("b", "new", True), ("d", None, False)], key=str)
    assert rows(upsert_with_history(current, attempts.limit(0), ["k"], ["v"], "n", "at", "error")[0]) == rows(current)


def test_latest_wins_side_by_side(spark):
    """Rows of one order are dealt together, those without an order by the whole key; the rows are those of the plain form."""
    i = F.col("id")
    df = spark.range(4000).select(
        F.when(i % 3 > 0, F.concat(F.lit("o"), i % 40)).alias("o"), F.when(i % 50 > 0, i % 90).alias("l"), (i % 7 % 4).alias("at"),
        F.when(i % 11 > 0, i % 5).alias("a"), F.when(i % 13 > 0, i % 6).alias("b"), (i % 8).alias("c"),
    )
    plain, dealt = latest_wins(df, ["o", "l"], "at"), latest_wins(df, ["o", "l"], "at", together=["o"])
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)
    tree = latest_wins(df, ["o", "l"], "at", together=["o"])._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Exchange hashpartitioning(o#") == 1 == tree.count("Exchange hashpartitioning")
    assert "_share#" in tree.split("Exchange hashpartitioning(o#")[1].split(")")[0]


def test_newest_rows_of_some_columns(spark, make):
    """Columns behind the last one that is needed are left out; equal stamps are decided as with all columns."""
    from martloom.sources import io

    lines = [
        {"order_id": f"o{i % 9}", "line_item_id": f"l{i % 5}", "customer_email": f"{i % 4}@x", "total_price": i * 7 % 10, "sku": f"s{i % 3}", "tags": f"t{i}"}
        for i in range(200)
    ]
    raw = make("ec_shopify_orders", *lines)
    needed = ["customer_email", "order_date", "order_id", "total_price"]
    got = io.newest_rows(raw, "ec_shopify_orders", needed)
    assert rows(got) == rows(latest_wins(raw, ["order_id", "line_item_id"], "inserted_at").select(*needed))
    read = got._jdf.queryExecution().optimizedPlan().toString()
    assert "tags#" not in read.split("LogicalRDD")[0].split("LocalRelation")[0]
    assert rows(io.newest_rows(raw, "ec_shopify_orders")) == rows(latest_wins(raw, ["order_id", "line_item_id"], "inserted_at"))
