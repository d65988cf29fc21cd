from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martloom.ingest.shop import orders_from_rest
from martloom.operators.keyed import latest_wins
from martloom.sources import io
from martloom.sources.schemas import SCHEMAS, struct
from tests.conftest import D, T, rows
from tests.test_shop import order


def test_scan_reads_declared_columns(spark, make, tmp_path):
    path = str(tmp_path / "t")
    make("ec_cost_master", {"sku": "a", "cost_price": 1, "valid_from": D("2024-01-01"), "valid_to": D("2024-01-02")}).withColumn("extra", F.lit(1)).write.parquet(path)
    assert io.scan(spark, "ec_cost_master", path).columns == ["sku", "cost_price", "valid_from", "valid_to"]


def test_csv_with_comments(spark, tmp_path):
    (tmp_path / "rates.csv").write_text("size_category,daily_rate_yen,monthly_rate_yen,dimensions_spec,weight_limit,valid_from,valid_to,notes\n60,1.0,30,3辺合計60cm以内,2kg以内,2024-01-01,9999-12-31,n\n# note\n150,12.0,360,中間サイズ,,2024-01-01,9999-12-31,n\n", encoding="utf-8")
    got = rows(io.load_csv(spark, "ec_openlogi_storage_rate", str(tmp_path / "rates.csv")), "size_category", "daily_rate_yen", "dimensions_spec", "weight_limit", "valid_to")
    assert got == [("150", 12.0, "中間サイズ", None, D("9999-12-31")), ("60", 1.0, "3辺合計60cm以内", "2kg以内", D("9999-12-31"))]


def test_seed_view_and_catalog(spark, make):
    io.as_view(io.shipping_seed(spark), "ec_shipping_rules_view")
    assert rows(spark.table("ec_shipping_rules_view")) == [(D("2020-01-01"), D("2099-12-31"), 1000)]
    assert io.create_if_missing(spark, "ec_shipping_rules") is True
    assert io.create_if_missing(spark, "ec_shipping_rules") is False
    assert spark.table("ec_shipping_rules").count() == 0
    io.shipping_seed(spark).write.mode("append").saveAsTable("ec_shipping_rules")
    assert spark.table("ec_shipping_rules").count() == 1
    io.rebuild_table(io.shipping_seed(spark).limit(0), "ec_shipping_rules")
    assert spark.table("ec_shipping_rules").count() == 0
    spark.sql("DROP TABLE ec_shipping_rules")


def test_append_then_latest_wins(spark, make, tmp_path):
    path = str(tmp_path / "orders")
    first = make("ec_shopify_orders", order(1), order(2))
    io.append(first, path, T("2024-01-01T00:00:00"))
    io.append(first.filter("order_id = '2'").withColumn("is_refunded", F.lit(True)), path, T("2024-01-02T00:00:00"))
    stored = io.scan(spark, "ec_shopify_orders", path)
    assert stored.count() == 3
    once = latest_wins(stored, ["order_id", "line_item_id"], "inserted_at")
    assert rows(once, "order_id", "is_refunded") == [("1", False), ("2", True)]
    io.rebuild(first.limit(1), path)
    assert io.scan(spark, "ec_shopify_orders", path).count() == 1


def test_days_are_restated_alone(spark, make, tmp_path):
    path = str(tmp_path / "history")
    day = lambda d, q, c: {"data_date": D(d), "site_url": "s", "query": q, "clicks": c, "impressions": 1}
    io.write_by_day(make("sc_history", day("2024-01-01", "b", 1), day("2024-01-01", "a", 1), day("2024-01-02", "a", 2), day("2024-01-03", "a", 3)), path, "data_date", ["query"])
    feed = make("sc_history", day("2024-01-01", "a", 90), day("2024-01-02", "a", 20), day("2024-01-03", "a", 30))
    io.restate_days(io.last_days(feed, "data_date", D("2024-01-03"), 2), path, "data_date", ["query"])
    got = rows(spark.read.schema(SCHEMAS["sc_history"]).parquet(path), "data_date", "query", "clicks")
    assert got == [(D("2024-01-01"), "a", 1), (D("2024-01-01"), "b", 1), (D("2024-01-02"), "a", 20), (D("2024-01-03"), "a", 30)]
    plan = spark.read.parquet(path).filter(F.col("data_date") == F.lit(D("2024-01-02")))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_date" in plan


def test_files_of_a_day_are_ranges_of_the_cluster_column(spark, tmp_path):
    """A point filter needs one file of a large day, or two where a value is at a border; a value that is half of a day is
    spread over files all the same."""
    path = str(tmp_path / "clustered")
    rows_ = spark.range(40_000).selectExpr("date'2024-01-01' + cast(id % 2 AS int) AS data_date", "concat('q', lpad(if(id % 4 < 2, 777, id % 997), 4, '0')) AS query", "id AS clicks")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so few rows would be put together again
    try:
        io.write_by_day(rows_.repartition(6), path, "data_date", ["query"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for day in ("2024-01-01", "2024-01-02"):
        files = [pq.ParquetFile(f) for f in sorted((tmp_path / "clustered" / f"data_date={day}").glob("*.parquet"))]
        spans = sorted((g.column(0).statistics.min, g.column(0).statistics.max) for f in files for g in (f.metadata.row_group(i) for i in range(f.num_row_groups)))
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert sum(a <= "q0123" <= b for a, b in spans) <= 1 < len(spans)
    assert sum(a <= "q0777" <= b for a, b in spans) > 1
    stored = spark.read.parquet(path)
    assert stored.count() == 40_000 and stored.filter("query = 'q0777'").count() > 20_000


def test_restating_reads_its_input_once(spark, tmp_path):
    path, reads = str(tmp_path / "history"), spark.sparkContext.accumulator(0)
    feed = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-03", "b", 2)], "d string, query string, clicks long")
    counted = feed.rdd.map(lambda r: (reads.add(1), r)[1]).toDF(feed.schema).selectExpr("date(d) AS data_date", "query", "clicks")
    io.restate_days(counted, path, "data_date", ["query"], (D("2024-01-01"), D("2024-01-03")))
    assert reads.value == 2
    assert rows(spark.read.parquet(path), "query", "clicks") == [("a", 1), ("b", 2)]
    assert not list((tmp_path / "history").glob("_staged*"))


def test_backfill_goes_on_where_it_failed(spark, tmp_path):
    path, log, asked = str(tmp_path / "t"), str(tmp_path / "log"), []
    assert io.chunks_of(D("2024-01-01"), D("2024-01-07"), 3) == [(D("2024-01-01"), D("2024-01-03")), (D("2024-01-04"), D("2024-01-06")), (D("2024-01-07"), D("2024-01-07"))]
    chunks = io.chunks_of(D("2024-01-01"), D("2024-01-07"), 3)

    def fetch(first, last, broken=False):
        asked.append(first.day)
        rows_ = spark.range(7).selectExpr("date'2024-01-01' + cast(id AS int) AS d", "id").filter(F.col("d").between(F.lit(first), F.lit(last)) & (F.col("id") != 2))
        # fails while its rows are written, after some of them are
        return rows_.withColumn("id", F.expr("if(id = 4, raise_error('cut off'), id)").cast("long")) if broken else rows_

    with pytest.raises(Exception, match="cut off"):
        io.backfill(lambda a, b: fetch(a, b, a.day == 4), chunks, path, "d", log, spark)
    assert rows(io.chunks_done(spark, log)) == [(D("2024-01-01"), D("2024-01-03"), 2)]
    assert rows(spark.read.parquet(path), "id") == [(0,), (1,)]
    assert io.backfill(fetch, chunks, path, "d", log, spark) == 2
    assert asked == [1, 4, 4, 7] and io.backfill(fetch, chunks, path, "d", log, spark) == 0
    assert rows(spark.read.parquet(path), "id") == [(0,), (1,), (3,), (4,), (5,), (6,)]
    assert [r[2] for r in rows(io.chunks_done(spark, log))] == [2, 3, 1]


def test_versions(spark, tmp_path):
    root, schema = str(tmp_path / "state"), struct("k S!, v I")
    assert io.current_version(spark, root) is None and io.read_version(spark, root, schema).count() == 0
    io.write_version(spark.createDataFrame([("a", 1)], schema), root, 1)
    half = tmp_path / "state" / "v=0000000002"
    half.mkdir()  # a write that was lost: no _SUCCESS
    assert io.current_version(spark, root) == 1
    io.write_version(spark.createDataFrame([("a", 2)], schema), root, 2)
    assert rows(io.read_version(spark, root, schema)) == [("a", 2)]
    assert io.current_version(spark, root, below=2) == 1


def test_shared_dir(spark):
    def session(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    shared = session("spark://cluster", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert io.shared_dir(shared, "x").startswith("hdfs://shared/x-")
    with pytest.raises(ValueError):
        io.shared_dir(session("spark://cluster"), "x")


@pytest.mark.parametrize("table", sorted(SCHEMAS))
def test_schemas_have_required_keys(table):
    assert any(not f.nullable for f in SCHEMAS[table].fields)
    assert orders_from_rest is not None


def test_required_columns_split_a_load(make):
    table = make("re_deals", {"id": 1, "deal_number": "D", "tenant_id": 1, "property_id": 1, "status": "LOST", "created_at": T("2024-01-01"), "updated_at": T("2024-01-01"), "inserted_at": T("2024-01-01")}, {"id": 2})
    good, bad = io.required_or_reject(table, "re_deals")
    assert rows(good, "id") == [(1,)] and good.columns == table.columns
    assert rows(bad, "id", "missing") == [(2, "deal_number,tenant_id,property_id,status,created_at,updated_at,inserted_at")]
    assert rows(io.required_or_reject(table.drop("status"), "re_deals")[1].filter("id = 1"), "missing") == [("status",)]
