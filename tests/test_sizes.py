"""Layouts follow the size of the input: partitions of shuffles and buckets."""

import pytest

from checks import ingest_queries
from checks.queries import QUERIES
from martloom import session
from martloom.sources import io
from martloom.sources.given import Given

SMALL = "/root/testdata/sf0.001"
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def partitions(spark):
    yield lambda: int(spark.conf.get(FIRST))
    spark.conf.unset(FIRST)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_size_of_the_tables(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/orders.parquet")
    written = sum(f.stat().st_size for f in tmp_path.glob("orders.parquet/[!.]*"))
    assert Given(spark, str(tmp_path)).size == written
    assert session.stored_bytes(spark, [f"{tmp_path}/none.parquet"]) == 0


@pytest.mark.parametrize("name", ["ec_channel_roi_per_order", "ec_cohort_ltv_per_order", "ad_cost_feed_from_raw"])
def test_shuffles_start_with_more_partitions_for_larger_tables(spark, partitions, monkeypatch, name):
    size = Given(spark, SMALL).size
    for part in (size // 50, size // 10):
        monkeypatch.setattr(session, "PARTITION", part)
        df = QUERIES[name](spark, SMALL)
        assert partitions() == -(-size // part)
        df.count()
    monkeypatch.setattr(session, "PARTITION", size)
    QUERIES[name](spark, SMALL)
    assert partitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_buckets_grow_with_the_input(spark, monkeypatch, tmp_path):
    assert io.buckets_for(1) == 8 and io.buckets_for(100 * io.BUCKET) == 100 and io.buckets_for(600 * io.BUCKET) == 600
    made = []
    monkeypatch.setattr(io, "BUCKET", Given(spark, SMALL).size // 20)
    monkeypatch.setattr(ingest_queries.io, "shared_dir", lambda _, n: f"{tmp_path}/{n}")
    monkeypatch.setattr(ingest_queries.io, "write_bucketed", lambda df, name, key, buckets, path, f=io.write_bucketed: (made.append(buckets), f(df, name, key, buckets, path)))
    stored = QUERIES["profile_from_buckets"](spark, SMALL)
    plain = QUERIES["ec_customer_profile"](spark, SMALL)
    assert made[0] > 8 and stored.exceptAll(plain).isEmpty() and stored.count() == plain.count()
