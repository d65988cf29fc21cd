"""Every registered query against its SQL on the smallest given tables, and what its plan must not hold."""

import pytest

from __spark_entry__ import ORACLE, QUERIES, entry, oracle_sql, queries
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"
# thresholds that so few rows do not reach
MAY_BE_EMPTY = {"ec_competitor_gap", "ordered_competitor_gap", "quality_skus_without_size", "increment_after_mark"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = difference(QUERIES[name](spark, SF), con, ORACLE[name])
    assert found is None or (name in MAY_BE_EMPTY and found.startswith("EMPTY")), found


WRITES = {
    "ndjson_append_and_load", "csv_master_load", "day_partitions_restated", "stream_append", "stream_append_once",
    "backfill_resumed", "profile_from_buckets", "stream_two_sides", "stream_latest_state", "stream_state_compacted",
    "declared_scan_rebuilt", "report_rebuilt_as_table", "append_with_stamp", "table_created_if_missing", "ingest_orders_bulk",
    "ordered_repeat_pattern", "ordered_storage_cost", "ordered_case_pipeline", "ordered_weekly_summaries",
    "ordered_competitor_gap", "ordered_lead_funnel", "ordered_property_performance", "ordered_leasing_weeks", "view_recomputed",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_stays_in_the_engine(spark, name):
    # without the broadcast of small inputs a join that has no key would show as one
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for word in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
        assert word not in plan


def test_buckets_spare_the_shuffle(spark):
    """Two scans of the lines, grouped by customer with other columns and joined by customer, without an exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["profile_from_buckets"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_bulk_export_is_parsed_once(spark):
    plan = QUERIES["ingest_orders_bulk"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "from_json(body" not in plan and "kind" in plan
