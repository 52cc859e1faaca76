"""Physical plans: what is pushed down, pruned, broadcast, limited before the shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning, order_events, reports, revenue
from tidemark.plans.registry import QUERIES
from tidemark.sources import readers, schemas, star_schema

SF = "/root/testdata/sf0.001"
BATCH = [
    name
    for name in QUERIES
    if not name.startswith(("stream_", "write_", "read_", "append_", "bounded_", "commit_"))
    and name not in ("run_checks", "pipeline_monitoring", "incremental_revenue", "select_unprocessed", "payments_sink_topic", "store_checked", "scd2_apply_stored")
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_dedup_limits_before_the_shuffle(spark):
    text = plan(QUERIES["stg_orders"](spark, SF))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_last_n_limits_before_the_shuffle(spark):
    text = plan(QUERIES["rolling_last_n_avg_by_city"](spark, SF))
    assert "row_number(), 100, Partial" in text
    events = star_schema.order_events(spark, SF)
    assert "row_number(), 5000, Partial" in plan(order_events.rolling_last_n_avg(events, 5000, "city"))
    assert "TakeOrderedAndProject" in plan(order_events.top_cities(star_schema.order_events(spark, SF)))


def test_scan_reads_only_what_is_needed(spark):
    refunds = plan(QUERIES["order_refunds"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in refunds
    assert "l_tax" not in refunds and "l_quantity" not in refunds
    assert "props" not in plan(QUERIES["user_sessions"](spark, SF))
    monthly = plan(QUERIES["monthly_revenue"](spark, SF))
    assert "c_custkey" not in monthly


def test_orders_move_once_less_when_refunds_join_first(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with_conf(spark, off, lambda: _compare_shuffles(spark))


def _compare_shuffles(spark):
    lean = plan(QUERIES["fct_revenue"](spark, SF)).count("Exchange")
    layered = plan(QUERIES["fct_revenue_layered"](spark, SF)).count("Exchange")
    assert lean < layered


def with_conf(spark, conf, body):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return body()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_broadcast_only_below_the_limit(spark):
    def check():
        orders = cleaning.clean_orders(star_schema.orders_raw(spark, SF))
        users = cleaning.drop_duplicates(star_schema.users_raw(spark, SF), ["user_id"])
        small = plan(reports.broadcast_enrich(orders, users))
        assert "BroadcastHashJoin" in small
        for limit in ({"limit_bytes": 10}, {"limit_rows": 10}):
            large = plan(reports.broadcast_enrich(orders, users, **limit))
            assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large

    with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}, check)


def test_partition_folders_are_pruned(spark, tmp_path):
    path = str(tmp_path / "orders")
    star_schema.lake_orders(spark, SF).write.partitionBy("year", "month").parquet(path)
    got = readers.read_partition_filtered(spark, path, F.col("year") == 1998, schemas.LAKE_ORDERS)
    text = plan(got)
    assert "PartitionFilters: [isnotnull(year" in text and "PushedFilters: []" in text


def test_user_history_is_compact_before_it_is_windowed(spark):
    for name in ("growth_accounting", "rolling_active_users", "churned_users", "user_sessions"):
        text = plan(QUERIES[name](spark, SF))
        window = text.index("Window [la" if "Window [lag" in text else "Window [lead")
        assert "HashAggregate(keys=[user_id" in text[window:]


def test_hot_user_is_split_in_the_join_even_before_an_aggregate(spark):
    def check():
        key = F.col("o_orderkey")
        orders = star_schema.table(spark, "/root/testdata/sf0.1", "orders").select(
            key.cast("string").alias("order_id"),
            F.when(F.pmod(F.xxhash64(key), F.lit(3)) == 0, "0").otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
            F.col("o_orderdate").alias("order_timestamp"),
            F.col("o_totalprice").alias("order_amount"),
            F.lit("USD").alias("currency"),
        )
        # Several map tasks, as any large table has: Spark splits a hot partition along their outputs.
        orders = orders.repartition(16, "order_id")
        users = star_schema.users_raw(spark, "/root/testdata/sf0.1").dropDuplicates(["user_id"])
        spent = revenue.orders_enriched(orders, users).groupBy("user_id", "country").agg(F.sum("order_amount"))
        spent.collect()
        return plan(spent)

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    assert "skew=true" in with_conf(spark, conf, check)
