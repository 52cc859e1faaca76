"""Raw tables derived from the star-schema test tables.

Every rule keeps all rows of its source and adds the dirt the cleaning operators exist for: repeated
deliveries, mixed case, blanks, missing values and unknown users. Remainders decide only which rows
get a second copy or a defect; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import money

LOAD_DATE = "2024-01-31"
EARLIER_LOAD_DATE = "2024-01-30"
PRE_PERIOD_END = "2024-01-08"
CONVERSION_VALUE = 150.0
ACTIVE_BUYER_PURCHASES = 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _copies(condition: Column) -> Column:
    """0 for the row itself and 1 for its second copy, made without a second scan."""
    return F.explode(F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")


def _loaded_at() -> Column:
    return (
        F.when(F.col("copy") == 1, F.lit(EARLIER_LOAD_DATE)).otherwise(F.lit(LOAD_DATE)).cast("date").alias("_loaded_at")
    )


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    country = (
        F.when(key % 11 == 0, None)
        .when(key % 3 == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .otherwise(F.col("n_name"))
    )
    signup = _ntz("1995-01-01 00:00:00") + F.make_dt_interval(days=(key % 1800 - F.col("copy")).cast("int"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("copy", _copies(key % 10 == 0))
        .select(
            key.cast("string").alias("user_id"),
            signup.alias("signup_timestamp"),
            country.alias("country"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            _loaded_at(),
        )
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    created = F.col("o_orderdate") - F.make_dt_interval(days=F.col("copy"))
    user = F.col("o_custkey").cast("string")
    return orders.withColumn("copy", _copies(key % 10 == 0)).select(
        key.cast("string").alias("order_id"),
        F.when(key % 101 == 0, F.concat(F.lit("unknown-"), user)).otherwise(user).alias("user_id"),
        created.alias("created_at"),
        F.when(key % 50 == 0, None).otherwise(money("o_totalprice")).alias("amount"),
        F.when(key % 3 == 0, "usd").when(key % 3 == 1, "USD").otherwise("inr").alias("currency"),
        (created + F.expr("interval 1 minute")).alias("updated_at"),
        _loaded_at(),
    )


def refunds_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("refund_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("refund_amount"),
        F.lit("returned").alias("reason"),
        F.col("l_shipdate").alias("refund_timestamp"),
        F.lit(LOAD_DATE).cast("date").alias("_loaded_at"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return events.withColumn("copy", _copies(F.col("event_id") % 20 == 0)).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_timestamp"),
        _loaded_at(),
    )


def experiment_assignments_raw(spark: SparkSession, sf_dir: str, contaminated: bool = False) -> DataFrame:
    """Every event user in three experiments: random, unbalanced, and linked to the outcome.

    With `contaminated`, some users get a second row in the other group.
    """
    users = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    )
    uid = F.col("user_id")
    start = F.when(uid % 3 == 0, F.lit("2024-01-06")).otherwise(F.lit("2024-01-05")).cast("date")

    def arm(in_treatment: Column) -> Column:
        return F.when(in_treatment, F.lit("TREATMENT")).otherwise(F.lit("Control"))

    arms = [
        ("exp_001", "layout_test", uid % 2 == 1),
        ("exp_002", "onboarding_test", uid % 5 >= 2),
        ("exp_003", "engagement_test", F.col("purchases") >= ACTIVE_BUYER_PURCHASES),
    ]
    rows = []
    for n, (exp_id, name, treated) in enumerate(arms, start=1):
        rows.append((n, exp_id, name, arm(treated), F.lit(True)))
        if contaminated:
            rows.append((n + 3, exp_id, name, arm(~treated), uid % 50 == 0))
    structs = [
        F.when(
            keep,
            F.struct(
                (uid * 10 + n).cast("string").alias("assignment_id"),
                F.lit(exp_id).alias("experiment_id"),
                F.lit(name).alias("experiment_name"),
                group.alias("experiment_group"),
            ),
        )
        for n, exp_id, name, group, keep in rows
    ]
    return (
        users.select("user_id", start.alias("start"), F.explode(F.array_compact(F.array(*structs))).alias("a"))
        .select(
            "a.assignment_id",
            "a.experiment_id",
            "a.experiment_name",
            uid.cast("string").alias("user_id"),
            "a.experiment_group",
            F.col("start").cast("timestamp_ntz").alias("assigned_at"),
            F.col("start").alias("experiment_start_date"),
        )
    )


def user_pre_experiment_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = table(spark, sf_dir, "events").where(F.col("ts") < _ntz(PRE_PERIOD_END))
    return before.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("pre_experiment_purchases"),
        F.count(F.lit(1)).alias("pre_experiment_events"),
        F.lit(7).cast("bigint").alias("observation_period_days"),
    )


def converters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who made a purchase of high value."""
    buys = table(spark, sf_dir, "events").where(
        (F.col("event_type") == "purchase") & (F.col("value") > CONVERSION_VALUE)
    )
    return buys.select(F.col("user_id").cast("string").alias("user_id")).distinct()


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with the defects the stream validation has to find."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    sellers = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("suppkey"), F.min("l_partkey").alias("partkey"))
    )
    return (
        orders.join(sellers, key == F.col("l_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("suppkey").cast("string").alias("seller_id"),
            F.col("partkey").cast("string").alias("product_id"),
            F.when(key % 97 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
            F.lit("USD").alias("currency"),
            F.when(key % 89 == 0, None).otherwise(F.col("n_name")).alias("city"),
            F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("state"),
            F.when(key % 83 == 0, None).otherwise(F.col("o_orderpriority")).alias("payment_method"),
            F.col("o_orderstatus").alias("status"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            F.lit("order_placed").alias("event_type"),
        )
    )


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    status = F.when(key % 33 == 0, "failed").when(key % 50 == 0, "pending").otherwise("success")
    return orders.select(
        F.concat(F.lit("PAY-"), key.cast("string")).alias("payment_id"),
        key.cast("string").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("method"),
        status.alias("status"),
        F.concat(F.lit("gateway_"), (key % 4).cast("string")).alias("gateway"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit("payment_processed").alias("event_type"),
    )


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's properties as the rate map of one document."""
    events = table(spark, sf_dir, "events").select("ts", "props")
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        F.concat(F.lit('{"time_last_update_utc":"'), day, F.lit('","rates":'), F.col("props"), F.lit("}")).alias("value")
    )


def lake_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = order_events(spark, sf_dir).select("order_id", "customer_id", "seller_id", "amount", "city", "status", "timestamp")
    day = F.to_date("timestamp")
    return events.select(
        "order_id",
        "customer_id",
        "seller_id",
        "amount",
        "city",
        "status",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )
