"""Deduplication, casting and cleaning of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import money, safe_divide


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    ties: Sequence[str] = (),
    ascending: bool = False,
) -> DataFrame:
    """One row per key: the last (or first) by `order_col`.

    Ties are broken by `ties` and then by every other sortable column, so re-runs agree. Spark turns
    "row number = 1" into a per-task group limit ahead of the shuffle: a key with very many copies
    sends one row per map task.
    """
    used = {*keys, order_col, *ties}
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    direction = F.asc if ascending else F.desc
    order = [direction(c) for c in (order_col, *ties, *rest)]
    rank = "__rank"
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) == 1).drop(rank)


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key."""
    return df.dropDuplicates(list(keys))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def stg_orders(orders_raw: DataFrame, order_col: str = "created_at") -> DataFrame:
    """One typed row per order; a missing amount counts as 0."""
    wanted = dict.fromkeys(["order_id", "user_id", "created_at", order_col, "amount", "currency", "_loaded_at"])
    rows = dedup_latest(orders_raw.select(*wanted), ["order_id"], order_col, ["_loaded_at"])
    created = F.col("created_at").cast("timestamp_ntz")
    return rows.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        created.alias("order_timestamp"),
        created.alias("created_at"),
        money(F.coalesce(F.col("amount"), F.lit(0))).alias("order_amount"),
        F.upper("currency").alias("currency"),
    )


def stg_users(users_raw: DataFrame) -> DataFrame:
    """One typed row per user; country and channel in lower case without blanks around them."""
    wanted = ["user_id", "signup_timestamp", "country", "acquisition_channel", "_loaded_at"]
    rows = dedup_latest(users_raw.select(*wanted), ["user_id"], "signup_timestamp", ["_loaded_at"])
    return rows.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("signup_timestamp").cast("timestamp_ntz").alias("signup_timestamp"),
        F.lower(F.trim("country")).alias("country"),
        F.lower(F.trim("acquisition_channel")).alias("acquisition_channel"),
    )


def stg_refunds(refunds_raw: DataFrame) -> DataFrame:
    """One typed row per refund."""
    wanted = ["refund_id", "order_id", "refund_amount", "refund_timestamp", "_loaded_at"]
    rows = dedup_latest(refunds_raw.select(*wanted), ["refund_id"], "refund_timestamp", ["_loaded_at"])
    return rows.select(
        F.col("refund_id").cast("string").alias("refund_id"),
        F.col("order_id").cast("string").alias("order_id"),
        money("refund_amount").alias("refund_amount"),
        F.col("refund_timestamp").cast("timestamp_ntz").alias("refund_timestamp"),
    )


def stg_events(events_raw: DataFrame, ties: Sequence[str] = ("_loaded_at",)) -> DataFrame:
    """One row per event id: repeated deliveries are dropped."""
    wanted = ["event_id", "user_id", "event_name", "event_timestamp", *ties]
    rows = dedup_latest(events_raw.select(*wanted), ["event_id"], "event_timestamp", ties)
    return rows.select("event_id", "user_id", "event_name", "event_timestamp")


def stg_events_as_written(events_raw: DataFrame) -> DataFrame:
    """The first event of each user, and only that one."""
    rows = dedup_latest(
        events_raw.select("event_id", "user_id", "event_name", "event_timestamp"),
        ["user_id"],
        "event_timestamp",
        ascending=True,
    )
    return rows.select("user_id", "event_name", "event_timestamp")


def stg_experiment_assignments(assignments_raw: DataFrame) -> DataFrame:
    return assignments_raw.select(
        F.col("assignment_id").cast("string").alias("assignment_id"),
        "experiment_id",
        "experiment_name",
        F.col("user_id").cast("string").alias("user_id"),
        F.lower("experiment_group").alias("experiment_group"),
        F.col("assigned_at").cast("timestamp_ntz").alias("assigned_at"),
        F.col("experiment_start_date").cast("date").alias("experiment_start_date"),
    )


def stg_user_pre_experiment(pre_raw: DataFrame) -> DataFrame:
    return pre_raw.select(
        F.col("user_id").cast("string").alias("user_id"),
        "pre_experiment_purchases",
        "pre_experiment_events",
        "observation_period_days",
        safe_divide("pre_experiment_purchases", "observation_period_days").alias("pre_experiment_conversion_rate"),
    )


def clean_orders(orders_raw: DataFrame) -> DataFrame:
    """Orders with a positive amount, as double, with a tidy currency, one row per order id.

    Unlike `stg_orders` this drops orders without an amount.
    """
    tidy = {"amount": F.col("amount").cast("double"), "currency": F.upper(F.trim("currency"))}
    typed = orders_raw.select(*[tidy.get(c, F.col(c)).alias(c) for c in orders_raw.columns])
    # Of copies that only differ elsewhere, the one with the largest columns stays, so reruns agree.
    first, *rest = [c for c in typed.columns if c != "order_id"]
    return dedup_latest(typed.filter(F.col("amount") > 0), ["order_id"], first, rest)
