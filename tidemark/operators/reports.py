"""Order reports: totals by currency and channel, order history per user, enrichment, skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, order_measures, sum_money
from tidemark.operators.joins import join_uneven
from tidemark.operators.ordered import with_running

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
BROADCAST_LIMIT_ROWS = 1_000_000
_ENRICHED = ("order_id", "user_id", "amount", "currency", "country", "acquisition_channel")


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a DataFrame, the one its join selection uses."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES, limit_rows: int = BROADCAST_LIMIT_ROWS) -> bool:
    """Whether data is proven small enough to broadcast.

    The estimate comes from file sizes and costs nothing. Only where it is low are rows counted, and
    never more than just above the limit.
    """
    return planned_bytes(df) <= limit_bytes and df.limit(limit_rows + 1).count() <= limit_rows


def plain_enrich(orders: DataFrame, users: DataFrame, on: str = "user_id") -> DataFrame:
    """Orders with country and channel of their user."""
    side = users.select(on, "country", "acquisition_channel")
    return join_uneven(orders, side, on).select(*_ENRICHED)


def broadcast_enrich(
    orders: DataFrame,
    users: DataFrame,
    on: str = "user_id",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    limit_rows: int = BROADCAST_LIMIT_ROWS,
) -> DataFrame:
    """Same rows as `plain_enrich`; the users are broadcast if they are small, else both sides shuffled."""
    side = users.select(on, "country", "acquisition_channel")
    if not is_small(side, limit_bytes, limit_rows):
        return plain_enrich(orders, users, on)
    return orders.join(F.broadcast(side), on, "left").select(*_ENRICHED)


def revenue_by_currency(orders: DataFrame) -> DataFrame:
    """One row per currency, the largest revenue first: the measures of any group of orders, and the largest order."""
    largest = F.max("amount").alias("max_order_value")
    return orders.groupBy("currency").agg(*order_measures("total_revenue", "order_count", "order_id"), largest).orderBy(
        F.desc("total_revenue"), "currency"
    )


def user_order_windows(orders: DataFrame) -> DataFrame:
    """Each user's orders in time: number, previous amount, running total."""
    rows = orders.select("user_id", "order_id", "created_at", "amount")
    return with_running(
        rows,
        ["user_id"],
        ["created_at", "order_id"],
        rank="order_rank",
        lags={"prev_amount": "amount"},
        sums={"running_total": "amount"},
    ).select(
        "user_id",
        "order_id",
        "amount",
        "order_rank",
        "prev_amount",
        F.col("running_total").cast("double").alias("running_total"),
    )


def revenue_by_channel(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Revenue per channel. Orders are summed per user before they meet the users."""
    per_user = orders.where(F.col("amount") > 0).groupBy("user_id").agg(F.sum(money("amount")).alias("spent"))
    channels = users.select("user_id", "acquisition_channel")
    return (
        per_user.join(channels, "user_id", "left")
        .groupBy("acquisition_channel")
        .agg(F.sum("spent").cast("double").alias("revenue"))
    )


def grand_total(orders: DataFrame) -> DataFrame:
    return orders.agg(sum_money("amount").alias("revenue"))


def skew_check(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, largest first."""
    return (
        df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "key")
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)
