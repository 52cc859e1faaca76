"""Orders, refunds and what they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import less_money, money, month_start
from tidemark.operators.history import asof_user_attributes
from tidemark.operators.joins import join_uneven

FACT_COLUMNS = (
    "order_id",
    "user_id",
    "order_timestamp",
    "order_date",
    "order_amount",
    "currency",
    "country",
    "acquisition_channel",
    "total_refund_amount",
    "net_revenue",
)


def orders_enriched(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Every order with the attributes of its user, if the user is known."""
    left = orders.select("order_id", "user_id", "order_timestamp", "order_amount", "currency")
    right = users.select("user_id", "signup_timestamp", "country", "acquisition_channel")
    return join_uneven(left, right, "user_id").select(
        *left.columns, "signup_timestamp", "country", "acquisition_channel"
    )


def order_refunds(refunds: DataFrame) -> DataFrame:
    """Refunded total per order."""
    return refunds.groupBy(F.col("order_id").cast("string").alias("order_id")).agg(
        money(F.sum(money("refund_amount"))).alias("total_refunded_amount")
    )


def net_revenue(amount: Column, refunded: Column) -> Column:
    """An amount with refunds taken off, 0 at least."""
    return F.greatest(less_money(amount, refunded), money(F.lit(0)))


def net_orders(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """Orders with refunds taken off; revenue never falls below 0. Keeps the columns of `orders`.

    Orders and refund totals are both keyed by order id, so after the order dedup this join needs no
    further shuffle of the orders.
    """
    joined = orders.join(refunds.select("order_id", "total_refunded_amount"), "order_id", "left")
    refunded = money(F.coalesce(F.col("total_refunded_amount"), F.lit(0)))
    return (
        joined.withColumn("order_date", F.to_date("order_timestamp"))
        .withColumn("total_refund_amount", refunded)
        .withColumn("net_revenue", net_revenue(F.col("order_amount"), refunded))
        .drop("total_refunded_amount")
    )


def fct_revenue(enriched: DataFrame, refunds: DataFrame) -> DataFrame:
    """The order fact: one row per order with net revenue and user attributes."""
    return net_orders(enriched, refunds).select(*FACT_COLUMNS)


def fct_revenue_from_staging(orders: DataFrame, users: DataFrame, refunds: DataFrame) -> DataFrame:
    """Same result as `fct_revenue`, joining refunds before users.

    The order dedup already leaves orders partitioned by order id, so this order moves them once
    less than enriching first.
    """
    attributes = users.select("user_id", "country", "acquisition_channel")
    return join_uneven(net_orders(orders, refunds), attributes, "user_id").select(*FACT_COLUMNS)


def monthly_revenue(fct: DataFrame) -> DataFrame:
    """Gross revenue and order count per month."""
    return fct.groupBy(month_start("order_timestamp").alias("revenue_month")).agg(
        money(F.sum("order_amount")).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
    )


def user_ltv(fct: DataFrame) -> DataFrame:
    """Lifetime value per user."""
    return fct.groupBy("user_id").agg(
        F.min("order_timestamp").alias("first_order_timestamp"),
        F.max("order_timestamp").alias("last_order_timestamp"),
        F.count(F.lit(1)).alias("total_orders"),
        money(F.sum("net_revenue")).alias("lifetime_revenue"),
    )


def retention_join(users: DataFrame, fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each user's signup month (and their columns `by`) with every month, from then on, in which they ordered.

    Orders shrink to distinct (user, month) before the join, inside each map task first, so that a
    user with very many orders weighs no more than the months they ordered in.
    """
    cohorts = users.select("user_id", *by, month_start("signup_timestamp").alias("cohort_month"))
    months = fct.select("user_id", month_start("order_timestamp").alias("order_month")).distinct()
    return (
        months.join(cohorts, "user_id")
        .where(F.col("order_month") >= F.col("cohort_month"))
        .select(*by, "cohort_month", "order_month", "user_id")
    )


def user_retention(users: DataFrame, fct: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Users of each signup month that order in each later (or the same) month, split by columns of `users`.

    `users` holds one row per user, so the joined rows are distinct and counting rows counts users. For what users
    were when they signed up, and not what they are now, give `users_at_signup`.
    """
    return (
        retention_join(users, fct, by)
        .groupBy(*by, "cohort_month", "order_month")
        .agg(F.count("user_id").alias("active_users"))
        .orderBy("cohort_month", "order_month", *by)
    )


def users_at_signup(users: DataFrame, history: DataFrame) -> DataFrame:
    """One row per user with the attributes of the version that was valid when they signed up, NULL where none was.

    `history` is a version history by user_id, as of `scd2_history`. Later versions change nothing here, so cohorts
    stay what they were.
    """
    signups = users.select("user_id", "signup_timestamp")
    return asof_user_attributes(signups, history, "user_id", "signup_timestamp")


def no_over_refund(fct: DataFrame) -> DataFrame:
    """Violations: orders refunded for more than they cost."""
    return fct.where(F.col("total_refund_amount") > F.col("order_amount"))


def revenue_decomposition(fct: DataFrame, grain: str = "month", items: DataFrame | None = None) -> DataFrame:
    """Revenue per period as active users x orders per user x average order value.

    With `items` (order_id, items: one row per order) the average order value is split into items per order and
    price per item; orders without items count as orders with none.
    """
    period = F.to_date(F.date_trunc(grain, "order_timestamp"))
    orders, users = F.col("orders").cast("double"), F.col("active_users").cast("double")
    revenue = F.col("revenue").cast("double")
    rows, sums, parts = fct, [], []
    if items is not None:
        rows = fct.join(items.select("order_id", "items"), "order_id", "left")
        number = F.col("items").cast("double")
        sums = [F.coalesce(F.sum("items"), F.lit(0)).cast("bigint").alias("items")]
        parts = [
            "items",
            F.round(F.try_divide(number, orders), 4).alias("items_per_order"),
            F.round(F.try_divide(revenue, number), 4).alias("item_price"),
        ]
    return (
        rows.groupBy(period.alias("period"))
        .agg(
            F.countDistinct("user_id").alias("active_users"),
            F.count("order_id").alias("orders"),
            money(F.sum("order_amount")).alias("revenue"),
            *sums,
        )
        .select(
            "period",
            "active_users",
            "orders",
            F.round(F.try_divide(orders, users), 4).alias("orders_per_user"),
            F.round(F.try_divide(revenue, orders), 4).alias("aov"),
            *parts,
            "revenue",
        )
    )


def segment_change(
    df: DataFrame,
    metric: str,
    segment: str,
    date_col: str,
    period_a: tuple[str, str],
    period_b: tuple[str, str],
) -> DataFrame:
    """Change of a summed metric between two date ranges, per segment, and each segment's share in it.

    Ranges include their first and exclude their last date.
    """
    day = F.col(date_col).cast("date")

    def total(bounds: tuple[str, str]):
        inside = (day >= F.lit(bounds[0]).cast("date")) & (day < F.lit(bounds[1]).cast("date"))
        return money(F.coalesce(F.sum(F.when(inside, money(metric))), F.lit(0)))

    sums = [total(period_a).alias("value_a"), total(period_b).alias("value_b")]
    change = less_money(F.col("value_b"), F.col("value_a"))
    per_segment = df.groupBy(F.col(segment).alias("segment")).agg(*sums)
    # From the rows per segment, so that the input is read once.
    overall = per_segment.agg(less_money(money(F.sum("value_b")), money(F.sum("value_a")))).scalar()
    return (
        per_segment
        .select(
            "segment",
            "value_a",
            "value_b",
            change.alias("change"),
            F.round(F.try_divide(change.cast("double"), overall.cast("double")), 4).alias("share_of_change"),
        )
    )
