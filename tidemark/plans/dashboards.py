"""Output tables of the three dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import month_start


def product_dashboard_feed(product_metrics: DataFrame, growth_metrics: DataFrame) -> DataFrame:
    """Daily product and growth metrics side by side."""
    growth = growth_metrics.select("event_date", "dau", "wau", "mau", "stickiness_ratio")
    return product_metrics.join(growth, "event_date", "full_outer")


def revenue_dashboard_feed(fct_revenue: DataFrame, monthly_revenue: DataFrame) -> DataFrame:
    """Daily revenue with the totals of its month. Orders shrink to days before the join."""
    daily = fct_revenue.groupBy(
        month_start("order_timestamp").alias("revenue_month"), "order_date"
    ).agg(
        F.count("order_id").alias("orders"),
        F.sum("order_amount").alias("gross_revenue"),
        F.sum("net_revenue").alias("net_revenue"),
    )
    return daily.join(monthly_revenue, "revenue_month", "left")


def retention_dashboard_feed(user_retention: DataFrame) -> DataFrame:
    """Cohort retention with the number of months since signup."""
    months = F.months_between("order_month", "cohort_month").cast("int")
    return user_retention.withColumn("months_since_signup", months)
