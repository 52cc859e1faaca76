"""Calendars: continuous date ranges as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STEPS = {
    "day": "interval 1 day",
    "week": "interval 7 days",
    "month": "interval 1 month",
    "quarter": "interval 3 months",
    "year": "interval 1 year",
}


def date_spine(spark: SparkSession, part: str, start: str, end: str, name: str = "spine_date") -> DataFrame:
    """Every date from start to end (both included) in steps of one date part."""
    step = F.expr(_STEPS[part.lower()])
    dates = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), step)
    return spark.range(1).select(F.explode(dates).alias(name))


def time_spine(
    spark: SparkSession, start: str = "2023-01-01", end: str = "2026-12-31", unit: str = "day"
) -> DataFrame:
    """The calendar of the metric layer."""
    return date_spine(spark, unit, start, end, name="date_day")
