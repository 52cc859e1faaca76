"""Sessions: runs of a user's events without a long pause."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def user_sessions(ev: DataFrame, gap_minutes: int = 30, since: str | None = None) -> DataFrame:
    """Sessions per user, numbered from 1; a pause of more than `gap_minutes` whole minutes ends one.

    Pauses are cut to whole minutes, so 30:59 stays inside a 30-minute session and 31:00 does not.
    Events in the same slot of `gap_minutes` can never be a session apart, so each map task first
    shrinks them to one row (first, last, count) per user and slot. Only these rows are shuffled and
    windowed; their number per user is bounded by the calendar, however many events there are.
    """
    rows = ev.select("user_id", "event_timestamp")
    if since is not None:
        rows = rows.where(F.col("event_timestamp") >= F.lit(since).cast("timestamp_ntz"))
    slot = F.floor(F.unix_timestamp("event_timestamp") / (max(gap_minutes, 1) * 60))
    slots = rows.groupBy("user_id", slot.alias("slot")).agg(
        F.min("event_timestamp").alias("first"),
        F.max("event_timestamp").alias("last"),
        F.count(F.lit(1)).alias("events"),
    )
    in_order = W.partitionBy("user_id").orderBy("first")
    pause = F.timestamp_diff("MINUTE", F.lag("last").over(in_order), F.col("first"))
    starts = F.when(pause <= gap_minutes, 0).otherwise(1)
    return (
        slots.withColumn("starts", starts)
        .withColumn("session_id", F.sum("starts").over(in_order))
        .groupBy("user_id", "session_id")
        .agg(
            F.min("first").alias("session_start"),
            F.max("last").alias("session_end"),
            F.sum("events").alias("events_in_session"),
        )
        .select(
            "user_id",
            "session_id",
            "session_start",
            "session_end",
            F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")).alias("session_duration"),
            "events_in_session",
        )
    )


def merge_sessions(parts: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One row per session from sessions that were formed over parts of the events, in any order.

    Parts may overlap. Two belong together if no pause of more than `gap_minutes` whole minutes lies between them,
    directly or by way of others, which is when their events do; so the result does not depend on how the events
    were parted.
    """
    in_order = W.partitionBy("user_id").orderBy("session_start", "session_end")
    before = F.max("session_end").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    pause = F.timestamp_diff("MINUTE", before, F.col("session_start"))
    numbered = parts.withColumn("starts", F.when(pause <= gap_minutes, 0).otherwise(1))
    return (
        numbered.withColumn("session_id", F.sum("starts").over(in_order))
        .groupBy("user_id", "session_id")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events_in_session").alias("events_in_session"),
        )
        .drop("session_id")
    )
