"""Funnels: which users reach which step, in any order or in strict order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import safe_divide

STEPS = ("view_product", "add_to_cart", "checkout", "purchase")


def funnel_step_times(
    ev: DataFrame, view: str = "view_product", cart: str = "add_to_cart", purchase: str = "purchase"
) -> DataFrame:
    """First time of each of three steps per user; NULL where a user never got there."""

    def first(name: str):
        return F.min(F.when(F.col("event_name") == name, F.col("event_timestamp")))

    return ev.groupBy("user_id").agg(
        first(view).alias("view_time"), first(cart).alias("cart_time"), first(purchase).alias("purchase_time")
    )


def _by_step(counts: DataFrame, steps: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per step from one column per step (named by position)."""
    pairs = F.array(
        *[F.struct(F.lit(s).alias("step"), F.col(f"s{i}").alias("users")) for i, s in enumerate(steps)]
    )
    return counts.select(*by, F.inline(pairs))


def multi_step_funnel(ev: DataFrame, steps: Sequence[str] = STEPS, by: Sequence[str] = ()) -> DataFrame:
    """Users that reached each step, in any order; always one row per step.

    `by` splits the funnel, for example by day. One scan and one shuffle of at most one row per user
    and map task.
    """
    reached = [F.max(F.col("event_name") == s).alias(f"s{i}") for i, s in enumerate(steps)]
    users = ev.where(F.col("event_name").isin(*steps)).groupBy(*by, "user_id").agg(*reached)
    counts = [F.count_if(F.col(f"s{i}")).alias(f"s{i}") for i in range(len(steps))]
    return _by_step(users.groupBy(*by).agg(*counts), steps, by)


def first_step(ev: DataFrame, step: str, by: Sequence[str] = ()) -> DataFrame:
    """Each user's earliest event of a step, as `reached_at`."""
    return (
        ev.where(F.col("event_name") == step)
        .groupBy(*by, "user_id")
        .agg(F.min("event_timestamp").alias("reached_at"))
    )


def step_after(
    ev: DataFrame, reached: DataFrame, step: str, by: Sequence[str] = (), salts: int = 8
) -> DataFrame:
    """Each user's earliest event of `step` later than their `reached_at`, for users that have one.

    The step's events are shuffled once, spread over `salts`; only the small side, one time per user,
    is repeated per salt. The minimum is formed in each task before users come together, which takes a
    shuffle of its own, so Spark may also split a (user, salt) that is still too large at run time.
    """
    keys = [*by, "user_id"]
    salt = F.pmod(F.xxhash64("event_timestamp"), F.lit(salts)).cast("int")
    events = ev.where(F.col("event_name") == step).select(*keys, "event_timestamp", salt.alias("salt"))
    previous = reached.select(*keys, "reached_at", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    return (
        events.join(previous, [*keys, "salt"])
        .where(F.col("event_timestamp") > F.col("reached_at"))
        .groupBy(*keys)
        .agg(F.min("event_timestamp").alias("reached_at"))
    )


def _level_map(seen: Column, steps: Sequence[str]) -> Column:
    """For each number of steps done before, how many are done after the (time, event) pairs in `seen`, in order.

    Events of one time take a user one step further at most, whatever their order.
    """
    names = F.array(*[F.lit(s) for s in steps])

    def advance(state: Column, event: Column) -> Column:
        next_step = F.get(names, state["level"]) == event["event_name"]
        later = state["at"].isNull() | (event["event_timestamp"] > state["at"])
        moved = F.struct((state["level"] + 1).alias("level"), event["event_timestamp"].alias("at"))
        return F.when(next_step & later, moved).otherwise(state)

    def after(level: Column) -> Column:
        start = F.struct(level.alias("level"), F.lit(None).cast("timestamp_ntz").alias("at"))
        return F.aggregate(seen, start, advance, lambda state: state["level"])

    return F.transform(F.sequence(F.lit(0), F.lit(len(steps))), after)


def _composed(maps: Column, steps: Sequence[str]) -> Column:
    """One level map for several that follow each other, given as (time, levels) pairs in order."""
    same = F.sequence(F.lit(0), F.lit(len(steps)))
    return F.aggregate(maps, same, lambda levels, m: F.transform(levels, lambda n: F.get(m["levels"], n)))


def funnel_levels(ev: DataFrame, steps: Sequence[str] = STEPS, by: Sequence[str] = ()) -> DataFrame:
    """Steps each user has done in strict order, as `level`, for users with an event of any step.

    A user's time for a step is the earliest such event later than their time for the previous step. What a span of
    time does to a user fits into one small array: for each number of steps done before it, the number done after.
    Such arrays are formed per user and minute, put together per day and then per user, so the events are shuffled
    once, by user and minute, and no group holds more than the distinct events of a minute, the minutes of a day or
    the days of the calendar. Rows without a time are left out; without a user (or a key of `by`) nothing joins
    one step with the next, so only the first counts.
    """
    keys, time = [*by, "user_id"], F.col("event_timestamp")
    rows = ev.where(F.col("event_name").isin(*steps) & time.isNotNull())
    rows = rows.select(*keys, time.cast("timestamp_ntz").alias("event_timestamp"), "event_name")
    seen = F.array_sort(F.collect_set(F.struct("event_timestamp", "event_name")))
    rows = rows.withColumn("__at", F.date_trunc("minute", "event_timestamp"))
    # Events of one minute are hardly ever equal: collecting them before the shuffle would only cost a sort.
    minutes = rows.repartition(*keys, "__at").groupBy(*keys, "__at").agg(seen.alias("__seen"))
    maps = minutes.select(*keys, "__at", _level_map(F.col("__seen"), steps).alias("levels"))
    several = F.array_sort(F.collect_list(F.struct("__at", "levels")))
    days = maps.groupBy(*keys, F.to_date("__at").alias("__day")).agg(several.alias("__maps"))
    days = days.select(*keys, F.col("__day").alias("__at"), _composed(F.col("__maps"), steps).alias("levels"))
    users = days.groupBy(*keys).agg(several.alias("__maps"))
    level = F.get(_composed(F.col("__maps"), steps), F.lit(0))
    linked = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return users.select(*keys, F.when(linked, level).otherwise(F.least(level, F.lit(1))).alias("level"))


def sequential_funnel(ev: DataFrame, steps: Sequence[str] = STEPS, by: Sequence[str] = ()) -> DataFrame:
    """Users that reached each step strictly after the one before; always one row per step."""
    levels = funnel_levels(ev, steps, by).where(F.col("level") > 0)
    counts = [F.count_if(F.col("level") > i).alias(f"s{i}") for i in range(len(steps))]
    return _by_step(levels.groupBy(*by).agg(*counts), steps, by)


def funnel_step_rates(funnel: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Conversion of each step from the previous one and from the first. The input has one row per step."""
    index = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col("step"))
    order = W.partitionBy().orderBy("__i")
    previous, first = F.lag("users").over(order), F.first("users").over(order)
    return (
        funnel.withColumn("__i", index)
        .select(
            "step",
            "users",
            F.when(F.col("__i") == 1, F.lit(1.0)).otherwise(safe_divide("users", previous)).alias("step_rate"),
            safe_divide("users", first).alias("overall_rate"),
            "__i",
        )
        .orderBy("__i")
        .drop("__i")
    )
