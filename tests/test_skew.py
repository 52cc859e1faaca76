"""Operators built for very large keys, against plain windows or brute force on data with a hot key."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samples import events
from tidemark.functions import money
from tidemark.operators import activity, funnels, history, ordered, order_events, reports, sessions

START = dt.datetime(2024, 1, 1)


def hot_rows(n: int, seed: int, span_minutes: int, users: int = 8):
    """Half of all rows belong to one user; some have no user."""
    rng = random.Random(seed)
    for i in range(n):
        user = "hot" if rng.random() < 0.5 else rng.choice([None, *[f"u{k}" for k in range(users)]])
        yield i, user, START + dt.timedelta(seconds=rng.randrange(span_minutes * 60)), rng


@pytest.fixture(scope="module")
def orders(spark):
    data = [(u, f"{i:05d}", t, round(rng.uniform(1, 500), 2)) for i, u, t, rng in hot_rows(3000, 1, 60 * 24 * 40)]
    return spark.createDataFrame(data, "user_id string, order_id string, created_at timestamp_ntz, amount double").cache()


@pytest.fixture(scope="module")
def clicks(spark):
    names = ["a", "b", "c", "other"]
    data = [(u, rng.choice(names), t) for _, u, t, rng in hot_rows(4000, 2, 60 * 24 * 45)]
    return events(spark, data).cache()


@pytest.mark.parametrize("pieces", [1, 7])
def test_running_equals_plain_window(orders, rows, pieces):
    plain_w = W.partitionBy("user_id").orderBy("created_at", "order_id")
    plain = orders.select(
        "*",
        F.row_number().over(plain_w).cast("bigint").alias("n"),
        F.lag("amount").over(plain_w).alias("prev"),
        money(F.sum(money("amount")).over(plain_w.rowsBetween(W.unboundedPreceding, 0))).alias("run"),
    )
    got = ordered.with_running(
        orders, ["user_id"], ["created_at", "order_id"], "n", {"prev": "amount"}, {"run": "amount"}, pieces
    )
    assert rows(got) == rows(plain)


def test_running_with_missing_amounts(spark, rows):
    data = [("u", START + dt.timedelta(days=d), v) for d, v in ((0, None), (1, 2.0), (1, None), (3, 4.0))]
    df = spark.createDataFrame([(u, t, i, v) for i, (u, t, v) in enumerate(data)], "u string, t timestamp_ntz, i int, v double")
    plain_w = W.partitionBy("u").orderBy("t", "i")
    plain = df.select("*", money(F.sum(money("v")).over(plain_w)).alias("run"), F.lag("v").over(plain_w).alias("was"))
    got = ordered.with_running(df, ["u"], ["t", "i"], sums={"run": "v"}, lags={"was": "v"})
    assert rows(got.select(plain.columns)) == rows(plain)


@pytest.mark.parametrize("chunk_rows", [7, 50, 100_000])
def test_moving_average_equals_plain_window(orders, rows, chunk_rows):
    frame = W.partitionBy("user_id").orderBy("created_at", "order_id").rowsBetween(-6, 0)
    some = orders.withColumn("amount", F.when(F.pmod(F.xxhash64("order_id"), F.lit(4)) != 0, F.col("amount")))
    plain = some.select("*", F.round(F.avg("amount").over(frame), 8).alias("m"))
    got = ordered.moving_average(
        some, ["user_id"], ["created_at", "order_id"], "amount", n=7, out="m", chunk_rows=chunk_rows
    )
    assert rows(got.withColumn("m", F.round("m", 8))) == rows(plain)


def test_moving_average_needs_room():
    with pytest.raises(ValueError, match="full frame"):
        ordered.moving_average(None, ["k"], ["t"], "v", n=10, chunk_rows=9)


@pytest.mark.parametrize("gap", [0, 1, 30, 45])
def test_sessions_equal_plain_window(clicks, rows, gap):
    w = W.partitionBy("user_id").orderBy("event_timestamp")
    pause = F.timestamp_diff("MINUTE", F.lag("event_timestamp").over(w), F.col("event_timestamp"))
    plain = (
        clicks.withColumn("s", F.when(pause <= gap, 0).otherwise(1))
        .withColumn("session_id", F.sum("s").over(w))
        .groupBy("user_id", "session_id")
        .agg(
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.count(F.lit(1)).alias("events_in_session"),
        )
    )
    assert rows(sessions.user_sessions(clicks, gap).select(plain.columns)) == rows(plain)


def test_rolling_actives_by_brute_force(clicks):
    active = {(r[0], r[1]) for r in clicks.select("user_id", F.to_date("event_timestamp")).collect() if r[0]}
    days = {d for _, d in active}

    def users(day, n):
        return len({u for u, d in active if 0 <= (day - d).days < n})

    got = {r.event_date: (r.dau, r.wau, r.mau) for r in activity.rolling_active_users(clicks).collect()}
    assert got == {d: (users(d, 1), users(d, 7), users(d, 30)) for d in days}
    near = {r.event_date: (r.dau, r.wau, r.mau) for r in activity.rolling_active_users(clicks, approx=True).collect()}
    assert near == got


def test_churn_by_brute_force(clicks):
    active = {(r[0], r[1]) for r in clicks.select("user_id", F.to_date("event_timestamp")).collect() if r[0]}
    day = dt.timedelta(days=1)
    expected = {d: len({u for u, x in active if x == d - day and (u, d) not in active}) for d in {d for _, d in active}}
    assert {r.activity_date: r.churned_users for r in activity.churned_users(clicks).collect()} == expected


@pytest.mark.parametrize("steps", [("a", "b", "c"), ("a", "b", "a", "a"), ("c",)])
@pytest.mark.parametrize("minutes", [1, 60])
def test_sequential_funnel_by_brute_force(clicks, steps, minutes):
    # Whole minutes, or whole hours, give many events of one time.
    clicks = clicks.withColumn("event_timestamp", F.date_trunc("hour" if minutes == 60 else "minute", "event_timestamp"))
    by_user = {}
    for r in clicks.orderBy("event_timestamp").collect():
        by_user.setdefault(r.user_id, []).append((r.event_timestamp, r.event_name))
    reached = [0] * len(steps)
    for user, seen in by_user.items():
        last = dt.datetime.min
        for i, step in enumerate(steps):
            later = [t for t, n in seen if n == step and t > last]
            if not later or (user is None and i > 0):
                break
            reached[i] += 1
            last = min(later)
    assert [r.users for r in funnels.sequential_funnel(clicks, steps).collect()] == reached
    text = funnels.sequential_funnel(clicks, steps)._jdf.queryExecution().executedPlan().toString()
    # The events move once, by user and minute, then small arrays by day and by user; no window and no join.
    assert text.count("REPARTITION_BY_COL") == 1 and text.count("Exchange hashpartitioning") == 3
    assert "Window" not in text and "Join" not in text
    by_step = {r.level: r["count"] for r in funnels.funnel_levels(clicks, steps).groupBy("level").count().collect()}
    assert [sum(n for level, n in by_step.items() if level > i) for i in range(len(steps))] == reached


def test_last_n_per_key(orders, rows):
    ev = orders.select(F.col("created_at").cast("string").alias("timestamp"), "order_id", "amount", F.coalesce("user_id", F.lit("-")).alias("city"))
    w = W.partitionBy("city").orderBy(F.desc("timestamp"), F.desc("order_id"))
    plain = ev.withColumn("n", F.row_number().over(w)).where("n <= 20").groupBy("city").agg(F.round(F.avg("amount"), 8))
    assert rows(order_events.rolling_last_n_avg(ev, 20, "city").withColumn("rolling_avg", F.round("rolling_avg", 8))) == rows(plain)


@pytest.fixture(scope="module")
def changes(spark):
    data = [(u or "none", rng.choice("xyz"), t.replace(second=0)) for _, u, t, rng in hot_rows(600, 3, 60 * 24 * 90)]
    return spark.createDataFrame(data, "user_id string, plan string, updated_at timestamp_ntz").cache()


@pytest.mark.parametrize("pieces", [1, 7])
def test_history_equals_plain_window(changes, rows, pieces):
    per_time = changes.groupBy("user_id", "updated_at").agg(F.max("plan").alias("plan"))
    w = W.partitionBy("user_id").orderBy("updated_at")
    plain = per_time.select(
        "user_id", "plan", F.col("updated_at").alias("valid_from"), F.lead("updated_at").over(w).alias("valid_to")
    )
    got = history.scd2_history(changes, "user_id", "updated_at", pieces=pieces)
    assert rows(got.drop("is_current")) == rows(plain)
    collapsed = per_time.withColumn("was", F.lag("plan").over(w)).where(~F.col("was").eqNullSafe(F.col("plan")))
    plain = collapsed.select(
        "user_id", "plan", F.col("updated_at").alias("valid_from"), F.lead("updated_at").over(w).alias("valid_to")
    )
    got = history.scd2_history(changes, "user_id", "updated_at", ["plan"], pieces)
    assert rows(got.drop("is_current")) == rows(plain)


@pytest.mark.parametrize("pieces", [1, 7])
def test_asof_by_brute_force(changes, orders, pieces):
    versions = history.scd2_history(changes, "user_id", "updated_at")
    # Leave gaps: times for which no version is valid.
    versions = versions.where(F.pmod(F.xxhash64("valid_from"), F.lit(4)) != 0)
    facts = orders.select("order_id", "user_id", "created_at")
    known = [tuple(r) for r in versions.select("user_id", "plan", "valid_from", "valid_to").collect()]

    def plan_at(user, t):
        return next((p for u, p, a, b in known if u == user and a <= t and (b is None or t < b)), None)

    expected = sorted(
        ((o, u, t, plan_at(u, t)) for o, u, t in (tuple(r) for r in facts.collect())), key=lambda r: r[0]
    )
    got = history.asof_user_attributes(facts, versions, "user_id", "created_at", pieces)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == expected


def test_channel_revenue_equals_plain_join(orders, spark, rows):
    users = spark.createDataFrame([("hot", "ads"), ("u1", "mail"), ("u2", None)], "user_id string, acquisition_channel string")
    plain = orders.join(users, "user_id", "left").groupBy("acquisition_channel").agg(F.sum(money("amount")).cast("double"))
    assert rows(reports.revenue_by_channel(orders, users)) == rows(plain)


def test_scd2_apply_rules(spark, rows):
    def users(*data):
        return spark.createDataFrame(data, "user_id string, country string, seen timestamp_ntz")

    t0, t1 = START, START + dt.timedelta(days=1)
    first = history.open_history(users(("1", "a", t0), ("2", "a", t0), ("3", "a", t0)), "user_id", "seen")
    batch = users(("1", "b", t1), ("2", "b", t0), ("4", "a", t1))
    by_time = history.scd2_apply(first, batch, "user_id", "seen")
    assert rows(by_time, "user_id", "country", "valid_to", "is_current") == rows(
        spark.createDataFrame(
            [("1", "a", t1, False), ("1", "b", None, True), ("2", "a", None, True), ("3", "a", None, True), ("4", "a", None, True)],
            "user_id string, country string, valid_to timestamp_ntz, is_current boolean",
        )
    )
    by_value = history.scd2_apply(first, batch, "user_id", "seen", tracked=["country"], as_of="2024-03-01")
    seen_at = dt.datetime(2024, 3, 1)
    assert {(r.user_id, r.country, r.valid_from, r.valid_to) for r in by_value.collect()} == {
        ("1", "a", t0, seen_at),
        ("1", "b", seen_at, None),
        ("2", "a", t0, seen_at),
        ("2", "b", seen_at, None),
        ("3", "a", t0, None),
        ("4", "a", t1, None),
    }
    again = history.scd2_apply(by_value, batch, "user_id", "seen", tracked=["country"], as_of="2024-04-01")
    assert rows(again) == rows(by_value)


def test_one_key_at_one_instant_is_spread(spark):
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    even = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.when(F.col("id") % 2 == 0, moment).otherwise(moment + F.make_interval(mins=F.col("id").cast("int"))).alias("t"),
        F.col("id").alias("order_id"),
    )
    sizes = [r["count"] for r in ordered.in_pieces(even, "user_id", "t", "order_id", pieces=8).groupBy(ordered.PIECE).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 8


def test_facts_without_key_or_time_keep_nulls(spark):
    facts = spark.createDataFrame([("a", None), (None, START), ("a", START), ("b", START)], "u string, t timestamp_ntz")
    versions = history.open_history(spark.createDataFrame([("a", START, "x")], "u string, t timestamp_ntz, plan string"), "u", "t")
    for pieces in (1, 4):
        got = history.asof_user_attributes(facts, versions.drop("t"), "u", "t", pieces)
        assert sorted(((r.u, r.t, r.plan) for r in got.collect()), key=str) == sorted(
            [("a", None, None), (None, START, None), ("a", START, "x"), ("b", START, None)], key=str
        )
