"""Who is active when: daily metrics, growth accounting, rolling actives, adoption, gap filling.

Input `ev` has user_id, event_name and event_timestamp. Everything about a user's history works on
distinct (user, day) rows, which each map task forms before the shuffle: a user with very many events
weighs no more than the days they were active on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import date_spine, local_date, safe_divide


def _day(tz: str | None) -> Column:
    """Date of an event, in UTC or in the business's own time zone."""
    return F.to_date("event_timestamp") if tz is None else local_date("event_timestamp", tz)


def user_days(ev: DataFrame, *extra: str, tz: str | None = None) -> DataFrame:
    """Distinct (user, day)."""
    return ev.select("user_id", _day(tz).alias("activity_date"), *extra).distinct()


def _is(name: str):
    return F.col("event_name") == name


def product_metrics(
    ev: DataFrame,
    purchase: str = "purchase",
    view: str = "view_product",
    cart: str = "add_to_cart",
    tz: str | None = None,
) -> DataFrame:
    """Daily users, events, purchases, views, cart additions and purchases per active user.

    Days are those of `tz`, or UTC.
    """
    daily = ev.groupBy(_day(tz).alias("event_date")).agg(
        F.countDistinct("user_id").alias("daily_active_users"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(_is(purchase)).alias("purchases"),
        F.count_if(_is(view)).alias("product_views"),
        F.count_if(_is(cart)).alias("cart_adds"),
    )
    rate = F.try_divide(F.col("purchases").cast("double"), F.col("daily_active_users").cast("double"))
    return daily.withColumn("purchase_conversion_rate", F.round(rate, 4))


def growth_metrics_as_written(ev: DataFrame, purchase: str = "purchase", tz: str | None = None) -> DataFrame:
    """Daily users with weekly and monthly users set to the daily number, so stickiness is 1.

    `rolling_active_users` has the true weekly and monthly numbers.
    """
    dau = F.col("dau")
    return (
        ev.groupBy(_day(tz).alias("event_date"))
        .agg(F.countDistinct("user_id").alias("dau"), F.count_if(_is(purchase)).alias("purchases"))
        .select(
            "event_date",
            "dau",
            dau.alias("wau"),
            dau.alias("mau"),
            "purchases",
            safe_divide(dau, dau).alias("stickiness_ratio"),
            safe_divide("purchases", dau).alias("purchase_conversion_rate"),
        )
        .orderBy("event_date")
    )


def rolling_active_users(
    ev: DataFrame,
    windows: tuple[int, int, int] = (1, 7, 30),
    approx: bool = False,
    by: Sequence[str] = (),
    tz: str | None = None,
) -> DataFrame:
    """Distinct users of the last 1, 7 and 30 days, for every day that has events.

    Exact form: each active day of a user is credited to the days until the same user's next active
    day, so nobody is counted twice in a window and no distinct count over a window is needed. Users
    collapse into (day, days until next) counts before anything is spread over the calendar.
    Approximate form: one sketch per day, merged over the window.
    `by` splits the users, and then the days with events are those of each value; days are those of `tz`, or UTC.
    """
    longest = max(windows)
    if approx:
        days = ev.groupBy(*by, _day(tz).alias("day")).agg(F.hll_sketch_agg("user_id").alias("users"))
        spread = days.select(*by, "users", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("age"), "day")

        def actives(n: int):
            return F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("age") < n, F.col("users"))))

        seen = F.count_if(F.col("age") == 0) > 0
    else:
        nxt = F.lead("activity_date").over(W.partitionBy(*by, "user_id").orderBy("activity_date"))
        until = F.least(F.coalesce(F.datediff(nxt, "activity_date"), F.lit(longest)), F.lit(longest))
        counts = (
            user_days(ev, *by, tz=tz)
            .select(*by, "user_id", F.col("activity_date").alias("day"), until.alias("until"))
            .groupBy(*by, "day", "until")
            .agg(F.count("user_id").alias("users"))
        )
        spread = counts.select(*by, "users", F.explode(F.expr("sequence(0, until - 1)")).alias("age"), "day")

        def actives(n: int):
            return F.coalesce(F.sum(F.when(F.col("age") < n, F.col("users"))), F.lit(0))

        seen = F.count_if(F.col("age") == 0) > 0
    names = ("dau", "wau", "mau")
    out = (
        spread.groupBy(*by, F.date_add("day", F.col("age")).alias("event_date"))
        .agg(*[actives(n).alias(c) for c, n in zip(names, windows)], seen.alias("seen"))
        .where("seen")
    )
    return out.select(*by, "event_date", *names, safe_divide("dau", "mau").alias("stickiness_ratio"))


def growth_accounting(
    ev: DataFrame, resurrect_after_days: int = 7, by: Sequence[str] = (), tz: str | None = None
) -> DataFrame:
    """Daily actives split into new, retained and resurrected users.

    `by` names columns of `ev` that split the users, such as their channel: a user is new in each value
    of them. Days are those of `tz`, or UTC.
    """
    previous = F.lag("activity_date").over(W.partitionBy(*by, "user_id").orderBy("activity_date"))
    gap = F.datediff("activity_date", "previous")

    def users_if(condition):
        return F.count(F.when(condition, F.col("user_id")))

    per_day = (
        user_days(ev, *by, tz=tz)
        .withColumn("previous", previous)
        .groupBy(*by, "activity_date")
        .agg(
            users_if(F.col("previous").isNull()).alias("new_users"),
            users_if(gap <= resurrect_after_days).alias("retained_users"),
            users_if(gap > resurrect_after_days).alias("resurrected_users"),
            F.count("user_id").alias("dau"),
        )
    )
    return per_day.select(
        "*",
        safe_divide("retained_users", "dau").alias("retention_ratio"),
        safe_divide("new_users", "dau").alias("new_user_ratio"),
    ).orderBy("activity_date", *by)


def churned_users(ev: DataFrame, by: Sequence[str] = (), tz: str | None = None) -> DataFrame:
    """For every day with events: users active the day before and not on that day.

    `by` splits the users, and then the days with events are those of each value; days are those of `tz`, or UTC.
    """
    nxt = F.lead("activity_date").over(W.partitionBy(*by, "user_id").orderBy("activity_date"))
    tomorrow = F.date_add("activity_date", 1)
    gone = F.when((nxt == tomorrow) | F.col("user_id").isNull(), 0).otherwise(1)
    marks = F.array(
        F.struct(F.col("activity_date").alias("day"), F.lit(1).alias("active"), F.lit(0).alias("churned")),
        F.struct(tomorrow.alias("day"), F.lit(0).alias("active"), F.col("gone").alias("churned")),
    )
    return (
        user_days(ev, *by, tz=tz)
        .withColumn("gone", gone)
        .select(*by, F.explode(marks).alias("m"))
        .groupBy(*by, F.col("m.day").alias("activity_date"))
        .agg(F.sum("m.active").alias("active"), F.sum("m.churned").alias("churned_users"))
        .where("active > 0")
        .drop("active")
    )


def feature_adoption(ev: DataFrame) -> DataFrame:
    """Share of all users that used each feature.

    The total is the number of users' first features, so it needs no second scan: it is the sum over the rows
    per feature, one number.
    """
    pairs = ev.groupBy("user_id", F.col("event_name").alias("feature")).agg(F.lit(1).alias("used"))
    first = F.row_number().over(W.partitionBy("user_id").orderBy("feature")) == 1
    per_feature = (
        pairs.withColumn("first", first)
        .groupBy("feature")
        .agg(
            F.count("user_id").alias("users_using_feature"),
            F.count_if(F.col("first") & F.col("user_id").isNotNull()).alias("firsts"),
        )
    )
    total = per_feature.agg(F.sum("firsts")).scalar()
    return (
        per_feature.withColumn("total_users", total)
        .select(
            "feature",
            "users_using_feature",
            "total_users",
            safe_divide("users_using_feature", "total_users").alias("adoption_rate"),
        )
        .orderBy(F.desc("adoption_rate"), "feature")
    )


def fill_gaps(df: DataFrame, date_col: str, start: str, end: str, zero_cols: Sequence[str]) -> DataFrame:
    """Add a row for every missing date of the range, with 0 in the given columns; rows outside the range stay."""
    spine = date_spine(df.sparkSession, "day", start, end, name=date_col)
    joined = spine.join(df, date_col, "full")
    zeros = {c: F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType) for c in zero_cols}
    return joined.withColumns(zeros).select(*df.columns)
