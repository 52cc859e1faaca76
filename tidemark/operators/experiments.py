"""A/B tests: cells, CUPED adjustment, per-experiment results, significance, power, contamination."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import normal_quantile, safe_divide, two_sided_p
from tidemark.operators.joins import join_uneven

CELL = ("experiment_id", "experiment_name", "experiment_group")
START = "experiment_start_date"


def ab_user_level(assignments: DataFrame, converters: DataFrame, pre: DataFrame) -> DataFrame:
    """Assignments with a conversion flag and the user's rate before the experiment.

    Converters are made distinct first, so assignments are never multiplied.
    """
    converted = converters.select("user_id").distinct().withColumn("hit", F.lit(1))
    rates = pre.select("user_id", "pre_experiment_conversion_rate")
    with_conversion = join_uneven(assignments, converted, "user_id")
    return (
        join_uneven(with_conversion, rates, "user_id")
        .select(
            "experiment_id",
            "experiment_name",
            "user_id",
            "experiment_group",
            START,
            F.coalesce("hit", F.lit(0)).alias("converted"),
            F.coalesce("pre_experiment_conversion_rate", F.lit(0.0)).alias("pre_experiment_rate"),
        )
    )


def ab_cells(user_level: DataFrame, pooled: bool = False) -> DataFrame:
    """Size, conversions and moments of each cell: per group and start date, or per group if pooled."""
    keys = CELL if pooled else (*CELL, START)
    y, x = F.col("converted").cast("double"), F.col("pre_experiment_rate")
    aggs = [
        F.countDistinct("user_id").alias("users"),
        F.sum("converted").alias("conversions"),
        F.avg(y).alias("mean_y"),
        F.avg(x).alias("mean_x"),
        F.covar_samp(y, x).alias("cov_yx"),
        F.var_samp(x).alias("var_x"),
    ]
    if pooled:
        aggs.append(F.min(START).alias(START))
    return (
        user_level.groupBy(*keys)
        .agg(*aggs)
        .select(
            *CELL,
            START,
            "users",
            "conversions",
            safe_divide("conversions", "users").alias("conversion_rate"),
            "mean_y",
            "mean_x",
            "cov_yx",
            "var_x",
        )
    )


def cuped_adjust(cells: DataFrame) -> DataFrame:
    """Conversion mean of each cell less theta times the mean of the pre-experiment rate."""
    theta = safe_divide("cov_yx", "var_x")
    return cells.select(
        *CELL,
        START,
        "users",
        "conversions",
        "conversion_rate",
        (F.col("mean_y") - theta * F.col("mean_x")).alias("cuped_conversion_rate"),
    )


def pivot_groups(cuped: DataFrame, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """One row per experiment; each number is the largest over the group's cells."""
    fields = {
        "users": "users",
        "conversions": "conversions",
        "conversion_rate": "rate",
        "cuped_conversion_rate": "cuped_rate",
    }
    picks = [
        F.max(F.when(F.col("experiment_group") == group, F.col(src))).alias(f"{side}_{dst}")
        for src, dst in fields.items()
        for side, group in (("control", control), ("treatment", treatment))
    ]
    return cuped.groupBy("experiment_id", "experiment_name").agg(F.min(START).alias(START), *picks)


def _z(c: str = "control", t: str = "treatment") -> Column:
    """Two-proportion z from the (rounded) rates; NULL where the pooled rate has no variance."""
    nc, nt = F.col(f"{c}_users").cast("double"), F.col(f"{t}_users").cast("double")
    pooled = F.try_divide((F.col(f"{c}_conversions") + F.col(f"{t}_conversions")).cast("double"), nc + nt)
    spread = F.sqrt(pooled * (1.0 - pooled) * (F.try_divide(F.lit(1.0), nc) + F.try_divide(F.lit(1.0), nt)))
    return F.try_divide(F.abs(F.col(f"{t}_rate") - F.col(f"{c}_rate")), spread)


def _summarise(
    pivoted: DataFrame, as_of: dt.datetime | str | None, srm: float, z: float, min_days: int
) -> DataFrame:
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    rc, rt = F.col("control_rate"), F.col("treatment_rate")
    nc, nt = F.col("control_users"), F.col("treatment_users")
    imbalance = F.try_divide(F.abs(nc - nt).cast("double"), (nc + nt).cast("double"))
    days = F.datediff(now.cast("date"), F.col(START))
    return pivoted.select(
        "experiment_id",
        "experiment_name",
        START,
        nc,
        nt,
        (nc + nt).alias("total_users"),
        "control_conversions",
        "treatment_conversions",
        F.round(rc, 4).alias("control_conversion_rate"),
        F.round(rt, 4).alias("treatment_conversion_rate"),
        F.round(rt - rc, 4).alias("absolute_lift"),
        safe_divide(rt - rc, rc).alias("relative_lift"),
        F.round("control_cuped_rate", 4).alias("control_cuped_conversion_rate"),
        F.round("treatment_cuped_rate", 4).alias("treatment_cuped_conversion_rate"),
        F.round(F.col("treatment_cuped_rate") - F.col("control_cuped_rate"), 4).alias("cuped_absolute_lift"),
        F.coalesce(imbalance > srm, F.lit(False)).alias("sample_ratio_mismatch"),
        F.coalesce(_z() > z, F.lit(False)).alias("is_significant"),
        days.alias("days_running"),
        F.coalesce(days >= min_days, F.lit(False)).alias("has_minimum_duration"),
        now.alias("calculated_at"),
    )


def ab_test_results(
    assignments: DataFrame,
    converters: DataFrame,
    pre: DataFrame,
    as_of: dt.datetime | str | None = None,
    srm: float = 0.05,
    z: float = 1.96,
    min_days: int = 7,
) -> DataFrame:
    """Results per experiment; a group's numbers are those of its largest start-date cell.

    `ab_test_pooled` counts whole groups.
    """
    cells = ab_cells(ab_user_level(assignments, converters, pre))
    return _summarise(pivot_groups(cuped_adjust(cells)), as_of, srm, z, min_days)


def ab_test_pooled(
    assignments: DataFrame,
    converters: DataFrame,
    pre: DataFrame,
    as_of: dt.datetime | str | None = None,
    srm: float = 0.05,
    z: float = 1.96,
    min_days: int = 7,
) -> DataFrame:
    """Results per experiment over whole groups, whatever their start dates."""
    cells = ab_cells(ab_user_level(assignments, converters, pre), pooled=True)
    return _summarise(pivot_groups(cuped_adjust(cells)), as_of, srm, z, min_days)


def ab_z_score(pivoted: DataFrame) -> DataFrame:
    """The z-score behind the significance flag and its two-sided p-value."""
    return pivoted.select("experiment_id", _z().alias("z_score")).withColumn("p_value", two_sided_p(F.col("z_score")))


def ab_power(pivoted: DataFrame, mde: float, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Users per group needed to see an absolute lift of `mde` over the control rate, and whether they are there."""
    factor = (normal_quantile(1 - alpha / 2) + normal_quantile(power)) ** 2
    p1 = F.col("control_rate")
    p2 = p1 + F.lit(mde)
    needed = F.ceil(F.lit(factor) * (p1 * (1.0 - p1) + p2 * (1.0 - p2)) / F.lit(mde * mde)).cast("bigint")
    actual = F.least("control_users", "treatment_users")
    return pivoted.select(
        "experiment_id",
        p1.alias("baseline_rate"),
        needed.alias("required_per_group"),
        actual.alias("actual_min_group"),
        (actual >= needed).alias("is_powered"),
    )


def assignment_contamination(assignments: DataFrame) -> DataFrame:
    """Users that are in more than one group of an experiment."""
    return (
        assignments.groupBy("experiment_id", "user_id")
        .agg(F.countDistinct("experiment_group").alias("n_groups"))
        .where(F.col("n_groups") > 1)
    )


def ab_sequential(assignments: DataFrame, conversions: DataFrame, alpha: float = 0.05, tau: float = 0.05) -> DataFrame:
    """The test of each experiment after every day, with p-values that stay valid however often one looks.

    `conversions` has user_id and converted_at; a user converts with the first one from their assignment on. The
    p-value of a day is the smallest so far of 1 / (likelihood ratio of a normal mixture of lifts, standard deviation
    `tau`, against none), so it never rises and under no lift falls below `alpha` on any day with at most that
    probability. Users are reduced to counts per group and day before the days are added up.
    """
    keys = ("experiment_id", "experiment_group", "user_id")
    entered = assignments.groupBy(*keys).agg(F.min("assigned_at").alias("assigned_at"))
    # Equal times of a user are one; the join is on the user, of whom a busy one may have very many.
    times = conversions.select("user_id", "converted_at").distinct()
    later = join_uneven(times, entered, "user_id", "inner").where(F.col("converted_at") >= F.col("assigned_at"))
    first = later.groupBy(*keys).agg(F.min("converted_at").alias("converted_at"))

    def per_day(rows: DataFrame, at: str, measure: str) -> DataFrame:
        group = F.col("experiment_group")
        counts = [F.count_if(group == g).alias(f"{g}_{measure}") for g in ("control", "treatment")]
        return rows.groupBy("experiment_id", F.to_date(at).alias("day")).agg(*counts)

    daily = per_day(entered, "assigned_at", "users").unionByName(per_day(first, "converted_at", "conversions"), True)
    names = [f"{g}_{m}" for m in ("users", "conversions") for g in ("control", "treatment")]
    days = daily.groupBy("experiment_id", "day").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    # At most one row per day of the experiment.
    so_far = W.partitionBy("experiment_id").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    seen = days.select("experiment_id", "day", *[F.sum(c).over(so_far).alias(c) for c in names])

    def rate(group: str) -> Column:
        return F.try_divide(F.col(f"{group}_conversions").cast("double"), F.col(f"{group}_users").cast("double"))

    def variance(group: str) -> Column:
        return F.try_divide(rate(group) * (1 - rate(group)), F.col(f"{group}_users").cast("double"))

    rated = seen.withColumn("lift", rate("treatment") - rate("control"))
    rated = rated.withColumn("v", variance("treatment") + variance("control"))
    v, square = F.col("v"), F.lit(tau * tau)
    against = F.exp(-square * F.col("lift") * F.col("lift") / (2 * v * (v + square))) * F.sqrt((v + square) / v)
    today = F.when(v > 0, F.least(F.lit(1.0), against)).otherwise(1.0)
    p = F.round(F.min("__today").over(so_far), 8)
    return (
        rated.withColumn("__today", today)
        .withColumn("always_valid_p", p)
        .select(
            "experiment_id",
            "day",
            *names,
            F.round("lift", 8).alias("lift"),
            "always_valid_p",
            (F.col("always_valid_p") < alpha).alias("may_stop"),
        )
    )
