"""Declarative checks, contracts, freshness and monitoring. Every result is a small table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = ("table_name", "column_name", "check_name", "failures", "status")


@dataclass(frozen=True)
class NotNull:
    column: str

    def failures(self) -> Column:
        return F.count_if(F.col(self.column).isNull())

    name = "not_null"


@dataclass(frozen=True)
class Between:
    """Both bounds included; NULL passes."""

    column: str
    low: float
    high: float

    def failures(self) -> Column:
        return F.count_if(~F.col(self.column).between(self.low, self.high))

    name = "between"


@dataclass(frozen=True)
class Accepted:
    """NULL passes."""

    column: str
    values: tuple

    def failures(self) -> Column:
        return F.count_if(~F.col(self.column).isin(*self.values))

    name = "accepted_values"


@dataclass(frozen=True)
class RowCount:
    low: int
    high: int | None = None
    column: str = "*"

    def failures(self) -> Column:
        n = F.count(F.lit(1))
        ok = n >= self.low if self.high is None else n.between(self.low, self.high)
        return F.when(ok, F.lit(0)).otherwise(F.lit(1))

    name = "row_count"


@dataclass(frozen=True)
class Unique:
    """Fails once per value that occurs more than once; NULL passes. Several columns are given as "a, b"."""

    column: str

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in self.column.split(",")]

    name = "unique"


Rule = NotNull | Between | Accepted | RowCount | Unique


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _result(df: DataFrame) -> DataFrame:
    failures = F.col("failures").cast("bigint")
    status = F.when(failures == 0, "pass").otherwise("fail")
    return df.withColumn("failures", failures).withColumn("status", status).select(*RESULT)


def run_table_checks(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """All checks of one table: one aggregate pass, plus one pre-aggregated count per unique column."""
    parts = []
    passes = [r for r in rules if not isinstance(r, Unique)]
    if passes:
        totals = df.agg(*[r.failures().cast("bigint").alias(f"f{i}") for i, r in enumerate(passes)])
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.name).alias("check_name"),
                F.col(f"f{i}").alias("failures"),
            )
            for i, r in enumerate(passes)
        ]
        parts.append(totals.select(F.inline(F.array(*rows))))
    for rule in rules:
        if isinstance(rule, Unique):
            known = df.dropna("any", subset=rule.columns)
            counted = known.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                counted.agg(F.count_if(F.col("n") > 1).alias("failures")).select(
                    F.lit(table).alias("table_name"),
                    F.lit(rule.column).alias("column_name"),
                    F.lit(rule.name).alias("check_name"),
                    "failures",
                )
            )
    return _result(_union(parts))


def run_checks(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """Checks of many tables in one result. Give stored tables: each is scanned, not rebuilt."""
    return _union([run_table_checks(tables[name], table_rules, name) for name, table_rules in rules.items()])


def check_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    return run_table_checks(df, [NotNull(c) for c in columns], table)


def check_unique(df: DataFrame, column: str, table: str) -> DataFrame:
    return run_table_checks(df, [Unique(column)], table)


def check_between(df: DataFrame, column: str, low: float, high: float, table: str) -> DataFrame:
    return run_table_checks(df, [Between(column, low, high)], table)


def check_accepted_values(df: DataFrame, column: str, values: Sequence, table: str) -> DataFrame:
    return run_table_checks(df, [Accepted(column, tuple(values))], table)


def check_row_count(df: DataFrame, low: int, high: int | None, table: str) -> DataFrame:
    return run_table_checks(df, [RowCount(low, high)], table)


def schema_issues(actual: T.StructType, declared: T.StructType) -> list[tuple[str, str]]:
    """(column, what is wrong) for columns that are missing, undeclared or of another type."""
    found = {f.name: f.dataType for f in actual.fields}
    wanted = {f.name: f.dataType for f in declared.fields}
    issues = [(c, "missing column") for c in wanted if c not in found]
    issues += [(c, "undeclared column") for c in found if c not in wanted]
    issues += [
        (c, f"type {found[c].simpleString()}, declared {t.simpleString()}")
        for c, t in wanted.items()
        if c in found and found[c] != t
    ]
    return issues


def check_contract(df: DataFrame, expected: T.StructType, not_null: Sequence[str], table: str) -> DataFrame:
    """Differences between a table and its declared columns, types and not-null constraints."""
    issues = schema_issues(df.schema, expected)
    checked = [c for c in not_null if c in df.columns]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in checked], F.lit(0).alias("__none"))
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit("null values").alias("issue"), (F.col(c) > 0).alias("broken"))
        for c in checked
    ]
    rows += [
        F.struct(F.lit(c).alias("column_name"), F.lit(text).alias("issue"), F.lit(True).alias("broken"))
        for c, text in issues
    ]
    if not rows:
        rows = [F.struct(F.lit("").alias("column_name"), F.lit("").alias("issue"), F.lit(False).alias("broken"))]
    return (
        nulls.select(F.inline(F.array(*rows)))
        .where("broken")
        .select(F.lit(table).alias("table_name"), "column_name", "issue")
    )


def _moment(as_of: dt.datetime | str | None) -> Column:
    return F.current_timestamp().cast("timestamp_ntz") if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def source_freshness(
    tables: Mapping[str, DataFrame],
    as_of: dt.datetime | str | None = None,
    warn_hours: float = 24,
    error_hours: float = 48,
    loaded_at: str = "_loaded_at",
    limits: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Age of the latest load per table. `limits` overrides (warn, error) hours for single tables."""
    now = _moment(as_of)
    parts = []
    for name, df in tables.items():
        warn, error = (limits or {}).get(name, (warn_hours, error_hours))
        age = F.timestamp_diff("SECOND", F.col("latest_load").cast("timestamp_ntz"), now) / 3600.0
        status = F.when(age > error, "error").when(age > warn, "warn").when(age.isNull(), "error").otherwise("pass")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), F.max(loaded_at).alias("latest_load")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                "latest_load",
                F.datediff(now.cast("date"), F.col("latest_load").cast("date")).alias("days_stale"),
                status.alias("status"),
            )
        )
    return _union(parts)


def row_count_minimums(tables: Mapping[str, DataFrame], minimums: Mapping[str, int]) -> DataFrame:
    parts = [
        tables[name]
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(low).cast("bigint").alias("min_rows"),
            F.when(F.col("row_count") < low, "fail").otherwise("pass").alias("status"),
        )
        for name, low in minimums.items()
    ]
    return _union(parts)


# Health labels, worst first.
HEALTH = ("CRITICAL - empty table", "WARNING - low row count", "OK")


def pipeline_monitoring(
    models: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime | str | None = None
) -> DataFrame:
    """Row count, latest date and health of each model, worst first."""
    now = _moment(as_of)
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col(date_col).cast("date")).alias("latest_date")).select(
            F.lit(name).alias("model_name"), "row_count", "latest_date"
        )
        for name, (df, date_col) in models.items()
    ]
    n = F.col("row_count")
    health = F.when(n == 0, HEALTH[0]).when(n < 2, HEALTH[1]).otherwise(HEALTH[2])
    return (
        _union(parts)
        .select(
            "model_name",
            "row_count",
            "latest_date",
            now.alias("checked_at"),
            health.alias("health_status"),
            F.datediff(now.cast("date"), F.col("latest_date")).alias("days_since_latest_data"),
        )
        .orderBy(F.array_position(F.array(*[F.lit(h) for h in HEALTH]), F.col("health_status")), "model_name")
    )
