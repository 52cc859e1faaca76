"""Metrics defined once and queried by any dimension and time grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str

    def column(self) -> Column:
        total = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "count_distinct": F.countDistinct}
        return total[self.agg](F.expr(self.expr))


@dataclass(frozen=True)
class SemanticModel:
    """A table's entities, dimensions and measures; `time` is the dimension measures are added up over."""

    name: str
    time: str
    dimensions: tuple[str, ...]
    measures: tuple[Measure, ...]
    entities: tuple[str, ...] = ()

    def measure(self, name: str) -> Measure | None:
        return next((m for m in self.measures if m.name == name), None)


@dataclass(frozen=True)
class Metric:
    """A measure, or with `denominator` the ratio of two."""

    name: str
    measure: str
    denominator: str | None = None

    @property
    def measures(self) -> tuple[str, ...]:
        return (self.measure,) if self.denominator is None else (self.measure, self.denominator)


# Names of models, measures and metrics.
REVENUE = SemanticModel(
    name="revenue",
    time="order_date",
    dimensions=("order_date", "currency", "acquisition_channel"),
    entities=("order_id", "user_id"),
    measures=(
        Measure("total_revenue", "sum", "order_amount"),
        Measure("net_revenue", "sum", "net_revenue"),
        Measure("order_count", "count", "order_id"),
    ),
)
GROWTH = SemanticModel(
    name="growth_metrics",
    time="event_date",
    dimensions=("event_date",),
    entities=("activity_date",),
    measures=(
        Measure("daily_active_users", "sum", "dau"),
        Measure("weekly_active_users", "sum", "wau"),
        Measure("monthly_active_users", "sum", "mau"),
    ),
)
METRICS = {
    m.name: m
    for m in (
        Metric("daily_active_users", "daily_active_users"),
        Metric("weekly_active_users", "weekly_active_users"),
        Metric("monthly_active_users", "monthly_active_users"),
        Metric("dau_mau_stickiness", "daily_active_users", "monthly_active_users"),
        Metric("total_net_revenue", "net_revenue"),
        Metric("total_revenue", "total_revenue"),
        Metric("order_count", "order_count"),
        Metric("average_order_value", "total_revenue", "order_count"),
    )
}


def metric_query(
    tables: Mapping[str, DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    grain: str | None = None,
    where: str | Column | Mapping[str, str | Column] | None = None,
    models: Sequence[SemanticModel] = (REVENUE, GROWTH),
) -> DataFrame:
    """Metrics by dimensions and, with `grain`, by period.

    Each model is filtered and aggregated on its own in one pass; results of several models meet as
    rows and are merged on the group columns, so NULL groups stay together and nothing is multiplied.
    `where` holds for every model, or names a condition per model; a model that lacks its columns is an error.
    """
    wanted = [METRICS[name] for name in metrics]
    needed = list(dict.fromkeys(m for metric in wanted for m in metric.measures))
    keys = (["period"] if grain else []) + list(group_by)
    parts = []
    for model in models:
        mine = {n: model.measure(n) for n in needed if model.measure(n)}
        if not mine:
            continue
        unknown = [d for d in group_by if d not in model.dimensions]
        if unknown:
            raise ValueError(f"model {model.name} has no dimension {unknown}")
        rows = tables[model.name]
        condition = where.get(model.name) if isinstance(where, Mapping) else where
        if condition is not None:
            try:
                rows = rows.where(condition)
                rows.schema  # noqa: B018 - resolves the condition
            except AnalysisException as error:
                raise ValueError(f"model {model.name} cannot be filtered by {condition}; give one condition per model") from error
        groups = [F.to_date(F.date_trunc(grain, model.time)).alias("period")] if grain else []
        groups += [F.col(d) for d in group_by]
        parts.append(rows.groupBy(*groups).agg(*[m.column().alias(f"__{n}") for n, m in mine.items()]))
    missing = set(needed) - {c[2:] for p in parts for c in p.columns if c.startswith("__")}
    if missing:
        raise ValueError(f"no model has the measures {sorted(missing)}")
    merged = parts[0]
    if len(parts) > 1:
        together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        merged = together.groupBy(*keys).agg(*[F.max(f"__{n}").alias(f"__{n}") for n in needed])

    def value(metric: Metric) -> Column:
        top = F.col(f"__{metric.measure}")
        if metric.denominator is None:
            return top
        return F.try_divide(top.cast("double"), F.col(f"__{metric.denominator}").cast("double"))

    return merged.select(*keys, *[value(m).alias(m.name) for m in wanted])
