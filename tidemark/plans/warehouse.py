"""The layered warehouse: raw tables to staging, fact and marts, as views or stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import activity, cleaning, experiments, funnels, quality, revenue, sessions
from tidemark.sinks.writers import write_table
from tidemark.sources import star_schema

Layout = Mapping[str, tuple[Sequence[str], Sequence[str]]]


@dataclass(frozen=True)
class Vocabulary:
    """Event names the marts look for."""

    view: str = "view_product"
    cart: str = "add_to_cart"
    checkout: str = "checkout"
    purchase: str = "purchase"

    @property
    def steps(self) -> tuple[str, str, str, str]:
        return (self.view, self.cart, self.checkout, self.purchase)


@dataclass
class RawTables:
    """Suppliers of the raw tables; each is called when first needed."""

    users: Callable[[], DataFrame]
    orders: Callable[[], DataFrame]
    refunds: Callable[[], DataFrame]
    events: Callable[[], DataFrame]
    assignments: Callable[[], DataFrame]
    pre_experiment: Callable[[], DataFrame]
    converters: Callable[[], DataFrame] | None = None


@dataclass
class Warehouse:
    """Lazy models. Nothing runs until a result is used; one plan spans all layers.

    `events_as_written` feeds marts the first event per user in place of one row per event id.
    """

    raw: RawTables
    words: Vocabulary = field(default_factory=Vocabulary)
    as_of: dt.datetime | str | None = None
    events_as_written: bool = False

    @cached_property
    def stg_orders(self) -> DataFrame:
        return cleaning.stg_orders(self.raw.orders())

    @cached_property
    def stg_users(self) -> DataFrame:
        return cleaning.stg_users(self.raw.users())

    @cached_property
    def stg_refunds(self) -> DataFrame:
        return cleaning.stg_refunds(self.raw.refunds())

    @cached_property
    def stg_events(self) -> DataFrame:
        stage = cleaning.stg_events_as_written if self.events_as_written else cleaning.stg_events
        return stage(self.raw.events())

    @cached_property
    def stg_experiment_assignments(self) -> DataFrame:
        return cleaning.stg_experiment_assignments(self.raw.assignments())

    @cached_property
    def stg_user_pre_experiment(self) -> DataFrame:
        return cleaning.stg_user_pre_experiment(self.raw.pre_experiment())

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return revenue.orders_enriched(self.stg_orders, self.stg_users)

    @cached_property
    def int_order_refunds(self) -> DataFrame:
        return revenue.order_refunds(self.stg_refunds)

    @cached_property
    def fct_revenue(self) -> DataFrame:
        return revenue.fct_revenue_from_staging(self.stg_orders, self.stg_users, self.int_order_refunds)

    @cached_property
    def net_orders(self) -> DataFrame:
        """The fact without user attributes: marts that need none skip the join with users."""
        return revenue.net_orders(self.stg_orders, self.int_order_refunds)

    @cached_property
    def mart_monthly_revenue(self) -> DataFrame:
        return revenue.monthly_revenue(self.net_orders)

    @cached_property
    def mart_user_ltv(self) -> DataFrame:
        return revenue.user_ltv(self.net_orders)

    @cached_property
    def mart_user_retention(self) -> DataFrame:
        return revenue.user_retention(self.stg_users, self.net_orders)

    @cached_property
    def mart_product_metrics(self) -> DataFrame:
        w = self.words
        return activity.product_metrics(self.stg_events, w.purchase, w.view, w.cart)

    @cached_property
    def mart_growth_metrics(self) -> DataFrame:
        return activity.growth_metrics_as_written(self.stg_events, self.words.purchase)

    @cached_property
    def mart_growth_accounting(self) -> DataFrame:
        return activity.growth_accounting(self.stg_events)

    @cached_property
    def mart_feature_adoption(self) -> DataFrame:
        return activity.feature_adoption(self.stg_events)

    @cached_property
    def mart_funnel_conversion(self) -> DataFrame:
        w = self.words
        return funnels.funnel_step_times(self.stg_events, w.view, w.cart, w.purchase)

    @cached_property
    def mart_multi_step_funnel(self) -> DataFrame:
        return funnels.multi_step_funnel(self.stg_events, self.words.steps)

    @cached_property
    def mart_sequential_funnel(self) -> DataFrame:
        return funnels.sequential_funnel(self.stg_events, self.words.steps)

    @cached_property
    def mart_user_sessions(self) -> DataFrame:
        return sessions.user_sessions(self.stg_events)

    @cached_property
    def converters(self) -> DataFrame:
        if self.raw.converters is not None:
            return self.raw.converters()
        return self.stg_events.where(self.stg_events.event_name == self.words.purchase).select("user_id").distinct()

    @cached_property
    def mart_ab_test_results(self) -> DataFrame:
        return experiments.ab_test_results(
            self.stg_experiment_assignments, self.converters, self.stg_user_pre_experiment, self.as_of
        )

    def monitored(self, models: dict[str, DataFrame] | None = None) -> DataFrame:
        """Health of the four critical models, from stored tables where given."""
        dates = {
            "fct_revenue": "order_date",
            "mart_growth_metrics": "event_date",
            "mart_user_retention": "cohort_month",
            "mart_ab_test_results": "experiment_start_date",
        }
        stored = models or {}
        found = {name: (stored[name] if name in stored else getattr(self, name), c) for name, c in dates.items()}
        return quality.pipeline_monitoring(found, self.as_of)

    @contextmanager
    def cached(self, *models: str) -> Iterator[Warehouse]:
        """Keep models that several marts share, such as staged events, for the length of a block."""
        kept = [getattr(self, name).persist() for name in models]
        try:
            yield self
        finally:
            for df in kept:
                df.unpersist()

    def save(self, root: str, models: Iterable[str], layout: Layout | None = None) -> dict[str, DataFrame]:
        """Store models as tables, in the given order; later ones read the stored earlier ones.

        `layout` names folder columns and clustering columns per model; by default the fact has a folder per day.

        Saving again to the same root stores new versions; the ones before stay until somebody deletes them.
        """
        stored, layout = {}, LAYOUT if layout is None else layout
        for name in models:
            folders, clusters = layout.get(name, ((), ()))
            stored[name] = write_table(getattr(self, name), f"{root}/{name}", folders, clusters)
            self.__dict__[name] = stored[name]
        return stored


#: Folder columns and the columns that rows are clustered by, of tables that are read by date.
LAYOUT: Layout = {"fct_revenue": (("order_date",), ("user_id",))}

MODELS = (
    "stg_orders",
    "stg_users",
    "stg_refunds",
    "stg_events",
    "stg_experiment_assignments",
    "stg_user_pre_experiment",
    "int_orders_enriched",
    "int_order_refunds",
    "fct_revenue",
    "mart_monthly_revenue",
    "mart_user_ltv",
    "mart_user_retention",
    "mart_product_metrics",
    "mart_growth_metrics",
    "mart_growth_accounting",
    "mart_feature_adoption",
    "mart_funnel_conversion",
    "mart_multi_step_funnel",
    "mart_sequential_funnel",
    "mart_user_sessions",
    "mart_ab_test_results",
)


def from_star_schema(
    spark: SparkSession, sf_dir: str, as_of: str | None = None, events_as_written: bool = False
) -> Warehouse:
    """The warehouse over the star-schema test tables."""
    raw = RawTables(
        users=lambda: star_schema.users_raw(spark, sf_dir),
        orders=lambda: star_schema.orders_raw(spark, sf_dir),
        refunds=lambda: star_schema.refunds_raw(spark, sf_dir),
        events=lambda: star_schema.events_raw(spark, sf_dir),
        assignments=lambda: star_schema.experiment_assignments_raw(spark, sf_dir),
        pre_experiment=lambda: star_schema.user_pre_experiment_raw(spark, sf_dir),
        converters=lambda: star_schema.converters(spark, sf_dir),
    )
    words = Vocabulary(view="view", cart="click", checkout="signup", purchase="purchase")
    return Warehouse(raw, words, as_of, events_as_written)
