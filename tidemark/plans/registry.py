"""Registered queries: every operator run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import functions as fn
from tidemark.operators import (
    activity,
    cleaning,
    experiments,
    funnels,
    history,
    order_events,
    ordered,
    quality,
    reports,
    revenue,
    sessions,
)
from tidemark.plans import contracts, dashboards, incremental, semantic
from tidemark.plans.quality_rules import CONTRACT_NOT_NULL, FCT_REVENUE_CONTRACT, RULES, STG_ORDERS_CONTRACT
from tidemark.plans.stored_history import StoredHistory
from tidemark.plans.warehouse import MODELS, Warehouse, from_star_schema
from tidemark.session import fresh_dir, tune
from tidemark.sinks import writers
from tidemark.sources import readers, schemas, star_schema
from tidemark.streaming import io as stream_io
from tidemark.streaming import operators as stream_ops

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-01 00:00:00"
STEPS = ("view", "click", "signup", "purchase")


def query(body: Query) -> Query:
    """Register under the function's name; the session gets this package's settings first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return body(tune(spark), sf_dir)

    QUERIES[body.__name__] = run
    return run


def _warehouse(spark: SparkSession, sf_dir: str, as_written: bool = False) -> Warehouse:
    return from_star_schema(spark, sf_dir, AS_OF, as_written)


def _from_model(name: str, attribute: str, as_written: bool = False) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_warehouse(tune(spark), sf_dir, as_written), attribute)

    run.__name__ = name
    QUERIES[name] = run


for _name, _attribute in {
    "stg_orders": "stg_orders",
    "stg_users": "stg_users",
    "stg_refunds": "stg_refunds",
    "stg_events": "stg_events",
    "stg_experiment_assignments": "stg_experiment_assignments",
    "stg_user_pre_experiment": "stg_user_pre_experiment",
    "orders_enriched": "int_orders_enriched",
    "order_refunds": "int_order_refunds",
    "fct_revenue": "fct_revenue",
    "monthly_revenue": "mart_monthly_revenue",
    "user_ltv": "mart_user_ltv",
    "user_retention": "mart_user_retention",
    "product_metrics": "mart_product_metrics",
    "growth_metrics_as_written": "mart_growth_metrics",
    "growth_accounting": "mart_growth_accounting",
    "feature_adoption": "mart_feature_adoption",
    "funnel_step_times": "mart_funnel_conversion",
    "multi_step_funnel": "mart_multi_step_funnel",
    "sequential_funnel": "mart_sequential_funnel",
    "user_sessions": "mart_user_sessions",
    "ab_test_results": "mart_ab_test_results",
}.items():
    _from_model(_name, _attribute)

for _name, _attribute in {
    "stg_events_as_written": "stg_events",
    "product_metrics_first_event": "mart_product_metrics",
    "growth_metrics_first_event": "mart_growth_metrics",
    "growth_accounting_first_event": "mart_growth_accounting",
    "feature_adoption_first_event": "mart_feature_adoption",
    "multi_step_funnel_first_event": "mart_multi_step_funnel",
    "sequential_funnel_first_event": "mart_sequential_funnel",
    "user_sessions_first_event": "mart_user_sessions",
}.items():
    _from_model(_name, _attribute, as_written=True)


# --- Scans -------------------------------------------------------------------------------------


@query
def read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "raw")
    writers.write_snappy_parquet(star_schema.orders_raw(spark, sf_dir), f"{root}/orders_raw")
    return readers.read_raw(spark, root, "orders_raw")


@query
def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "csv")
    star_schema.users_raw(spark, sf_dir).write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False
    ).csv(path)
    return readers.read_csv(spark, path, schemas.USERS_RAW)


def _lake(spark: SparkSession, sf_dir: str) -> str:
    root = fresh_dir(spark, "lake")
    writers.write_partitioned(
        star_schema.lake_orders(spark, sf_dir), f"{root}/orders", ["year", "month"], sort_by=["customer_id"]
    )
    return root


@query
def read_parquet_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _lake(spark, sf_dir)
    found = readers.read_parquet_prefix(spark, root, "orders/", schemas.LAKE_ORDERS)
    missing = readers.read_parquet_prefix(spark, root, "returns/", schemas.LAKE_ORDERS)
    return found.unionByName(missing)


@query
def read_partition_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _lake(spark, sf_dir)
    recent = readers.read_partition_filtered(spark, f"{root}/orders", "year = 1998 and month <= 6", schemas.LAKE_ORDERS)
    return recent.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("orders"), fn.sum_money("amount").alias("amount")
    )


@query
def explode_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = star_schema.rate_documents(spark, sf_dir)
    return readers.explode_rates(docs, ingested_at="2024-02-01T00:00:00+00:00", source="rates")


@query
def time_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day of the metric calendar, and of days with events outside it."""
    days = _warehouse(spark, sf_dir).stg_events.groupBy(F.to_date("event_timestamp").alias("date_day")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return fn.time_spine(spark).join(days, "date_day", "full").select(
        "date_day", F.coalesce("events", F.lit(0)).alias("events")
    )


@query
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per quarter of a continuous range of quarters, and of quarters with orders outside it."""
    quarter = F.to_date(F.date_trunc("quarter", "order_timestamp")).alias("spine_date")
    orders = _warehouse(spark, sf_dir).stg_orders.groupBy(quarter).agg(F.count(F.lit(1)).alias("orders"))
    spine = fn.date_spine(spark, "quarter", "1994-01-01", "2002-12-31")
    return spine.join(orders, "spine_date", "full").select(
        "spine_date", F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query
def fill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _warehouse(spark, sf_dir).mart_growth_metrics
    zeros = [c for c in metrics.columns if c != "event_date"]
    return activity.fill_gaps(metrics, "event_date", "2023-12-01", "2024-02-29", zeros)


# --- Cleaning and functions --------------------------------------------------------------------


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedup_latest(star_schema.orders_raw(spark, sf_dir), ["order_id"], "created_at", ["_loaded_at"])


@query
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = star_schema.events_raw(spark, sf_dir).select("event_id", "user_id", "event_name", "event_timestamp")
    return cleaning.drop_duplicates(same, ["event_id"])


@query
def clean_orders_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The copies of an order differ in time; keep the latest so that "any one row" has one answer.
    latest = cleaning.dedup_latest(star_schema.orders_raw(spark, sf_dir), ["order_id"], "created_at", ["_loaded_at"])
    return cleaning.clean_orders(latest)


@query
def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.rename_column(star_schema.users_raw(spark, sf_dir), "_loaded_at", "user_loaded_at")


@query
def local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = fn.local_date("event_timestamp").alias("local_date")
    return _warehouse(spark, sf_dir).stg_events.groupBy(day).agg(F.count(F.lit(1)).alias("events"))


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _warehouse(spark, sf_dir).stg_users
    return users.select("user_id", fn.surrogate_key("user_id", "country", "acquisition_channel").alias("user_key"))


@query
def safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    fct = _warehouse(spark, sf_dir).net_orders
    return fct.select("order_id", fn.safe_divide("total_refund_amount", "order_amount").alias("refund_rate"))


# --- Joins, revenue ----------------------------------------------------------------------------


@query
def fct_revenue_layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact built from the enriched orders, layer by layer."""
    w = _warehouse(spark, sf_dir)
    return revenue.fct_revenue(w.int_orders_enriched, w.int_order_refunds)


@query
def retention_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _warehouse(spark, sf_dir)
    return revenue.retention_join(w.stg_users, w.net_orders)


@query
def no_over_refund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.no_over_refund(_warehouse(spark, sf_dir).fct_revenue)


@query
def revenue_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.revenue_decomposition(_warehouse(spark, sf_dir).net_orders)


@query
def revenue_decomposition_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average order value as items per order times price per item."""
    lines = star_schema.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("order_id"))
    items = lines.agg(F.sum(F.col("l_quantity").cast("bigint")).alias("items"))
    return revenue.revenue_decomposition(_warehouse(spark, sf_dir).net_orders, items=items)


@query
def user_retention_by_signup_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohorts by the plan users were on when they signed up, whatever they are on now."""
    w = _warehouse(spark, sf_dir)
    versions = history.scd2_history(_plan_changes(spark, sf_dir), "user_id", "updated_at")
    # Signups three years on, so that many users have a plan by then.
    users = w.stg_users.withColumn("signup_timestamp", F.col("signup_timestamp") + F.expr("interval 3 years"))
    return revenue.user_retention(revenue.users_at_signup(users, versions), w.net_orders, by=["plan"])


@query
def segment_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.segment_change(
        _warehouse(spark, sf_dir).fct_revenue,
        "net_revenue",
        "acquisition_channel",
        "order_date",
        ("1997-01-01", "1998-01-01"),
        ("1998-01-01", "1999-01-01"),
    )


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star_schema.orders_raw(spark, sf_dir).select("order_id", "user_id", "created_at", "amount", "currency")
    return cleaning.clean_orders(cleaning.dedup_latest(raw, ["order_id"], "created_at"))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = star_schema.users_raw(spark, sf_dir).select("user_id", "country", "acquisition_channel")
    return cleaning.drop_duplicates(users, ["user_id"])


@query
def plain_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.plain_enrich(_clean(spark, sf_dir), _users(spark, sf_dir))


@query
def broadcast_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.broadcast_enrich(_clean(spark, sf_dir), _users(spark, sf_dir))


@query
def revenue_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_currency(_clean(spark, sf_dir))


@query
def revenue_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_channel(_clean(spark, sf_dir), _users(spark, sf_dir))


@query
def grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.grand_total(_clean(spark, sf_dir))


@query
def skew_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.skew_check(star_schema.order_events(spark, sf_dir), "status")


@query
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.first_rows(star_schema.orders_raw(spark, sf_dir), 5, "order_id", "created_at")


@query
def user_order_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.user_order_windows(_clean(spark, sf_dir))


@query
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _clean(spark, sf_dir).select("currency", "order_id", "created_at", "amount")
    return ordered.moving_average(rows, ["currency"], ["created_at", "order_id"], "amount", n=100)


# --- Activity, funnels, sessions ---------------------------------------------------------------


@query
def rolling_active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.rolling_active_users(_warehouse(spark, sf_dir).stg_events)


@query
def rolling_active_users_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketches stay within 5% of the exact numbers, per day."""
    ev = _warehouse(spark, sf_dir).stg_events
    exact = activity.rolling_active_users(ev)
    near = activity.rolling_active_users(ev, approx=True)
    joined = exact.alias("x").join(near.alias("a"), "event_date", "left")

    def close(c: str):
        return F.coalesce(F.abs(F.col(f"a.{c}") - F.col(f"x.{c}")) <= F.col(f"x.{c}") * 0.05, F.lit(False))

    return joined.select("event_date", *[close(c).alias(f"{c}_close") for c in ("dau", "wau", "mau")])


@query
def growth_accounting_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth accounting with buying as the activity."""
    ev = _warehouse(spark, sf_dir).stg_events
    return activity.growth_accounting(ev.where(F.col("event_name") == "purchase"))


@query
def product_metrics_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product metrics by the business's own days."""
    w = _warehouse(spark, sf_dir)
    words = w.words
    return activity.product_metrics(w.stg_events, words.purchase, words.view, words.cart, tz="Asia/Kolkata")


@query
def growth_accounting_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, retained and resurrected users of each acquisition channel."""
    w = _warehouse(spark, sf_dir)
    # Users' days before the join: a user's many events weigh no more than their days.
    days = activity.user_days(w.stg_events).withColumnRenamed("activity_date", "event_timestamp")
    channels = w.stg_users.select("user_id", "acquisition_channel")
    return activity.growth_accounting(days.join(channels, "user_id", "left"), by=["acquisition_channel"])


@query
def metric_query_filtered_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of both models, each under its own condition."""
    return semantic.metric_query(
        _metric_tables(spark, sf_dir),
        ["daily_active_users", "order_count"],
        grain="year",
        where={"revenue": "currency = 'USD'", "growth_metrics": "dau > 1"},
    )


@query
def churned_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.churned_users(_warehouse(spark, sf_dir).stg_events)


def _channel_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users and local days, as events, with the user's channel."""
    w = _warehouse(spark, sf_dir)
    days = activity.user_days(w.stg_events, tz="Asia/Kolkata").withColumnRenamed("activity_date", "event_timestamp")
    return days.join(w.stg_users.select("user_id", "acquisition_channel"), "user_id", "left")


@query
def rolling_active_users_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.rolling_active_users(_channel_days(spark, sf_dir), by=["acquisition_channel"])


@query
def churned_users_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.churned_users(_channel_days(spark, sf_dir), by=["acquisition_channel"])


@query
def churned_users_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.churned_users(_warehouse(spark, sf_dir).stg_events, tz="Asia/Kolkata")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warehouse(spark, sf_dir).stg_events.withColumn("event_date", F.to_date("event_timestamp"))


@query
def multi_step_funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnels.multi_step_funnel(_dated(spark, sf_dir), STEPS, by=["event_date"])


@query
def sequential_funnel_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnels.sequential_funnel(_dated(spark, sf_dir), STEPS, by=["event_date"])


@query
def step_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _warehouse(spark, sf_dir).stg_events
    return funnels.step_after(ev, funnels.first_step(ev, "view"), "click")


@query
def funnel_step_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates over user-days: the daily funnel added up per step."""
    daily = funnels.sequential_funnel(_dated(spark, sf_dir), STEPS, by=["event_date"])
    return funnels.funnel_step_rates(daily.groupBy("step").agg(F.sum("users").alias("users")), STEPS)


# --- Experiments -------------------------------------------------------------------------------


@query
def ab_sequential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each experiment looked at every day; purchases of high value convert."""
    events = star_schema.table(spark, sf_dir, "events")
    bought = events.where((F.col("event_type") == "purchase") & (F.col("value") > star_schema.CONVERSION_VALUE))
    conversions = bought.select(F.col("user_id").cast("string").alias("user_id"), F.col("ts").alias("converted_at"))
    return experiments.ab_sequential(_warehouse(spark, sf_dir).stg_experiment_assignments, conversions)


def _user_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _warehouse(spark, sf_dir)
    return experiments.ab_user_level(w.stg_experiment_assignments, w.converters, w.stg_user_pre_experiment)


def _rounded(df: DataFrame, *cols: str, digits: int = 12) -> DataFrame:
    """Floating-point moments depend on summation order in their last digits; reports show fewer."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _pivoted(spark: SparkSession, sf_dir: str, pooled: bool = False) -> DataFrame:
    return experiments.pivot_groups(experiments.cuped_adjust(experiments.ab_cells(_user_level(spark, sf_dir), pooled)))


@query
def ab_user_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_level(spark, sf_dir)


@query
def ab_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = experiments.ab_cells(_user_level(spark, sf_dir))
    return _rounded(cells, "mean_y", "mean_x", "cov_yx", "var_x")


@query
def cuped_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = experiments.ab_cells(_user_level(spark, sf_dir))
    return _rounded(experiments.cuped_adjust(cells), "cuped_conversion_rate")


@query
def pivot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_pivoted(spark, sf_dir), "control_cuped_rate", "treatment_cuped_rate")


@query
def ab_test_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _warehouse(spark, sf_dir)
    return experiments.ab_test_pooled(
        w.stg_experiment_assignments, w.converters, w.stg_user_pre_experiment, as_of=AS_OF
    )


@query
def ab_z_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(experiments.ab_z_score(_pivoted(spark, sf_dir, pooled=True)), "z_score", "p_value", digits=6)


@query
def ab_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.ab_power(_pivoted(spark, sf_dir, pooled=True), mde=0.1)


@query
def assignment_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = star_schema.experiment_assignments_raw(spark, sf_dir, contaminated=True)
    return experiments.assignment_contamination(cleaning.stg_experiment_assignments(raw))


# --- Order events ------------------------------------------------------------------------------


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.split_valid_invalid(star_schema.order_events(spark, sf_dir))[0]


@query
def parse_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = order_events.to_keyed_json(star_schema.order_events(spark, sf_dir))
    return order_events.parse_order_events(messages)


@query
def payments_sink_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "payments")
    stream_io.write_topic(order_events.to_keyed_json(star_schema.payment_events(spark, sf_dir)), path)
    return order_events.parse_payment_events(spark.read.schema(schemas.KEYED_MESSAGE).parquet(path))


@query
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir)


@query
def split_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.split_valid_invalid(star_schema.order_events(spark, sf_dir))[1]


@query
def top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.top_cities(_valid(spark, sf_dir))


@query
def top_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.top_sellers(_valid(spark, sf_dir))


@query
def payment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.payment_distribution(_valid(spark, sf_dir))


@query
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.running_totals(_valid(spark, sf_dir))


@query
def running_city_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.running_city_metrics(_valid(spark, sf_dir))


@query
def running_seller_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.running_seller_revenue(_valid(spark, sf_dir))


@query
def rolling_last_n_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.rolling_last_n_avg(_valid(spark, sf_dir))


@query
def rolling_last_n_avg_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.rolling_last_n_avg(_valid(spark, sf_dir), key="city")


@query
def gold_city_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.gold_city_revenue(star_schema.lake_orders(spark, sf_dir))


# --- Sinks and incremental jobs ----------------------------------------------------------------


@query
def write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.write_table(_warehouse(spark, sf_dir).mart_user_ltv, fresh_dir(spark, "table"))


@query
def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "partitioned")
    enriched = reports.plain_enrich(_clean(spark, sf_dir), _users(spark, sf_dir))
    writers.write_partitioned(enriched, path, ["currency"], sort_by=["user_id"])
    return spark.read.schema(enriched.schema).parquet(path)


@query
def write_snappy_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "snappy")
    writers.write_snappy_parquet(star_schema.payment_events(spark, sf_dir), path)
    return spark.read.schema(schemas.PAYMENT_EVENT).parquet(path)


@query
def append_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the rate documents into one table."""
    path = fresh_dir(spark, "rates")
    docs = star_schema.rate_documents(spark, sf_dir)
    for stamp in ("2024-02-01T00:00:00+00:00", "2024-02-02T00:00:00+00:00"):
        writers.append_rates(readers.explode_rates(docs, ingested_at=stamp, source="rates"), path)
    return spark.read.schema(schemas.EXCHANGE_RATES_RAW).parquet(path)


@query
def write_read_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = reports.broadcast_enrich(_clean(spark, sf_dir), _users(spark, sf_dir))
    return writers.write_read_verify(enriched, fresh_dir(spark, "verify"), ["currency"])


@query
def select_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month in the files that are still to do, when the years before 1998 are done."""
    root = _lake(spark, sf_dir)
    files = readers.list_files(spark, f"{root}/orders")
    done = files.where(F.regexp_extract("relative_path", r"year=(\d+)", 1).cast("int") < 1998)
    todo = writers.select_unprocessed(files, done)
    rows = writers.read_selected(spark, f"{root}/orders", todo)
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))


def _loads(spark: SparkSession, sf_dir: str, through: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw orders, users and refunds as loaded up to a day: 2024-02-01 or 2024-02-02.

    On the second day come new orders, corrections that move an order to the next day, refunds of any age, and
    users whose orders are there already.
    """
    orders, users, refunds = (t(spark, sf_dir) for t in (star_schema.orders_raw, star_schema.users_raw, star_schema.refunds_raw))
    order, user = F.col("order_id").cast("bigint"), F.col("user_id").cast("bigint")
    corrected = (F.col("_loaded_at") == F.lit(star_schema.LOAD_DATE)) & (order % 10 == 0)
    late = [(orders, corrected | (order % 9 == 4)), (users, user % 6 == 1), (refunds, order % 7 == 0)]
    days = [F.when(second, "2024-02-02").otherwise("2024-02-01").cast("date") for _, second in late]
    known = [t.withColumn("_loaded_at", day) for (t, _), day in zip(late, days)]
    return tuple(t.where(F.col("_loaded_at") <= F.lit(through).cast("date")) for t in known)


@query
def incremental_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact after a second day of loads; equals the full rebuild."""
    path = fresh_dir(spark, "fact")
    for day in ("2024-02-01", "2024-02-02"):
        incremental.refresh_revenue(spark, path, *_loads(spark, sf_dir, day), grain="month")
    return incremental.read_fact(spark, path, grain="month")


# --- Quality, monitoring -----------------------------------------------------------------------


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = star_schema.users_raw(spark, sf_dir)
    return quality.check_not_null(users, users.columns, "users_raw")


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(star_schema.events_raw(spark, sf_dir), "event_id", "events_raw")


@query
def check_unique_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule over several columns: a user is assigned to an experiment once."""
    assigned = star_schema.experiment_assignments_raw(spark, sf_dir)
    return quality.check_unique(assigned, "user_id, experiment_id", "experiment_assignments_raw")


@query
def check_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_between(star_schema.orders_raw(spark, sf_dir), "amount", 0, 250000, "orders_raw")


@query
def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_schema.orders_raw(spark, sf_dir)
    return quality.check_accepted_values(orders, "currency", ["USD", "INR"], "orders_raw")


@query
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_row_count(star_schema.orders_raw(spark, sf_dir), 1, 1000, "orders_raw")


@query
def check_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact against its contract with one more column, another type and a stricter constraint."""
    fct = _warehouse(spark, sf_dir).fct_revenue
    changed = fct.withColumn("order_amount", F.col("order_amount").cast("double")).withColumn("note", F.lit("x"))
    declared = T.StructType([*FCT_REVENUE_CONTRACT.fields, T.StructField("status", T.StringType())])
    return quality.check_contract(changed, declared, [*CONTRACT_NOT_NULL, "country"], "fct_revenue")


@query
def store_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored orders after a version without amounts was refused."""
    path, orders = fresh_dir(spark, "orders"), _warehouse(spark, sf_dir).stg_orders
    rules = RULES["stg_orders"]
    contracts.store_checked(orders, path, "stg_orders", STG_ORDERS_CONTRACT, CONTRACT_NOT_NULL, rules)
    broken = orders.withColumn("order_amount", F.lit(None).cast("decimal(38,9)"))
    try:
        contracts.store_checked(broken, path, "stg_orders", STG_ORDERS_CONTRACT, CONTRACT_NOT_NULL, rules)
    except contracts.ContractBroken:
        pass  # as it has to be; the version before stays
    return writers.read_table(spark, path, orders.schema)


@query
def run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks on the stored warehouse."""
    # The checks read whole tables, so folders by date would only cost time.
    stored = _warehouse(spark, sf_dir).save(fresh_dir(spark, "warehouse"), MODELS, layout={})
    return quality.run_checks(stored, RULES)


@query
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "users_raw": star_schema.users_raw(spark, sf_dir),
        "orders_raw": star_schema.orders_raw(spark, sf_dir),
        "refunds_raw": star_schema.refunds_raw(spark, sf_dir),
        "events_raw": star_schema.events_raw(spark, sf_dir),
    }
    critical = {"orders_raw": (4, 8), "events_raw": (4, 30)}
    return quality.source_freshness(tables, as_of=AS_OF, limits=critical)


@query
def row_count_minimums(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _warehouse(spark, sf_dir)
    tables = {
        "fct_revenue": w.net_orders,
        "mart_growth_metrics": w.mart_growth_metrics,
        "mart_user_ltv": w.mart_user_ltv,
        "mart_ab_test_results": w.mart_ab_test_results,
        "mart_pipeline_monitoring": w.monitored(),
    }
    minimums = {
        "fct_revenue": 1,
        "mart_growth_metrics": 365,
        "mart_user_ltv": 1,
        "mart_ab_test_results": 1,
        "mart_pipeline_monitoring": 1,
    }
    return quality.row_count_minimums(tables, minimums)


@query
def pipeline_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("stg_orders", "stg_users", "fct_revenue", "mart_growth_metrics", "mart_user_retention", "mart_ab_test_results")
    w = _warehouse(spark, sf_dir)
    return w.monitored(w.save(fresh_dir(spark, "monitored"), names, layout={}))


# --- History -----------------------------------------------------------------------------------


def _plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a change of its user's plan."""
    orders = star_schema.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderpriority").alias("plan"),
        F.col("o_orderdate").alias("updated_at"),
    )


@query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_history(_plan_changes(spark, sf_dir), "user_id", "updated_at")


@query
def scd2_history_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_history(_plan_changes(spark, sf_dir), "user_id", "updated_at", tracked=["plan"])


@query
def asof_user_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan each buyer was on when the refund was made."""
    versions = history.scd2_history(_plan_changes(spark, sf_dir), "user_id", "updated_at")
    buyers = star_schema.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("user_id")
    )
    refunds = _warehouse(spark, sf_dir).stg_refunds.join(buyers, "order_id")
    facts = refunds.select("refund_id", "user_id", "refund_timestamp")
    return history.asof_user_attributes(facts, versions, "user_id", "refund_timestamp")


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Users, and users after some moved country: some with a new timestamp, some without."""
    users = _warehouse(spark, sf_dir).stg_users
    key = F.col("user_id").cast("bigint")
    moved = F.when(key % 7 == 0, F.lit("elsewhere")).otherwise(F.col("country"))
    later = F.when(key % 5 == 0, F.col("signup_timestamp") + F.expr("interval 1 day")).otherwise(
        F.col("signup_timestamp")
    )
    return users, users.withColumn("country", moved).withColumn("signup_timestamp", later)


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _two_batches(spark, sf_dir)
    current = history.open_history(before, "user_id", "signup_timestamp")
    return history.scd2_apply(current, after, "user_id", "signup_timestamp")


@query
def scd2_apply_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _two_batches(spark, sf_dir)
    current = history.open_history(before, "user_id", "signup_timestamp")
    return history.scd2_apply(
        current, after, "user_id", "signup_timestamp", tracked=["country", "acquisition_channel"], as_of=AS_OF
    )


@query
def scd2_apply_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history after two batches, the second by columns."""
    before, after = _two_batches(spark, sf_dir)
    kept = StoredHistory(spark, fresh_dir(spark, "history"), before.schema, "user_id", "signup_timestamp", buckets=8)
    kept.apply(before)
    kept.apply(after, tracked=["country", "acquisition_channel"], as_of=AS_OF)
    return kept.read()


# --- Metrics and dashboards --------------------------------------------------------------------


def _metric_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    w = _warehouse(spark, sf_dir)
    return {"revenue": w.fct_revenue, "growth_metrics": w.mart_growth_metrics}


@query
def metric_query_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["daily_active_users", "weekly_active_users", "monthly_active_users", "dau_mau_stickiness"]
    return semantic.metric_query(_metric_tables(spark, sf_dir), names, grain="week")


@query
def metric_query_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["total_revenue", "total_net_revenue", "order_count", "average_order_value"]
    return semantic.metric_query(
        _metric_tables(spark, sf_dir), names, group_by=["acquisition_channel", "currency"], grain="quarter"
    )


@query
def metric_query_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["total_revenue", "order_count"]
    return semantic.metric_query(
        _metric_tables(spark, sf_dir), names, group_by=["acquisition_channel"], where="currency = 'USD'"
    )


@query
def metric_query_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of both models by year."""
    names = ["daily_active_users", "total_revenue", "order_count"]
    return semantic.metric_query(_metric_tables(spark, sf_dir), names, grain="year")


@query
def product_dashboard_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _warehouse(spark, sf_dir)
    return dashboards.product_dashboard_feed(w.mart_product_metrics, w.mart_growth_metrics)


@query
def revenue_dashboard_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _warehouse(spark, sf_dir)
    return dashboards.revenue_dashboard_feed(w.net_orders, w.mart_monthly_revenue)


@query
def retention_dashboard_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.retention_dashboard_feed(_warehouse(spark, sf_dir).mart_user_retention)


# --- Streams -----------------------------------------------------------------------------------


def _topic(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Order events as a stream of keyed messages, a share of its files for every core per batch."""
    path = f"{root}/topic"
    stream_io.write_topic(order_events.to_keyed_json(star_schema.order_events(spark, sf_dir)), path)
    return stream_io.stream_source(spark, path=path, options={"maxBytesPerTrigger": str(stream_io.batch_bytes(spark))})


def _valid_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Valid order events of a fresh topic, and the folder of this run."""
    root = fresh_dir(spark, "stream")
    events = order_events.parse_order_events(_topic(spark, sf_dir, root))
    return order_events.split_valid_invalid(events)[0], root


def _activity_stream(spark: SparkSession, sf_dir: str, root: str, repeated: bool = True) -> DataFrame:
    """The events table as a stream of several files out of order, repeated deliveries in other files than the first."""
    events = star_schema.table(spark, sf_dir, "events")
    often = F.lit(repeated) & (F.col("event_id") % 20 == 0)
    again = F.when(often, F.array(F.lit(0), F.lit(3))).otherwise(F.array(F.lit(0)))
    sent = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_timestamp"),
        F.explode(again).alias("copy"),
    )
    part = F.pmod(F.xxhash64("event_id") + F.col("copy"), F.lit(6)).cast("int")
    # A file per part, however Spark arranges the shuffle; the hash knows nothing of time.
    sent.withColumn("part", part).drop("copy").repartitionByRange(6, "part").write.partitionBy("part").parquet(f"{root}/events")
    schema = "event_id string, user_id string, event_name string, event_timestamp timestamp_ntz"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "2").parquet(f"{root}/events").drop("part")


@query
def stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "stream")
    messages = stream_io.run_append(_topic(spark, sf_dir, root), root)
    return messages.select(
        F.col("key").cast("string").alias("message_key"),
        F.get_json_object(F.col("value").cast("string"), "$.customer_id").alias("customer_id"),
    )


@query
def stream_sink_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published as messages by a stream, read back and parsed."""
    root = fresh_dir(spark, "stream")
    orders = stream_io.table_stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
    )
    messages = order_events.to_keyed_json(orders)
    stream_io.publish(messages, f"{root}/checkpoint", "parquet", {"path": f"{root}/topic"}).awaitTermination()
    stored = spark.read.schema(schemas.KEYED_MESSAGE).parquet(f"{root}/topic")
    return order_events.parse_order_events(stored).select("order_id", "customer_id", "amount")


@query
def stream_parse_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "stream")
    return stream_io.run_append(order_events.parse_order_events(_topic(spark, sf_dir, root)), root)


def _mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events as messages; some are cut short, some have an amount that is no number."""
    messages = order_events.to_keyed_json(star_schema.order_events(spark, sf_dir))
    text, number = F.col("value").cast("string"), F.col("key").cast("string").cast("bigint")
    worded = F.regexp_replace(text, '"amount":[^,}]*', '"amount":"free"')
    sent = F.when(number % 73 == 0, F.substring(text, 1, 20)).when(number % 79 == 0, worded).otherwise(text)
    return messages.withColumn("value", sent.cast("binary"))


@query
def split_messages_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why messages were refused; their key and value are kept as they came."""
    refused = order_events.split_messages(_mixed_messages(spark, sf_dir))[1]
    cut = (F.length("value") <= 20).alias("cut")
    return refused.select(F.col("key").cast("string").alias("order_id"), "reject_reason", cut)


@query
def stream_split_messages_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "stream")
    stream_io.write_topic(_mixed_messages(spark, sf_dir), f"{root}/topic")
    refused = stream_ops.run_split_messages(stream_io.stream_source(spark, path=f"{root}/topic"), root)[1]
    return refused.select(F.col("key").cast("string").alias("order_id"), "reject_reason")


@query
def stream_split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "stream")
    return stream_ops.run_split(order_events.parse_order_events(_topic(spark, sf_dir, root)), root)[0]


@query
def stream_split_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "stream")
    return stream_ops.run_split(order_events.parse_order_events(_topic(spark, sf_dir, root)), root)[1]


@query
def stream_city_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    return stream_io.run_update(order_events.running_city_metrics(valid), root, ["city"], buckets=1)


@query
def stream_seller_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    return stream_io.run_update(order_events.running_seller_revenue(valid), root, ["seller_id"])


@query
def stream_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    cities = stream_io.run_update(order_events.running_city_metrics(valid), root, ["city"], buckets=1)
    return cities.orderBy(F.desc("revenue"), F.desc("city")).limit(5)


@query
def stream_payment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    return order_events.with_percentage(stream_io.run_complete(order_events.payment_counts(valid), root))


@query
def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    return stream_io.run_complete(order_events.running_totals(valid), root)


@query
def stream_rolling_last_n_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    return stream_ops.run_last_n(valid, root)


@query
def stream_rolling_last_n_avg_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, root = _valid_stream(spark, sf_dir)
    return stream_ops.run_last_n(valid, root, key="city")


@query
def commit_after_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous run whose first batch fails after its output is stored; the next run repeats that batch."""
    root = fresh_dir(spark, "stream")
    path, out = f"{root}/topic", f"{root}/out"
    stream_io.write_topic(order_events.to_keyed_json(star_schema.order_events(spark, sf_dir)), path)
    write = stream_io.append_batches(out)

    def fails(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        raise RuntimeError("lost after the output was stored")

    messages, log = stream_io.stream_source(spark, path=path), stream_io.commit_log(out)
    broken = stream_io.commit_after_success(messages, fails, f"{root}/checkpoint", log=log)
    try:
        broken.awaitTermination()
    except StreamingQueryException:
        pass  # the failure above; the rows are there, but no reader sees them
    running = stream_io.commit_after_success(messages, write, f"{root}/checkpoint", log=log)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return order_events.parse_order_events(stream_io.read_committed(spark, out, schemas.KEYED_MESSAGE))


@query
def bounded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments per status after a run that ends by itself, one file per batch."""
    root = fresh_dir(spark, "stream")
    stream_io.write_topic(order_events.to_keyed_json(star_schema.payment_events(spark, sf_dir)), f"{root}/topic")
    messages = stream_io.stream_source(spark, path=f"{root}/topic", options={"maxFilesPerTrigger": "4"})
    statuses = order_events.parse_payment_events(messages).groupBy("status").agg(F.count(F.lit(1)).alias("payments"))
    return stream_io.run_complete(statuses, root)


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries, when copies come in later files than the first and events in any order."""
    root = fresh_dir(spark, "stream")
    return stream_ops.run_dedup(_activity_stream(spark, sf_dir, root), root, folders=8, blocks=8)


@query
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of events that come file by file in no order of time."""
    root = fresh_dir(spark, "stream")
    return stream_ops.run_sessions(_activity_stream(spark, sf_dir, root, repeated=False), root, grain="month")


@query
def stream_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts from the stream; the approximate user count is compared with the exact one."""
    events = stream_io.table_stream(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_timestamp"),
    )
    daily = stream_io.run_complete(stream_ops.stream_daily_metrics(events), fresh_dir(spark, "stream"))
    exact = _warehouse(spark, sf_dir).mart_product_metrics.select("event_date", "daily_active_users")
    close = F.abs(F.col("active_users") - F.col("daily_active_users")) <= F.greatest(
        F.lit(2.0), F.col("daily_active_users") * 0.06
    )
    # A day that only one of the two has shows as NULLs and as not close.
    return daily.join(exact, "event_date", "full_outer").select(
        "event_date", "total_events", "purchases", "daily_active_users", F.coalesce(close, F.lit(False)).alias("active_users_close")
    )


# The contract of the staged orders holds, so this query returns no rows.
@query
def check_contract_stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_contract(
        _warehouse(spark, sf_dir).stg_orders, STG_ORDERS_CONTRACT, CONTRACT_NOT_NULL, "stg_orders"
    )


@query
def user_sessions_by_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with a pause of two hours."""
    return sessions.user_sessions(_warehouse(spark, sf_dir).stg_events, gap_minutes=120)
