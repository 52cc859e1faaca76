"""The declared column checks of the warehouse and the two contracts."""

from __future__ import annotations

from tidemark.operators.quality import Between, NotNull, Unique
from tidemark.sources.schemas import flat_schema

# 56 not-null, 15 unique and 9 range checks, by table and column.
RULES = {
    "stg_orders": (
        NotNull("order_id"),
        Unique("order_id"),
        NotNull("user_id"),
        NotNull("order_amount"),
        Between("order_amount", 0, 1000000),
    ),
    "stg_users": (NotNull("user_id"), Unique("user_id"), NotNull("signup_timestamp")),
    "stg_refunds": (NotNull("refund_id"), Unique("refund_id"), NotNull("order_id")),
    "stg_events": (NotNull("user_id"), NotNull("event_name"), NotNull("event_timestamp")),
    "stg_user_pre_experiment": (
        NotNull("user_id"),
        Unique("user_id"),
        NotNull("pre_experiment_purchases"),
        Between("pre_experiment_purchases", 0, 1000000),
        NotNull("pre_experiment_events"),
        NotNull("observation_period_days"),
        Between("observation_period_days", 1, 3650),
        Between("pre_experiment_conversion_rate", 0, 10),
    ),
    "int_orders_enriched": (NotNull("order_id"), Unique("order_id"), NotNull("user_id")),
    "int_order_refunds": (NotNull("order_id"), Unique("order_id")),
    "mart_monthly_revenue": (NotNull("revenue_month"), Unique("revenue_month"), NotNull("total_revenue")),
    "mart_user_retention": (NotNull("cohort_month"), NotNull("order_month"), NotNull("active_users")),
    "mart_user_ltv": (NotNull("user_id"), Unique("user_id"), NotNull("lifetime_revenue")),
    "mart_funnel_conversion": (NotNull("user_id"), Unique("user_id")),
    "mart_product_metrics": (
        NotNull("event_date"),
        Unique("event_date"),
        NotNull("daily_active_users"),
        NotNull("total_events"),
        NotNull("purchases"),
        Between("purchase_conversion_rate", 0, 1),
    ),
    "mart_multi_step_funnel": (NotNull("step"), Unique("step"), NotNull("users")),
    "mart_growth_metrics": (
        NotNull("event_date"),
        Unique("event_date"),
        NotNull("dau"),
        NotNull("wau"),
        NotNull("mau"),
    ),
    "mart_user_sessions": (
        NotNull("user_id"),
        NotNull("session_id"),
        NotNull("session_start"),
        NotNull("session_end"),
        NotNull("events_in_session"),
    ),
    "mart_feature_adoption": (
        NotNull("feature"),
        Unique("feature"),
        NotNull("users_using_feature"),
        NotNull("total_users"),
        NotNull("adoption_rate"),
        Between("adoption_rate", 0, 1),
    ),
    "mart_sequential_funnel": (NotNull("step"), Unique("step"), NotNull("users")),
    "fct_revenue": (NotNull("net_revenue"), Between("net_revenue", -10000, 1000000)),
    "mart_ab_test_results": (
        NotNull("experiment_id"),
        Unique("experiment_id"),
        NotNull("experiment_name"),
        NotNull("control_users"),
        NotNull("treatment_users"),
        NotNull("control_conversion_rate"),
        Between("control_conversion_rate", 0, 1),
        NotNull("treatment_conversion_rate"),
        Between("treatment_conversion_rate", 0, 1),
        NotNull("sample_ratio_mismatch"),
        NotNull("is_significant"),
        NotNull("has_minimum_duration"),
    ),
}

# Declared columns of the two tables under contract.
STG_ORDERS_CONTRACT = flat_schema(
    "order_id string, user_id string, order_timestamp timestamp_ntz, order_amount decimal(38,9), currency string, "
    "created_at timestamp_ntz"
)
FCT_REVENUE_CONTRACT = flat_schema(
    "order_id string, user_id string, order_timestamp timestamp_ntz, order_date date, order_amount decimal(38,9), "
    "currency string, country string, acquisition_channel string, total_refund_amount decimal(38,9), "
    "net_revenue decimal(38,9)"
)
CONTRACT_NOT_NULL = ("order_id", "user_id")
