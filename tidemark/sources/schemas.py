"""Declared schemas of everything that is read. Nothing is inferred from file contents."""

from __future__ import annotations

from pyspark.sql import types as T


def flat_schema(spec: str) -> T.StructType:
    """A schema of nullable columns from "name type, name type"; needs no running session."""
    schema = T.StructType()
    for column in spec.split(", "):
        schema = schema.add(*column.split(" "))
    return schema


USERS_RAW = flat_schema(
    "user_id string, signup_timestamp timestamp_ntz, country string, acquisition_channel string, _loaded_at date"
)
ORDERS_RAW = flat_schema(
    "order_id string, user_id string, created_at timestamp_ntz, amount decimal(38,9), currency string, "
    "updated_at timestamp_ntz, _loaded_at date"
)
REFUNDS_RAW = flat_schema(
    "refund_id string, order_id string, refund_amount decimal(38,9), reason string, "
    "refund_timestamp timestamp_ntz, _loaded_at date"
)
EVENTS_RAW = flat_schema(
    "event_id string, user_id string, event_name string, event_timestamp timestamp_ntz, _loaded_at date"
)
EXPERIMENT_ASSIGNMENTS_RAW = flat_schema(
    "assignment_id string, experiment_id string, experiment_name string, user_id string, "
    "experiment_group string, assigned_at timestamp_ntz, experiment_start_date date"
)
USER_PRE_EXPERIMENT_RAW = flat_schema(
    "user_id string, pre_experiment_purchases long, pre_experiment_events long, observation_period_days long"
)
EXCHANGE_RATES_RAW = flat_schema(
    "base_currency string, target_currency string, exchange_rate double, rate_date string, "
    "_ingested_at string, _source string"
)
ORDER_EVENT = flat_schema(
    "order_id string, customer_id string, seller_id string, product_id string, amount double, currency string, "
    "city string, state string, payment_method string, status string, timestamp string, event_type string"
)
PAYMENT_EVENT = flat_schema(
    "payment_id string, order_id string, amount double, method string, status string, gateway string, "
    "timestamp string, event_type string"
)
LAKE_ORDERS = flat_schema(
    "order_id string, customer_id string, seller_id string, amount double, city string, status string, "
    "year integer, month integer, day integer"
)
KEYED_MESSAGE = flat_schema("key binary, value binary")

RAW = {
    "users_raw": USERS_RAW,
    "orders_raw": ORDERS_RAW,
    "refunds_raw": REFUNDS_RAW,
    "events_raw": EVENTS_RAW,
    "experiment_assignments_raw": EXPERIMENT_ASSIGNMENTS_RAW,
    "user_pre_experiment_raw": USER_PRE_EXPERIMENT_RAW,
    "exchange_rates_raw": EXCHANGE_RATES_RAW,
}
