"""Order and payment events: message form, validation, running metrics.

All functions here take a batch or a streaming DataFrame, except those that sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import mean_of, money, order_measures, share_pct, sum_money
from tidemark.sources.schemas import ORDER_EVENT, PAYMENT_EVENT

# Fields without which an order event is refused, in the order in which they are looked at.
REQUIRED_FIELDS = ("order_id", "customer_id", "amount", "city")


def to_keyed_json(df: DataFrame, key_col: str = "order_id") -> DataFrame:
    """Rows as messages: the key decides the partition, the value is the row as JSON."""
    return df.select(
        F.col(key_col).cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
    )


def _fields(text: Column, schema: T.StructType) -> Column:
    """The fields of a JSON text as columns, read once however many of them later filters look at.

    Spark pushes a filter on a selected field below the selection and reads the text again for each field in it;
    it does not push filters below a generator.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def _parse(messages: DataFrame, schema: T.StructType) -> DataFrame:
    return messages.select(_fields(F.col("value").cast("string"), schema))


def parse_order_events(messages: DataFrame) -> DataFrame:
    return _parse(messages, ORDER_EVENT)


def parse_payment_events(messages: DataFrame) -> DataFrame:
    return _parse(messages, PAYMENT_EVENT)


def with_reject_reason(events: DataFrame) -> DataFrame:
    """Add `reject_reason`: NULL for a valid event, else the first rule it breaks."""
    reason = F.lit(None).cast("string")
    rules = [(F.col(f).isNull(), f"missing {f}") for f in REQUIRED_FIELDS]
    rules += [
        (F.col("amount") <= 0, "bad amount"),
        (F.col("payment_method").isNull(), "missing payment_method"),
        (F.col("seller_id").isNull(), "missing seller_id"),
    ]
    for broken, label in reversed(rules):
        reason = F.when(broken, F.lit(label)).otherwise(reason)
    return events.withColumn("reject_reason", reason)


def parse_with_message(messages: DataFrame) -> DataFrame:
    """Order events as parsed, next to the `key` and `value` they came with and their `reject_reason`.

    Text that is no JSON object is "malformed json"; an amount that is there but no number is a "bad amount".
    """
    text = F.col("value").cast("string")
    parsed = messages.select("key", "value", _fields(text, ORDER_EVENT))
    is_object = F.coalesce(F.json_object_keys(text).isNotNull(), F.lit(False))
    unread = F.col("amount").isNull() & F.get_json_object(text, "$.amount").isNotNull() & (F.col("reject_reason") == "missing amount")
    marked = with_reject_reason(parsed)
    return marked.withColumn(
        "reject_reason",
        F.when(~is_object, "malformed json").when(unread, "bad amount").otherwise(F.col("reject_reason")),
    )


def split_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events, and refused messages as they came (`key`, `value`) with the reason, to be mended and sent again."""
    marked = parse_with_message(messages)
    valid = marked.where(F.col("reject_reason").isNull()).drop("key", "value", "reject_reason")
    return valid, marked.where(F.col("reject_reason").isNotNull()).select("key", "value", "reject_reason")


def split_valid_invalid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events, and refused ones with the reason. Every event is in exactly one of the two."""
    marked = with_reject_reason(events)
    valid = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, marked.where(F.col("reject_reason").isNotNull())


def running_city_metrics(events: DataFrame) -> DataFrame:
    return events.groupBy("city").agg(*order_measures("revenue", "orders"))


def running_seller_revenue(events: DataFrame) -> DataFrame:
    return events.groupBy("seller_id").agg(sum_money("amount").alias("revenue"))


def running_totals(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("total_orders"), sum_money("amount").alias("total_revenue"))


def payment_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("payment_method").alias("method")).agg(F.count(F.lit(1)).alias("count"))


def with_percentage(counts: DataFrame) -> DataFrame:
    """Add each count's share of the total; one row per method."""
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("method", "count", share_pct("count", total).alias("percentage")).orderBy(
        F.desc("count"), "method"
    )


def payment_distribution(events: DataFrame) -> DataFrame:
    """Orders and share per payment method, most used first."""
    return with_percentage(payment_counts(events))


def top_cities(events: DataFrame, k: int = 5) -> DataFrame:
    """The k cities with most revenue; equal revenue is ordered by city, descending."""
    return running_city_metrics(events).orderBy(F.desc("revenue"), F.desc("city")).limit(k)


def top_sellers(events: DataFrame, k: int = 5) -> DataFrame:
    return running_seller_revenue(events).orderBy(F.desc("revenue"), F.desc("seller_id")).limit(k)


def last_n(events: DataFrame, n: int = 100, key: str | None = None) -> DataFrame:
    """The latest n events, overall or per key. Each map task keeps n rows (per key) before the shuffle."""
    order = [F.desc("timestamp"), F.desc("order_id")]
    if key is None:
        return events.orderBy(*order).limit(n)
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return events.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def mean_of_last(latest: DataFrame, key: str | None = None) -> DataFrame:
    mean = F.coalesce(F.try_divide(F.sum(money("amount")).cast("double"), F.count("amount").cast("double")), F.lit(0.0))
    grouped = latest.groupBy(key) if key else latest.groupBy()
    return grouped.agg(mean.alias("rolling_avg"))


def rolling_last_n_avg(events: DataFrame, n: int = 100, key: str | None = None) -> DataFrame:
    """Mean amount of the latest n events; 0 when there are none."""
    columns = ["timestamp", "order_id", "amount", *([key] if key else [])]
    return mean_of_last(last_n(events.select(*dict.fromkeys(columns)), n, key), key)


def gold_city_revenue(orders: DataFrame) -> DataFrame:
    """Sum, count and mean of amounts per city, to 2 digits, largest sum first."""
    known = orders.where(F.col("city").isNotNull())
    return (
        known.groupBy("city")
        .agg(
            F.round(F.sum(money("amount")), 2).cast("double").alias("sum"),
            F.count("amount").alias("count"),
            F.round(mean_of("amount"), 2).alias("mean"),
        )
        .orderBy(F.desc("sum"), "city")
    )
