"""Incremental refresh of the order fact by load time, stored in folders by order date (or month)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import stg_orders, stg_refunds, stg_users
from tidemark.operators.revenue import FACT_COLUMNS, fct_revenue_from_staging, net_revenue, order_refunds
from tidemark.plans.quality_rules import FCT_REVENUE_CONTRACT
from tidemark.sinks.folders import FolderTable

# Days suit large tables; months where a day would be too little for a file of its own.
FOLDER = {"day": "order_date", "month": "order_month"}
LOADED = "_loaded_at"


def _derived() -> dict[str, Column]:
    """What the stored fact has and its other columns tell; no shuffle has to carry it."""
    return {"net_revenue": net_revenue(F.col("order_amount"), F.col("total_refund_amount"))}


def _period(day: Column, grain: str) -> Column:
    return day if grain == "day" else F.trunc(day, grain)


def fact_table(spark: SparkSession, path: str, grain: str = "day") -> FolderTable:
    fields = list(FCT_REVENUE_CONTRACT.fields)
    if grain != "day":
        fields.append(T.StructField(FOLDER[grain], T.DateType()))
    return FolderTable(spark, path, FOLDER[grain], T.StructType(fields))


def read_fact(spark: SparkSession, path: str, grain: str = "day") -> DataFrame:
    """The fact as last published. Filters on the order date (or month) open only the folders they need."""
    return fact_table(spark, path, grain).read().select(*FACT_COLUMNS)


def _with_folder(fct: DataFrame, grain: str) -> DataFrame:
    return fct.withColumn(FOLDER[grain], _period(F.col("order_date"), grain))


def _only(rows: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (or is not) among `ids`, a NULL key being a key like others."""
    other = ids.select(F.col(key).alias("__key"))
    return rows.join(other, rows[key].eqNullSafe(other["__key"]), how)


def _ids(key: str, *tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [t.select(key) for t in tables]).distinct()


def changed_orders(orders: DataFrame, users: DataFrame, refunds: DataFrame, since: dt.date | str) -> DataFrame:
    """Ids of the orders whose row of the fact may differ from before the loads of `since` and later.

    These were loaded themselves, or have a refund or a user that was. A refund that moved to another order
    changes both, so every version of a loaded refund counts. The filters on the load date reach the scans.
    """

    def loaded(table: DataFrame) -> DataFrame:
        return table.where(F.col(LOADED) >= F.lit(since).cast("date"))

    moved = _only(refunds.select("refund_id", "order_id"), _ids("refund_id", loaded(refunds)), "refund_id")
    of_users = _only(orders.select("order_id", "user_id"), _ids("user_id", loaded(users)), "user_id")
    return _ids("order_id", loaded(orders), moved, of_users)


def fact_of(orders: DataFrame, users: DataFrame, refunds: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the fact for some orders, from all raw versions of those orders, their refunds and users."""
    own = _only(orders, ids, "order_id")
    staged = stg_orders(own)
    # A version of a refund that names another order may be its last one.
    versions = _only(refunds, _ids("refund_id", _only(refunds, ids, "order_id")), "refund_id")
    of_orders = _only(stg_refunds(versions), ids, "order_id")
    buyers = stg_users(_only(users, _ids("user_id", own), "user_id"))
    return fct_revenue_from_staging(staged, buyers, order_refunds(of_orders))


def refresh_revenue(
    spark: SparkSession,
    path: str,
    orders: DataFrame,
    users: DataFrame,
    refunds: DataFrame,
    grain: str = "day",
) -> int:
    """Bring the stored fact up to the raw tables and return the number of periods that were rewritten.

    The raw tables only ever grow: a correction is a further row with a later load date. The first run builds the
    whole fact. A later one reads the rows loaded since (the last day again, since more may have come that day),
    builds the rows of the orders they touch, and rewrites the folders that hold or held such orders, with the other
    rows of those folders as they were stored. The result equals a full rebuild. Nothing of it is seen before all
    folders are written; a failed run leaves the fact as it was.
    """
    table = fact_table(spark, path, grain)
    before = table.manifest()
    newest = [t.agg(F.max(LOADED)).first()[0] for t in (orders, users, refunds)]
    through = str(max((d for d in newest if d is not None), default="")) or before.note
    if before.version == 0:
        staged = fct_revenue_from_staging(stg_orders(orders), stg_users(users), order_refunds(stg_refunds(refunds)))
        batch, written = table.store(_with_folder(staged, grain), ["user_id"], _derived())
        table.publish(before, {f: (batch,) for f in written}, through)
        return len(written)
    # Stored: every later step starts from the few ids, and all steps see the same ones.
    touched = f"{table.root}/touched/turn={before.version % 2}"
    ids = changed_orders(orders, users, refunds, before.note or "0001-01-01")
    ids.write.mode("overwrite").parquet(touched)
    ids = spark.read.schema(ids.schema).parquet(touched)
    # Where the orders were and are: one period per version of an order.
    dates = _only(orders.select("order_id", "created_at"), ids, "order_id")
    period = _period(F.to_date(F.col("created_at").cast("timestamp_ntz")), grain).cast("string")
    periods = [r[0] for r in dates.select(period.alias("p")).distinct().collect()]
    if not periods:
        return 0
    kept = _only(table.read(before, periods), ids, "order_id", "left_anti")
    rows = kept.unionByName(_with_folder(fact_of(orders, users, refunds, ids), grain))
    table.replace(before, rows, periods, through, ["user_id"], _derived())
    return len(periods)
