"""Small hand-made inputs with deliberate dirt, and helpers to build event rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidemark.plans.warehouse import RawTables, Warehouse
from tidemark.sources import schemas

D = dt.date(2024, 4, 1)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


USERS = [
    ("1", ts("2024-01-01 10:00"), "India", "Facebook", D),
    ("2", ts("2024-01-02 11:00"), "india", "facebook", D),
    ("3", ts("2024-01-03 12:00"), None, "Google", D),
    ("1", ts("2024-01-01 10:00"), "India", "Facebook", D),
]
ORDERS = [
    ("101", "1", ts("2024-01-05 14:00"), Decimal("1000.00"), "USD", ts("2024-01-05 14:01"), D),
    ("102", "2", ts("2024-01-06 15:00"), Decimal("2000.50"), "usd", ts("2024-01-06 15:01"), D),
    ("103", "3", ts("2024-01-07 16:00"), None, "INR", ts("2024-01-07 16:01"), D),
    ("101", "1", ts("2024-01-05 14:00"), Decimal("1000.00"), "USD", ts("2024-01-05 14:01"), D),
]
REFUNDS = [
    ("1", "101", Decimal("500"), "request", ts("2024-01-10 11:00"), D),
    ("2", "101", Decimal("600"), "correction", ts("2024-01-11 11:00"), D),
    ("3", "103", Decimal("100"), "trial", ts("2024-01-08 12:00"), D),
]
EVENTS = [
    ("1", "1", "view_product", ts("2024-01-05 13:00"), D),
    ("2", "1", "add_to_cart", ts("2024-01-05 13:10"), D),
    ("3", "1", "purchase_click", ts("2024-01-05 14:00"), D),
    ("4", "1", "view_product", ts("2024-01-05 15:00"), D),
    ("5", "2", "view_product", ts("2024-01-06 14:00"), D),
    ("6", "2", "add_to_cart", ts("2024-01-06 14:20"), D),
    ("6", "2", "add_to_cart", ts("2024-01-06 14:20"), D),
]


def _arms(first_id, experiment, name, plan):
    return [
        (str(first_id + i), experiment, name, user, group, ts(day), ts(day).date())
        for i, (user, group, day) in enumerate(plan)
    ]


ASSIGNMENTS = _arms(
    1,
    "exp_001",
    "first",
    [
        ("101", "control", "2024-01-05"),
        ("102", "treatment", "2024-01-05"),
        ("103", "control", "2024-01-05"),
        ("104", "treatment", "2024-01-06"),
        ("105", "control", "2024-01-06"),
        ("106", "treatment", "2024-01-06"),
    ],
) + _arms(
    7,
    "exp_002",
    "second",
    [
        ("101", "treatment", "2024-01-07"),
        ("102", "control", "2024-01-07"),
        ("103", "treatment", "2024-01-07"),
        ("104", "control", "2024-01-07"),
    ],
)
PRE = [(u, p, e, 30) for u, p, e in (("101", 3, 15), ("102", 1, 8), ("103", 0, 3), ("104", 2, 12), ("105", 1, 6), ("106", 4, 20))]


def small_warehouse(spark, as_written: bool = False, as_of: str = "2024-02-01") -> Warehouse:
    def frame(data, schema):
        return lambda: spark.createDataFrame(data, schema)

    raw = RawTables(
        users=frame(USERS, schemas.USERS_RAW),
        orders=frame(ORDERS, schemas.ORDERS_RAW),
        refunds=frame(REFUNDS, schemas.REFUNDS_RAW),
        events=frame(EVENTS, schemas.EVENTS_RAW),
        assignments=frame(ASSIGNMENTS, schemas.EXPERIMENT_ASSIGNMENTS_RAW),
        pre_experiment=frame(PRE, schemas.USER_PRE_EXPERIMENT_RAW),
    )
    return Warehouse(raw, as_of=as_of, events_as_written=as_written)


def events(spark, data):
    """(user, name, time text or datetime) to an events DataFrame."""
    full = [
        (str(i), u, n, t if isinstance(t, dt.datetime) else ts(t)) for i, (u, n, t) in enumerate(data)
    ]
    return spark.createDataFrame(full, "event_id string, user_id string, event_name string, event_timestamp timestamp_ntz")
