"""Expected values worked out by hand on the small sample rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from samples import small_warehouse
from tidemark.operators import cleaning, experiments, reports, revenue
from tidemark.operators.quality import HEALTH


def test_staging(spark, rows):
    w = small_warehouse(spark)
    assert rows(w.stg_orders, "order_id", "user_id", "order_amount", "currency") == [
        ("101", "1", Decimal("1000"), "USD"),
        ("102", "2", Decimal("2000.5"), "USD"),
        ("103", "3", Decimal("0"), "INR"),
    ]
    assert rows(w.stg_users, "user_id", "country", "acquisition_channel") == [
        ("1", "india", "facebook"),
        ("2", "india", "facebook"),
        ("3", None, "google"),
    ]
    assert w.stg_events.count() == 6
    assert rows(small_warehouse(spark, as_written=True).stg_events) == [
        ("1", "view_product", dt.datetime(2024, 1, 5, 13)),
        ("2", "view_product", dt.datetime(2024, 1, 6, 14)),
    ]
    rates = dict(rows(w.stg_user_pre_experiment, "user_id", "pre_experiment_conversion_rate"))
    assert rates == {"101": 0.1, "102": 0.0333, "103": 0.0, "104": 0.0667, "105": 0.0333, "106": 0.1333}


def test_revenue(spark, rows):
    w = small_warehouse(spark)
    assert dict(rows(w.int_order_refunds)) == {"101": Decimal("1100"), "103": Decimal("100")}
    expected = [
        ("101", Decimal("1100"), Decimal("0")),
        ("102", Decimal("0"), Decimal("2000.5")),
        ("103", Decimal("100"), Decimal("0")),
    ]
    assert rows(w.fct_revenue, "order_id", "total_refund_amount", "net_revenue") == expected
    layered = revenue.fct_revenue(w.int_orders_enriched, w.int_order_refunds)
    assert layered.schema == w.fct_revenue.schema and rows(layered) == rows(w.fct_revenue)
    assert rows(w.mart_monthly_revenue) == [(dt.datetime(2024, 1, 1), Decimal("3000.5"), 3)]
    assert rows(w.mart_user_ltv, "user_id", "total_orders", "lifetime_revenue") == [
        ("1", 1, Decimal("0")),
        ("2", 1, Decimal("2000.5")),
        ("3", 1, Decimal("0")),
    ]
    january = dt.datetime(2024, 1, 1)
    assert rows(w.mart_user_retention) == [(january, january, 3)]
    assert rows(revenue.no_over_refund(w.fct_revenue), "order_id") == [("101",), ("103",)]


def test_order_reports(spark, rows):
    w = small_warehouse(spark)
    clean = cleaning.clean_orders(w.raw.orders())
    assert rows(reports.revenue_by_currency(clean)) == [("USD", 3000.5, 2, 1500.25, 2000.5)]
    assert rows(reports.grand_total(clean)) == [(3000.5,)]
    users = cleaning.drop_duplicates(w.raw.users(), ["user_id"])
    assert dict(rows(reports.revenue_by_channel(clean, users))) == {"Facebook": 1000.0, "facebook": 2000.5}


def test_activity(spark, rows):
    for as_written in (False, True):
        w = small_warehouse(spark, as_written)
        days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
        assert rows(w.mart_growth_metrics) == [(d, 1, 1, 1, 0, 1.0, 0.0) for d in days]
        assert rows(w.mart_growth_accounting) == [(d, 1, 0, 0, 1, 0.0, 1.0) for d in days]


def test_sessions_and_funnels(spark, rows):
    w = small_warehouse(spark)
    assert rows(w.mart_user_sessions, "user_id", "session_id", "session_duration", "events_in_session") == [
        ("1", 1, 600, 2),
        ("1", 2, 0, 1),
        ("1", 3, 0, 1),
        ("2", 1, 1200, 2),
    ]
    steps = [("add_to_cart", 2), ("checkout", 0), ("purchase", 0), ("view_product", 2)]
    assert rows(w.mart_multi_step_funnel) == steps
    assert rows(w.mart_sequential_funnel) == steps
    first = small_warehouse(spark, as_written=True)
    steps[0] = ("add_to_cart", 0)
    assert rows(first.mart_multi_step_funnel) == steps
    assert rows(first.mart_sequential_funnel) == steps
    adoption = {r.feature: (r.users_using_feature, r.total_users, r.adoption_rate) for r in w.mart_feature_adoption.collect()}
    assert adoption == {"view_product": (2, 2, 1.0), "add_to_cart": (2, 2, 1.0), "purchase_click": (1, 2, 0.5)}


def test_experiments(spark, rows):
    w = small_warehouse(spark)
    got = {r.experiment_id: r.asDict() for r in w.mart_ab_test_results.collect()}
    for exp, start in (("exp_001", dt.date(2024, 1, 5)), ("exp_002", dt.date(2024, 1, 7))):
        r = got[exp]
        assert (r["experiment_start_date"], r["control_users"], r["treatment_users"], r["total_users"]) == (start, 2, 2, 4)
        zero = ("control_conversion_rate", "treatment_conversion_rate", "absolute_lift", "relative_lift", "cuped_absolute_lift")
        assert all(r[c] == 0 for c in zero)
        assert not r["sample_ratio_mismatch"] and not r["is_significant"] and r["has_minimum_duration"]
    pooled = experiments.ab_test_pooled(
        w.stg_experiment_assignments, w.converters, w.stg_user_pre_experiment, as_of="2024-02-01"
    )
    assert rows(pooled, "experiment_id", "control_users", "treatment_users") == [("exp_001", 3, 3), ("exp_002", 2, 2)]
    pivoted = experiments.pivot_groups(
        experiments.cuped_adjust(
            experiments.ab_cells(
                experiments.ab_user_level(w.stg_experiment_assignments, w.converters, w.stg_user_pre_experiment)
            )
        )
    )
    assert rows(experiments.ab_z_score(pivoted), "z_score") == [(None,), (None,)]


def test_monitoring(spark):
    w = small_warehouse(spark)
    got = {r.model_name: (r.row_count, r.health_status, r.latest_date) for r in w.monitored().collect()}
    assert got == {
        "fct_revenue": (3, HEALTH[2], dt.date(2024, 1, 7)),
        "mart_growth_metrics": (2, HEALTH[2], dt.date(2024, 1, 6)),
        "mart_user_retention": (1, HEALTH[1], dt.date(2024, 1, 1)),
        "mart_ab_test_results": (2, HEALTH[2], dt.date(2024, 1, 7)),
    }
    assert w.monitored().first().model_name == "mart_user_retention"
