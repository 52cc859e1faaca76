"""Edges: empty input, ties, single-row cells, exact gaps, missing values, zero denominators."""

from __future__ import annotations

import datetime as dt
import random
import hashlib
import json
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import events, small_warehouse, ts
from tidemark import functions as fn
from tidemark.operators import activity, cleaning, experiments, funnels, order_events, quality, revenue, sessions
from tidemark.plans import semantic
from tidemark.plans.quality_rules import RULES
from tidemark.session import cluster_conf, shuffle_partitions
from tidemark.sources import readers, schemas


def test_safe_divide(spark, rows):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, None), (None, 2), (None, 0)], "n int, d int")
    got = [r[0] for r in df.select(fn.safe_divide("n", "d")).collect()]
    assert got == [0.3333, 0.0, 0.0, None, 0.0]


def test_surrogate_key_and_local_date(spark):
    df = spark.createDataFrame([("a", None, ts("2024-01-01 18:29:59")), ("a", "b", ts("2024-01-01 18:30"))], "x string, y string, t timestamp_ntz")
    out = df.select(fn.surrogate_key("x", "y").alias("k"), fn.local_date("t").alias("d")).collect()
    assert [r.k for r in out] == [hashlib.md5(b"1:a-").hexdigest(), hashlib.md5(b"1:a1:b").hexdigest()]
    assert [r.d for r in out] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_spines(spark):
    assert fn.time_spine(spark).count() == 1461
    months = [r[0] for r in fn.date_spine(spark, "month", "2024-01-01", "2024-03-01").collect()]
    assert months == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]


def test_p_value(spark):
    got = spark.range(1).select(fn.two_sided_p(F.lit(1.96)), fn.two_sided_p(F.lit(0.0))).first()
    assert math.isclose(got[0], 0.0499958, abs_tol=1e-6) and math.isclose(got[1], 1.0, abs_tol=1e-6)


def test_dedup_ties_are_deterministic(spark):
    data = [("k", ts("2024-01-01"), str(i)) for i in range(50)]
    df = spark.createDataFrame(data, "id string, t timestamp_ntz, v string")
    got = {cleaning.dedup_latest(df.repartition(n), ["id"], "t").first().v for n in (1, 3, 7)}
    assert got == {"9"}


@pytest.mark.parametrize(("second", "expected"), [("10:30:59", 1), ("10:31:00", 2)])
def test_session_gap(spark, second, expected):
    ev = events(spark, [("u", "x", "2024-01-01 10:00:00"), ("u", "x", f"2024-01-01 {second}")])
    assert sessions.user_sessions(ev).count() == expected


def test_sessions_since(spark):
    ev = events(spark, [("u", "x", "2024-01-01 10:00"), ("u", "x", "2024-02-01 10:00")])
    assert sessions.user_sessions(ev, since="2024-01-15").count() == 1


def test_empty_inputs(spark, rows):
    ev = events(spark, [("u", "x", "2024-01-01 10:00")]).where("false")
    assert rows(funnels.multi_step_funnel(ev)) == rows(funnels.sequential_funnel(ev))
    assert all(r.users == 0 for r in funnels.multi_step_funnel(ev).collect())
    for op in (
        activity.product_metrics,
        activity.growth_accounting,
        activity.rolling_active_users,
        activity.churned_users,
        activity.feature_adoption,
        sessions.user_sessions,
    ):
        assert op(ev).count() == 0
    none = spark.createDataFrame([], schemas.ORDER_EVENT)
    assert order_events.rolling_last_n_avg(none).first().rolling_avg == 0.0
    assert order_events.payment_distribution(none).count() == 0
    w = small_warehouse(spark)
    health = quality.pipeline_monitoring({"m": (w.fct_revenue.where("false"), "order_date")}, "2024-02-01").first()
    assert health.health_status == quality.HEALTH[0] and health.days_since_latest_data is None


def test_same_time_is_not_after(spark):
    ev = events(spark, [("u", "a", "2024-01-01 10:00"), ("u", "b", "2024-01-01 10:00")])
    got = {r.step: r.users for r in funnels.sequential_funnel(ev, ("a", "b")).collect()}
    assert got == {"a": 1, "b": 0}


def test_funnel_rates(spark):
    funnel = spark.createDataFrame([("a", 4), ("b", 0), ("c", 1)], "step string, users long")
    got = [tuple(r) for r in funnels.funnel_step_rates(funnel, ("a", "b", "c")).collect()]
    assert got == [("a", 4, 1.0, 1.0), ("b", 0, 0.0, 0.0), ("c", 1, 0.0, 0.25)]


def test_growth_statuses(spark, rows):
    days = {"new": "2024-01-01", "next": "2024-01-02", "week": "2024-01-09", "later": "2024-01-17"}
    ev = events(spark, [("u", "x", f"{d} 08:00") for d in days.values()])
    got = rows(activity.growth_accounting(ev), "new_users", "retained_users", "resurrected_users")
    assert sorted(got, reverse=True) == [(1, 0, 0), (0, 1, 0), (0, 1, 0), (0, 0, 1)]
    churn = {str(r.activity_date): r.churned_users for r in activity.churned_users(ev).collect()}
    assert churn == {"2024-01-01": 0, "2024-01-02": 0, "2024-01-09": 0, "2024-01-17": 0}


def test_null_users_do_not_count(spark):
    ev = events(spark, [(None, "x", "2024-01-01 08:00"), ("u", "x", "2024-01-01 09:00")])
    assert activity.growth_accounting(ev).first().new_users == 1
    assert activity.rolling_active_users(ev).first().mau == 1
    assert activity.feature_adoption(ev).first().total_users == 1


def test_single_user_cells(spark):
    level = spark.createDataFrame(
        [("e", "n", "u1", "control", dt.date(2024, 1, 1), 1, 0.5), ("e", "n", "u2", "treatment", dt.date(2024, 1, 1), 0, 0.25)],
        "experiment_id string, experiment_name string, user_id string, experiment_group string, "
        "experiment_start_date date, converted int, pre_experiment_rate double",
    )
    cells = experiments.ab_cells(level)
    assert [r.var_x for r in cells.collect()] == [None, None]
    adjusted = {r.experiment_group: r.cuped_conversion_rate for r in experiments.cuped_adjust(cells).collect()}
    assert adjusted == {"control": 1.0, "treatment": 0.0}


def test_missing_arm(spark):
    w = small_warehouse(spark)
    control_only = w.stg_experiment_assignments.where("experiment_group = 'control'")
    got = experiments.ab_test_results(control_only, w.converters, w.stg_user_pre_experiment, "2024-01-08").collect()
    assert all(r.treatment_users is None and r.total_users is None and not r.is_significant for r in got)
    assert [r.has_minimum_duration for r in sorted(got, key=lambda r: r.experiment_id)] == [False, False]


def test_contamination(spark):
    w = small_warehouse(spark)
    twice = w.stg_experiment_assignments.unionByName(
        w.stg_experiment_assignments.where("user_id = '101'").withColumn("experiment_group", F.lit("other"))
    )
    got = experiments.assignment_contamination(twice).collect()
    assert {(r.experiment_id, r.user_id, r.n_groups) for r in got} == {("exp_001", "101", 2), ("exp_002", "101", 2)}


def test_reject_reasons(spark):
    good = {
        "order_id": "1", "customer_id": "c", "seller_id": "s", "amount": 5.0, "city": "x", "payment_method": "card",
    }
    cases = {
        None: good,
        "missing city": {k: v for k, v in good.items() if k != "city"},
        "missing amount": {**good, "amount": None},
        "bad amount": {**good, "amount": -1.0},
        "missing payment_method": {k: v for k, v in good.items() if k != "payment_method"},
        "missing seller_id": {k: v for k, v in good.items() if k != "seller_id"},
        "missing order_id": "not json",
    }
    values = [(b"k", (v if isinstance(v, str) else json.dumps(v)).encode()) for v in cases.values()]
    parsed = order_events.parse_order_events(spark.createDataFrame(values, schemas.KEYED_MESSAGE))
    got = [r.reject_reason for r in order_events.with_reject_reason(parsed).collect()]
    assert got == list(cases)
    valid, rejected = order_events.split_valid_invalid(parsed)
    assert (valid.count(), rejected.count()) == (1, len(cases) - 1)


def test_top_cities_ties_go_down_the_alphabet(spark):
    data = [("1", "A", 5.0), ("2", "B", 5.0), ("3", "C", 9.0)]
    ev = spark.createDataFrame(data, "order_id string, city string, amount double")
    assert [r.city for r in order_events.top_cities(ev, 2).collect()] == ["C", "B"]


def test_explode_rates(spark, rows):
    doc = json.dumps({"result": "success", "time_last_update_utc": "Mon", "rates": {"EUR": 0.9, "INR": 83}})
    got = readers.explode_rates(spark.createDataFrame([(doc,)], "value string"), ingested_at="now")
    assert got.schema.fieldNames() == schemas.EXCHANGE_RATES_RAW.fieldNames()
    assert rows(got, "target_currency", "exchange_rate") == [("EUR", 0.9), ("INR", 83.0)]


def test_csv_with_dirt(spark, tmp_path, rows):
    (tmp_path / "orders_raw.csv").write_text(
        "order_id,user_id,created_at,amount,currency,updated_at,_loaded_at\n"
        "1,7,2024-01-05 14:00:00,,usd,2024-01-05 14:01:00,2024-04-01\n"
    )
    got = readers.read_raw(spark, str(tmp_path), "orders_raw", "csv")
    assert got.schema == schemas.ORDERS_RAW
    assert rows(got, "order_id", "created_at", "amount") == [("1", ts("2024-01-05 14:00"), None)]


def test_rule_counts():
    flat = [r.name for rules in RULES.values() for r in rules]
    assert (flat.count("not_null"), flat.count("unique"), flat.count("between")) == (56, 15, 9)


def test_checks_find_faults(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (None, 20.0), (2, 7.0)], "id int, v double")
    rules = (
        quality.NotNull("id"),
        quality.Unique("id"),
        quality.Between("v", 0, 10),
        quality.Accepted("id", (1,)),
        quality.RowCount(1, 3),
    )
    got = {r.check_name: (r.failures, r.status) for r in quality.run_table_checks(df, rules, "t").collect()}
    assert got == {
        "not_null": (1, "fail"),
        "unique": (1, "fail"),
        "between": (1, "fail"),
        "accepted_values": (1, "fail"),
        "row_count": (1, "fail"),
    }


def test_freshness_levels(spark):
    def loaded(day):
        return spark.createDataFrame([(dt.date.fromisoformat(day),)] if day else [], "_loaded_at date")

    tables = {"fresh": loaded("2024-01-31"), "old": loaded("2024-01-30"), "older": loaded("2024-01-29"), "empty": loaded("")}
    got = {r.table_name: (r.status, r.days_stale) for r in quality.source_freshness(tables, "2024-01-31 12:00:00").collect()}
    assert got == {"fresh": ("pass", 0), "old": ("warn", 1), "older": ("error", 2), "empty": ("error", None)}


def test_metric_query_keeps_null_groups_and_rejects_unknown(spark):
    w = small_warehouse(spark)
    tables = {"revenue": w.fct_revenue, "growth_metrics": w.mart_growth_metrics}
    got = semantic.metric_query(tables, ["average_order_value", "total_net_revenue"], where="order_amount > 0").first()
    assert (got.average_order_value, float(got.total_net_revenue)) == (1500.25, 2000.5)
    with pytest.raises(ValueError, match="no dimension"):
        semantic.metric_query(tables, ["daily_active_users"], group_by=["currency"])
    both = semantic.metric_query(tables, ["daily_active_users", "order_count"], grain="month").collect()
    assert [tuple(r) for r in both] == [(dt.date(2024, 1, 1), 2, 3)]


def test_segment_change(spark, rows):
    w = small_warehouse(spark)
    got = revenue.segment_change(
        w.fct_revenue, "order_amount", "currency", "order_date", ("2024-01-05", "2024-01-06"), ("2024-01-06", "2024-01-07")
    )
    assert [(r.segment, float(r.change), r.share_of_change) for r in got.orderBy("segment").collect()] == [
        ("INR", 0.0, 0.0),
        ("USD", 1000.5, 1.0),
    ]


def test_surrogate_keys_do_not_meet(spark):
    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), ("a", None), ("a", ""), (None, "a"), ("1:a", "")], "x string, y string")
    assert df.select(fn.surrogate_key("x", "y")).distinct().count() == 6


def test_fill_gaps_keeps_rows_outside(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 5), (dt.date(2025, 1, 1), 7)], "d date, n long")
    got = activity.fill_gaps(df, "d", "2024-01-01", "2024-01-03", ["n"])
    assert [r.n for r in got.orderBy("d").collect()] == [0, 5, 0, 7]


def test_fill_gaps(spark, rows):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 5)], "d date, n long")
    got = activity.fill_gaps(df, "d", "2024-01-01", "2024-01-03", ["n"])
    assert got.dtypes == df.dtypes
    assert [r.n for r in got.orderBy("d").collect()] == [0, 5, 0]


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(100 * 2**40, 8000) == 819200
    assert cluster_conf(2**40, 100)["spark.sql.shuffle.partitions"] == "8192"


def test_money_keeps_nine_digits(spark):
    tiny = Decimal("0.000000001")
    df = spark.createDataFrame([(Decimal("5"), tiny)], "a decimal(38,9), b decimal(38,9)")
    plus, minus = df.select(fn.add_money(F.col("a"), F.col("b")), fn.less_money(F.col("a"), F.col("b"))).first()
    assert (plus, minus) == (Decimal("5.000000001"), Decimal("4.999999999"))
    orders = spark.createDataFrame(
        [("1", "u", ts("2024-01-01"), Decimal("5"))],
        "order_id string, user_id string, order_timestamp timestamp_ntz, order_amount decimal(38,9)",
    )
    refunds = spark.createDataFrame([("1", tiny)], "order_id string, total_refunded_amount decimal(38,9)")
    assert revenue.net_orders(orders, refunds).first().net_revenue == Decimal("4.999999999")


def test_refused_messages_keep_what_came(spark):
    cases = {
        b"not json": "malformed json",
        b'{"order_id": "1", "customer_id": "c"': "malformed json",
        b"[1]": "malformed json",
        b'{"order_id": "1", "customer_id": "c", "amount": "free", "city": "x"}': "bad amount",
        b'{"order_id": "1", "customer_id": "c", "city": "x"}': "missing amount",
        b'{"order_id": "1", "customer_id": "c", "amount": null, "city": "x"}': "missing amount",
    }
    messages = spark.createDataFrame([(b"k", v) for v in [*cases, None]], schemas.KEYED_MESSAGE)
    valid, refused = order_events.split_messages(messages)
    got = {None if r.value is None else bytes(r.value): r.reject_reason for r in refused.collect()}
    assert valid.count() == 0 and got == {**cases, None: "malformed json"}


def test_metric_query_conditions_per_model(spark):
    revenue_rows = spark.createDataFrame([("1", "USD", 5.0), ("2", "INR", 7.0)], "order_id string, currency string, order_amount double")
    growth = spark.createDataFrame([(3,), (4,)], "dau int")
    tables = {"revenue": revenue_rows, "growth_metrics": growth}
    names = ["daily_active_users", "order_count"]
    got = semantic.metric_query(tables, names, where={"revenue": "currency = 'USD'"}).first()
    assert (got.daily_active_users, got.order_count) == (7, 1)
    with pytest.raises(ValueError, match="growth_metrics"):
        semantic.metric_query(tables, names, where="currency = 'USD'")


def test_unique_over_several_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, None), (1, None)], "a int, b int")
    assert quality.check_unique(df, "a, b", "t").first().failures == 1


def test_looking_every_day_does_not_find_what_is_not_there(spark):
    rng = random.Random(8)
    day = lambda n: ts("2024-01-01") + dt.timedelta(days=n)
    assigned, bought = [], []
    for exp, lift in (("none", 0.0), ("large", 0.3)):
        for i in range(1500):
            group, start = ("treatment", "control")[i % 2], rng.randint(0, 5)
            user = f"{exp}{i}"
            assigned.append((exp, group, user, day(start)))
            if rng.random() < 0.3 + (lift if group == "treatment" else 0):
                bought.append((user, day(start + rng.randint(0, 20))))
            bought.append((user, day(start - 1)))  # before the assignment: counts for nothing
    a = spark.createDataFrame(assigned + assigned[:9], "experiment_id string, experiment_group string, user_id string, assigned_at timestamp_ntz")
    c = spark.createDataFrame(bought + bought, "user_id string, converted_at timestamp_ntz")
    found = {}
    for r in experiments.ab_sequential(a, c).orderBy("day").collect():
        found.setdefault(r.experiment_id, []).append(r)
    assert not any(r.may_stop for r in found["none"]) and found["large"][-1].may_stop
    for days in found.values():
        p = [r.always_valid_p for r in days]
        assert p == sorted(p, reverse=True) and days[-1].control_users == days[-1].treatment_users == 750
        wanted = len({u for u, t in bought if u.startswith(days[0].experiment_id)})
        assert days[-1].control_conversions + days[-1].treatment_conversions < wanted


def test_cohorts_stay_what_they_were_at_signup(spark):
    users = spark.createDataFrame([("1", ts("2024-01-05")), ("2", ts("2024-01-05")), ("3", ts("2024-01-05"))], "user_id string, signup_timestamp timestamp_ntz")
    versions = spark.createDataFrame(
        [("1", "in", ts("2024-01-01"), ts("2024-02-01"), False), ("1", "us", ts("2024-02-01"), None, True), ("2", "fr", ts("2024-01-06"), None, True)],
        "user_id string, country string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    )
    then = revenue.users_at_signup(users, versions)
    assert {r.user_id: r.country for r in then.collect()} == {"1": "in", "2": None, "3": None}
    orders = spark.createDataFrame([(u, ts("2024-03-01")) for u in "123"], "user_id string, order_timestamp timestamp_ntz")
    got = {(r.country, r.active_users) for r in revenue.user_retention(then, orders, by=["country"]).collect()}
    assert got == {("in", 1), (None, 2)}
