"""One SQL query per registered Spark query."""

from __future__ import annotations

from oracle.tables import (
    TABLES,
    dbl,
    exact_mean,
    exact_sum,
    growth_accounting_sql,
    rnd,
    sdiv,
    sequential_sql,
    with_tables,
)
from tidemark.operators.quality import Between, NotNull, Unique
from tidemark.plans.quality_rules import RULES

STEPS = ("view", "click", "signup", "purchase")
LAST = 'order by "timestamp" desc, order_id desc'

STORED = {
    "int_orders_enriched": "int_orders_enriched",
    "int_order_refunds": "int_order_refunds",
    "stg_user_pre_experiment": "stg_pre",
    "mart_monthly_revenue": "monthly_revenue",
    "mart_user_retention": "user_retention",
    "mart_user_ltv": "user_ltv",
    "mart_funnel_conversion": "funnel_times",
    "mart_product_metrics": "product_metrics",
    "mart_multi_step_funnel": "multi_step_funnel",
    "mart_growth_metrics": "growth_metrics",
    "mart_user_sessions": "user_sessions",
    "mart_feature_adoption": "feature_adoption",
    "mart_sequential_funnel": "sequential_funnel",
    "mart_ab_test_results": "ab_results",
}


def _check(table: str, column: str, name: str, failures: str) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, '{name}' as check_name, failures, "
        f"case when failures = 0 then 'pass' else 'fail' end as status from ({failures})"
    )


def _count_where(source: str, condition: str) -> str:
    return f"select count(*) filter ({condition}) as failures from {source}"


def _duplicates(source: str, column: str) -> str:
    return (
        f"select count(*) as failures from (select {column} from {source} where {column} is not null "
        f"group by 1 having count(*) > 1)"
    )


def _declared_checks() -> str:
    parts = []
    for table, rules in RULES.items():
        source = STORED.get(table, table)
        for rule in rules:
            if isinstance(rule, NotNull):
                failures = _count_where(source, f"{rule.column} is null")
            elif isinstance(rule, Between):
                failures = _count_where(source, f"{rule.column} < {rule.low} or {rule.column} > {rule.high}")
            elif isinstance(rule, Unique):
                failures = _duplicates(source, rule.column)
            parts.append(_check(table, rule.column, rule.name, failures))
    return " union all ".join(parts)


def _rounded(table: str, *cols: str, digits: int = 12) -> str:
    return f"select * replace ({', '.join(f'{rnd(c, digits)} as {c}' for c in cols)}) from {table}"


def _actives(days: int) -> str:
    return (
        f"(select count(distinct a.user_id) from active a where a.day between d.day - {days - 1} and d.day)"
    )


def _rates(documents: str, stamp: str) -> str:
    return (
        f"select 'USD' as base_currency, 'k' as target_currency, cast(json_extract_string(props, '$.k') as double) "
        f"as exchange_rate, strftime(ts, '%Y-%m-%d') as rate_date, '{stamp}' as _ingested_at, 'rates' as _source "
        f"from {documents}"
    )


PLAN_CHANGES = """(select user_id, plan, updated_at from (
    select cast(o_custkey as varchar) as user_id, o_orderpriority as plan, o_orderdate as updated_at,
           row_number() over (partition by o_custkey, o_orderdate order by o_orderpriority desc) as rn from orders)
    where rn = 1)"""

VERSIONS = f"""(select user_id, plan, updated_at as valid_from,
    lead(updated_at) over (partition by user_id order by updated_at) as valid_to from {PLAN_CHANGES})"""

MOVED = """(select user_id,
    case when cast(user_id as bigint) % 5 = 0 then signup_timestamp + interval 1 day else signup_timestamp end
        as signup_timestamp,
    case when cast(user_id as bigint) % 7 = 0 then 'elsewhere' else country end as country,
    acquisition_channel from stg_users)"""


def _scd2(changed: str, start: str) -> str:
    """`changed` and `start` speak of o (open version) and n (new row)."""
    return f"""
        select o.user_id, o.signup_timestamp, o.country, o.acquisition_channel, o.signup_timestamp as valid_from,
               case when {changed} then {start} end as valid_to, not ({changed}) as is_current
        from stg_users o join {MOVED} n on o.user_id = n.user_id
        union all
        select n.user_id, n.signup_timestamp, n.country, n.acquisition_channel, {start}, null, true
        from stg_users o join {MOVED} n on o.user_id = n.user_id where {changed}"""


def _p_value(z: str) -> str:
    t = f"(1 / (1 + 0.2316419::double * {z}))"
    poly = (
        f"({t} * (0.319381530::double + {t} * (-0.356563782::double + {t} * (1.781477937::double + {t} * "
        f"(-1.821255978::double + {t} * 1.330274429::double)))))"
    )
    return f"2 * exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {poly}"


def _last_mean(source: str, key: str = "") -> str:
    lead = f"{key}, " if key else ""
    return f"select {lead}coalesce({exact_mean('amount')}, 0) as rolling_avg from ({source}) {'group by 1' if key else ''}"


CITY = f"select city, {exact_sum('amount')} as revenue, count(*) as orders, {exact_mean('amount')} as avg_order_value from valid_events group by 1"
SELLER = f"select seller_id, {exact_sum('amount')} as revenue from valid_events group by 1"
PAYMENTS = f"""
    select method, count, {rnd("cast(count as double) / (sum(count) over ()) * 100", 1)} as percentage
    from (select payment_method as method, count(*) as count from valid_events group by 1)"""
TOTALS = f"select count(*) as total_orders, {exact_sum('amount')} as total_revenue from valid_events"
LAST_100 = _last_mean(f"select * from valid_events {LAST} limit 100")
LAST_100_CITY = _last_mean(
    f"select * from (select *, row_number() over (partition by city {LAST}) as rn from valid_events) where rn <= 100",
    "city",
)
USERS_ANY = "(select distinct user_id, country, acquisition_channel from users_raw)"
ENRICHED = f"""
    select o.order_id, o.user_id, o.amount, o.currency, u.country, u.acquisition_channel
    from clean_orders o left join {USERS_ANY} u on o.user_id = u.user_id"""
DATED = "(select *, cast(event_timestamp as date) as event_date from stg_events)"
DAILY_FUNNEL = sequential_sql(DATED, STEPS, "event_date")

FRAME = "over (partition by currency order by created_at, order_id rows between 99 preceding and current row)"


def _metrics(period: str, keys: str, cols: str, source: str, where: str = "") -> str:
    head = f"{period} as period, " if period else ""
    return f"select {head}{keys}{', ' if keys else ''}{cols} from {source} {where} group by all"


AOV = f"{dbl('sum(order_amount)')} / count(order_id) as average_order_value"
GROSS = "cast(sum(order_amount) as decimal(38,9)) as total_revenue"

# An amount that is no number is found out where a missing one would be.
REFUSED = """
    select order_id, case when cast(order_id as bigint) % 73 = 0 then 'malformed json'
        when cast(order_id as bigint) % 79 = 0 and reject_reason in ('missing order_id', 'missing customer_id') then reject_reason
        when cast(order_id as bigint) % 79 = 0 then 'bad amount' else reject_reason end as reject_reason{}
    from order_events_marked
    where reject_reason is not null or cast(order_id as bigint) % 73 = 0 or cast(order_id as bigint) % 79 = 0"""

SQL: dict[str, str] = {
    # Scans
    "read_raw": "select * from orders_raw",
    "read_csv": "select * from users_raw",
    "read_parquet_prefix": "select * from lake_orders",
    "read_partition_filtered": f"""
        select year, month, count(*) as orders, {exact_sum("amount")} as amount from lake_orders
        where year = 1998 and month <= 6 group by 1, 2""",
    "explode_rates": _rates("events", "2024-02-01T00:00:00+00:00"),
    "time_spine": """
        select coalesce(cast(d as date), day) as date_day, coalesce(n, 0) as events
        from range(timestamp '2023-01-01', timestamp '2027-01-01', interval 1 day) s(d)
        full join (select cast(event_timestamp as date) as day, count(*) as n from stg_events group by 1)
        on cast(d as date) = day""",
    "date_spine": """
        select coalesce(cast(d as date), q) as spine_date, coalesce(n, 0) as orders
        from range(timestamp '1994-01-01', timestamp '2003-01-01', interval 3 month) s(d)
        full join (select cast(date_trunc('quarter', order_timestamp) as date) as q, count(*) as n
                   from stg_orders group by 1) on cast(d as date) = q""",
    "fill_gaps": """
        select coalesce(cast(d as date), event_date) as event_date, coalesce(dau, 0) as dau, coalesce(wau, 0) as wau,
               coalesce(mau, 0) as mau, coalesce(purchases, 0) as purchases,
               coalesce(stickiness_ratio, 0) as stickiness_ratio,
               coalesce(purchase_conversion_rate, 0) as purchase_conversion_rate
        from range(timestamp '2023-12-01', timestamp '2024-03-01', interval 1 day) s(d)
        full join growth_metrics on cast(d as date) = event_date""",
    # Cleaning and functions
    "dedup_latest": """
        select * exclude (rn) from (select *, row_number() over (partition by order_id
            order by created_at desc, _loaded_at desc) as rn from orders_raw) where rn = 1""",
    "drop_duplicates": "select distinct event_id, user_id, event_name, event_timestamp from events_raw",
    "stg_orders": "select * from stg_orders",
    "stg_users": "select * from stg_users",
    "stg_refunds": "select * from stg_refunds",
    "stg_events": "select * from stg_events",
    "stg_events_as_written": "select * from first_events",
    "stg_experiment_assignments": "select * from stg_assignments",
    "stg_user_pre_experiment": "select * from stg_pre",
    "clean_orders_spark": """
        select order_id, user_id, created_at, cast(amount as double) as amount, upper(trim(currency)) as currency,
               updated_at, _loaded_at
        from (select *, row_number() over (partition by order_id order by created_at desc) as rn from orders_raw)
        where rn = 1 and amount > 0""",
    "rename_column": "select * rename (_loaded_at as user_loaded_at) from users_raw",
    "local_date": """
        select cast(event_timestamp + interval '5 hours 30 minutes' as date) as local_date, count(*) as events
        from stg_events group by 1""",
    "surrogate_key": """
        select user_id, md5(coalesce(length(user_id) || ':' || user_id, '-')
            || coalesce(length(country) || ':' || country, '-')
            || coalesce(length(acquisition_channel) || ':' || acquisition_channel, '-')) as user_key from stg_users""",
    "safe_divide": f"""
        select order_id, {sdiv("total_refund_amount", "order_amount")} as refund_rate from fct_revenue""",
    # Joins, revenue
    "orders_enriched": "select * from int_orders_enriched",
    "order_refunds": "select * from int_order_refunds",
    "fct_revenue": "select * from fct_revenue",
    "fct_revenue_layered": "select * from fct_revenue",
    "retention_join": """
        select distinct cohort_month, order_month, user_id
        from (select cast(date_trunc('month', u.signup_timestamp) as timestamp) as cohort_month,
                     cast(date_trunc('month', f.order_timestamp) as timestamp) as order_month, u.user_id
              from stg_users u join fct_revenue f on u.user_id = f.user_id)
        where order_month >= cohort_month""",
    "monthly_revenue": "select * from monthly_revenue",
    "user_ltv": "select * from user_ltv",
    "user_retention": "select * from user_retention",
    "no_over_refund": "select * from fct_revenue where total_refund_amount > order_amount",
    "revenue_decomposition": f"""
        select period, active_users, orders, {rnd("cast(orders as double) / active_users")} as orders_per_user,
               {rnd(f"{dbl('revenue')} / orders")} as aov, revenue
        from (select cast(date_trunc('month', order_timestamp) as date) as period,
                     count(distinct user_id) as active_users, count(order_id) as orders,
                     cast(sum(order_amount) as decimal(38,9)) as revenue
              from fct_revenue group by 1)""",
    "revenue_decomposition_items": f"""
        select period, active_users, orders, {rnd("cast(orders as double) / active_users")} as orders_per_user,
               {rnd(f"{dbl('revenue')} / orders")} as aov, items, {rnd("cast(items as double) / orders")} as items_per_order,
               {rnd(f"{dbl('revenue')} / items")} as item_price, revenue
        from (select cast(date_trunc('month', order_timestamp) as date) as period,
                     count(distinct user_id) as active_users, count(f.order_id) as orders,
                     cast(sum(order_amount) as decimal(38,9)) as revenue, cast(sum(l.items) as bigint) as items
              from fct_revenue f left join (select cast(l_orderkey as varchar) as order_id,
                                                   sum(cast(l_quantity as bigint)) as items from lineitem group by 1) l
                   on f.order_id = l.order_id group by 1)""",
    "user_retention_by_signup_plan": f"""
        with cohorts as (
          select u.user_id, v.plan, cast(date_trunc('month', u.signed) as timestamp) as cohort_month
          from (select *, signup_timestamp + interval 3 years as signed from stg_users) u
          left join {VERSIONS} v on u.user_id = v.user_id and v.valid_from <= u.signed
               and (v.valid_to is null or u.signed < v.valid_to)),
        months as (select distinct user_id, cast(date_trunc('month', order_timestamp) as timestamp) as order_month from fct_revenue)
        select plan, cohort_month, order_month, count(*) as active_users
        from cohorts join months using (user_id) where order_month >= cohort_month group by 1, 2, 3""",
    "segment_change": f"""
        select segment, value_a, value_b, cast(value_b - value_a as decimal(38,9)) as change,
               {rnd(f"{dbl('value_b - value_a')} / {dbl('sum(value_b - value_a) over ()')}")} as share_of_change
        from (select acquisition_channel as segment,
                     cast(coalesce(sum(net_revenue) filter (order_date >= date '1997-01-01'
                          and order_date < date '1998-01-01'), 0) as decimal(38,9)) as value_a,
                     cast(coalesce(sum(net_revenue) filter (order_date >= date '1998-01-01'
                          and order_date < date '1999-01-01'), 0) as decimal(38,9)) as value_b
              from fct_revenue group by 1)""",
    "plain_enrich": ENRICHED,
    "broadcast_enrich": ENRICHED,
    "revenue_by_currency": f"""
        select currency, {exact_sum("amount")} as total_revenue, count(order_id) as order_count,
               {exact_mean("amount")} as avg_order_value, max(amount) as max_order_value
        from clean_orders group by 1""",
    "revenue_by_channel": f"select acquisition_channel, {exact_sum('amount')} as revenue from ({ENRICHED}) group by 1",
    "grand_total": f"select {exact_sum('amount')} as revenue from clean_orders",
    "skew_check": "select status as key, count(*) as count from order_events group by 1",
    "first_rows": "select * from orders_raw order by order_id, created_at limit 5",
    "user_order_windows": f"""
        select user_id, order_id, amount,
               row_number() over (partition by user_id order by created_at, order_id) as order_rank,
               lag(amount) over (partition by user_id order by created_at, order_id) as prev_amount,
               {dbl('''sum(cast(amount as decimal(38,9))) over (partition by user_id order by created_at, order_id
                   rows between unbounded preceding and current row)''')} as running_total
        from clean_orders""",
    "moving_average": f"""
        select currency, order_id, created_at, amount,
               {dbl(f"sum(cast(amount as decimal(38,9))) {FRAME}")} / count(amount) {FRAME} as moving_avg
        from clean_orders""",
    # Activity, funnels, sessions
    "product_metrics": "select * from product_metrics",
    "growth_metrics_as_written": "select * from growth_metrics",
    "growth_accounting": "select * from growth_accounting",
    "feature_adoption": "select * from feature_adoption",
    "funnel_step_times": "select * from funnel_times",
    "multi_step_funnel": "select * from multi_step_funnel",
    "sequential_funnel": "select * from sequential_funnel",
    "user_sessions": "select * from user_sessions",
    "user_sessions_by_gap": TABLES["user_sessions"].replace("> 30", "> 120"),
    **{
        f"{name}_first_event": f"select * from {name}_first_event"
        for name in (
            "product_metrics",
            "growth_metrics",
            "growth_accounting",
            "feature_adoption",
            "multi_step_funnel",
            "sequential_funnel",
            "user_sessions",
        )
    },
    "rolling_active_users": f"""
        with active as (select distinct user_id, cast(event_timestamp as date) as day from stg_events),
             days as (select d.day as event_date, {_actives(1)} as dau, {_actives(7)} as wau, {_actives(30)} as mau
                      from (select distinct day from active) d)
        select *, {sdiv("dau", "mau")} as stickiness_ratio from days""",
    "rolling_active_users_approx": """
        select distinct cast(event_timestamp as date) as event_date, true as dau_close, true as wau_close,
               true as mau_close from stg_events""",
    "product_metrics_local": TABLES["product_metrics"].replace(
        "cast(event_timestamp as date)", "cast(event_timestamp + interval '5 hours 30 minutes' as date)"
    ),
    "growth_accounting_by_channel": f"""
        select acquisition_channel, activity_date, count(user_id) filter (previous is null) as new_users,
               count(user_id) filter (activity_date - previous <= 7) as retained_users,
               count(user_id) filter (activity_date - previous > 7) as resurrected_users, count(user_id) as dau,
               {sdiv("count(user_id) filter (activity_date - previous <= 7)", "count(user_id)")} as retention_ratio,
               {sdiv("count(user_id) filter (previous is null)", "count(user_id)")} as new_user_ratio
        from (select *, lag(activity_date) over (partition by user_id order by activity_date) as previous
              from (select distinct e.user_id, acquisition_channel, cast(event_timestamp as date) as activity_date
                    from stg_events e left join stg_users u on e.user_id = u.user_id))
        group by 1, 2""",
    "metric_query_filtered_each": """
        select coalesce(g.period, r.period) as period, daily_active_users, order_count
        from (select cast(date_trunc('year', event_date) as date) as period,
                     cast(sum(dau) as bigint) as daily_active_users from growth_metrics where dau > 1 group by 1) g
        full join (select cast(date_trunc('year', order_date) as date) as period, count(order_id) as order_count
                   from fct_revenue where currency = 'USD' group by 1) r on g.period = r.period""",
    "split_messages_refused": REFUSED.format(", cast(order_id as bigint) % 73 = 0 as cut"),
    "stream_split_messages_refused": REFUSED.format(""),
    "check_unique_columns": _check(
        "experiment_assignments_raw",
        "user_id, experiment_id",
        "unique",
        """select count(*) as failures from (select user_id, experiment_id from assignments_raw
           where user_id is not null and experiment_id is not null group by 1, 2 having count(*) > 1)""",
    ),
    "growth_accounting_purchases": growth_accounting_sql(
        "(select * from stg_events where event_name = 'purchase')"
    ),
    "rolling_active_users_by_channel": f"""
        with active as (select distinct e.user_id, acquisition_channel as c,
                               cast(event_timestamp + interval '5 hours 30 minutes' as date) as day
                        from stg_events e left join stg_users u on e.user_id = u.user_id),
             days as (select d.c as acquisition_channel, d.day as event_date, {", ".join(
                 f"(select count(distinct user_id) from active a where a.c is not distinct from d.c "
                 f"and a.day > d.day - {n} and a.day <= d.day) as {name}" for name, n in (("dau", 1), ("wau", 7), ("mau", 30)))}
                      from (select distinct c, day from active) d)
        select *, {sdiv("dau", "mau")} as stickiness_ratio from days""",
    "churned_users_by_channel": """
        with active as (select distinct e.user_id, acquisition_channel as c,
                               cast(event_timestamp + interval '5 hours 30 minutes' as date) as day
                        from stg_events e left join stg_users u on e.user_id = u.user_id)
        select d.c as acquisition_channel, d.day as activity_date,
               (select count(*) from active y where y.c is not distinct from d.c and y.day = d.day - 1 and not exists (
                    select 1 from active t where t.day = d.day and t.user_id = y.user_id)) as churned_users
        from (select distinct c, day from active) d""",
    "churned_users_local": """
        with active as (select distinct user_id, cast(event_timestamp + interval '5 hours 30 minutes' as date) as day from stg_events)
        select d.day as activity_date,
               (select count(*) from active y where y.day = d.day - 1 and not exists (
                    select 1 from active t where t.day = d.day and t.user_id = y.user_id)) as churned_users
        from (select distinct day from active) d""",
    "ab_sequential": """
        with entered as (select experiment_id, lower(experiment_group) as g, cast(user_id as varchar) as user_id,
                                min(cast(assigned_at as timestamp)) as assigned_at from assignments_raw group by 1, 2, 3),
             bought as (select cast(user_id as varchar) as user_id, ts from events where event_type = 'purchase' and value > 150),
             first as (select experiment_id, g, e.user_id, min(ts) as ts from entered e join bought b
                       on e.user_id = b.user_id and b.ts >= e.assigned_at group by 1, 2, 3),
             moves as (select experiment_id, g, cast(assigned_at as date) as day, 1 as n, 0 as x from entered
                       union all select experiment_id, g, cast(ts as date), 0, 1 from first),
             days as (select experiment_id, day, sum(n) filter (g = 'control') as nc, sum(n) filter (g = 'treatment') as nt,
                             sum(x) filter (g = 'control') as xc, sum(x) filter (g = 'treatment') as xt from moves group by 1, 2),
             seen as (select experiment_id, day, sum(coalesce(nc, 0)) over w as nc, sum(coalesce(nt, 0)) over w as nt,
                             sum(coalesce(xc, 0)) over w as xc, sum(coalesce(xt, 0)) over w as xt
                      from days window w as (partition by experiment_id order by day)),
             rated as (select *, xt / nullif(nt, 0) - xc / nullif(nc, 0) as lift,
                              (xt / nt) * (1 - xt / nt) / nt + (xc / nc) * (1 - xc / nc) / nc as v from seen),
             looked as (select *, case when v > 0 then least(1.0::double, exp(-(0.05 * 0.05)::double * lift * lift
                              / (2 * v * (v + 0.0025::double))) * sqrt((v + 0.0025::double) / v)) else 1.0::double end as p from rated)
        select experiment_id, day, nc::bigint as control_users, nt::bigint as treatment_users, xc::bigint as control_conversions,
               xt::bigint as treatment_conversions, round(lift, 8) as lift,
               round(min(p) over w, 8) as always_valid_p, round(min(p) over w, 8) < 0.05 as may_stop
        from looked window w as (partition by experiment_id order by day)""",
    "churned_users": """
        with active as (select distinct user_id, cast(event_timestamp as date) as day from stg_events)
        select d.day as activity_date,
               (select count(*) from active y where y.day = d.day - 1 and not exists (
                    select 1 from active t where t.day = d.day and t.user_id = y.user_id)) as churned_users
        from (select distinct day from active) d""",
    "multi_step_funnel_daily": " union all ".join(
        f"select event_date, '{s}' as step, count(distinct user_id) filter (event_name = '{s}') as users "
        f"from {DATED} where event_name in {STEPS} group by 1"
        for s in STEPS
    ),
    "sequential_funnel_daily": DAILY_FUNNEL,
    "step_after_join": """
        select e.user_id, min(e.event_timestamp) as reached_at
        from stg_events e join (select user_id, min(event_timestamp) as t from stg_events
                                where event_name = 'view' group by 1) v
        on e.user_id = v.user_id and e.event_timestamp > v.t where e.event_name = 'click' group by 1""",
    "funnel_step_rates": f"""
        with f as (select step, cast(sum(users) as bigint) as users, list_position({list(STEPS)}, step) as i
                   from ({DAILY_FUNNEL}) group by 1)
        select step, users,
               case when i = 1 then 1 else {sdiv("users", "(lag(users) over (order by i))")} end as step_rate,
               {sdiv("users", "(first_value(users) over (order by i))")} as overall_rate
        from f""",
    # Experiments
    "ab_user_level": "select * from ab_user_level",
    "ab_cells": _rounded("ab_cells", "mean_y", "mean_x", "cov_yx", "var_x"),
    "cuped_adjust": _rounded("ab_cuped", "cuped_conversion_rate"),
    "pivot_groups": _rounded("ab_pivot", "control_cuped_rate", "treatment_cuped_rate"),
    "ab_test_results": "select * from ab_results",
    "ab_test_pooled": "select * from ab_results_pooled",
    "ab_z_score": f"""
        select experiment_id, {rnd("z", 6)} as z_score, {rnd(_p_value("z"), 6)} as p_value from ab_z_pooled""",
    "ab_power": """
        select experiment_id, control_rate as baseline_rate,
               cast(ceil(7.848879734349089::double * (control_rate * (1 - control_rate)
                    + (control_rate + 0.1::double) * (1 - (control_rate + 0.1::double))) / 0.01::double) as bigint)
                   as required_per_group,
               least(control_users, treatment_users) as actual_min_group,
               least(control_users, treatment_users) >= ceil(7.848879734349089::double * (control_rate * (1 - control_rate)
                    + (control_rate + 0.1::double) * (1 - (control_rate + 0.1::double))) / 0.01::double) as is_powered
        from ab_pivot_pooled""",
    "assignment_contamination": """
        select experiment_id, user_id, count(distinct experiment_group) as n_groups from assignments_contaminated
        group by 1, 2 having count(distinct experiment_group) > 1""",
    # Order events
    "parse_order_events": "select * from order_events",
    "payments_sink_topic": "select * from payment_events",
    "split_valid": "select * from valid_events",
    "split_rejected": "select * from order_events_marked where reject_reason is not null",
    "top_cities": f"select * from ({CITY}) order by revenue desc, city desc limit 5",
    "top_sellers": f"select * from ({SELLER}) order by revenue desc, seller_id desc limit 5",
    "payment_distribution": PAYMENTS,
    "running_totals": TOTALS,
    "running_city_metrics": CITY,
    "running_seller_revenue": SELLER,
    "rolling_last_n_avg": LAST_100,
    "rolling_last_n_avg_by_city": LAST_100_CITY,
    "gold_city_revenue": f"""
        select city, cast(round(sum(cast(amount as decimal(38,9))), 2) as double) as sum, count(amount) as count,
               {rnd(exact_mean("amount"), 2)} as mean
        from lake_orders where city is not null group by 1""",
    # Sinks and incremental jobs
    "write_table": "select * from user_ltv",
    "write_partitioned": ENRICHED,
    "write_snappy_parquet": "select * from payment_events",
    "append_rates": _rates("events", "2024-02-01T00:00:00+00:00")
    + " union all "
    + _rates("events", "2024-02-02T00:00:00+00:00"),
    "write_read_verify": "select count(*) as rows_read_back from clean_orders",
    "select_unprocessed": "select year, month, count(*) as orders from lake_orders where year >= 1998 group by 1, 2",
    "incremental_revenue": "select * from fct_revenue",
    # Quality, monitoring
    "check_not_null": " union all ".join(
        _check("users_raw", c, "not_null", _count_where("users_raw", f"{c} is null"))
        for c in ("user_id", "signup_timestamp", "country", "acquisition_channel", "_loaded_at")
    ),
    "check_unique": _check("events_raw", "event_id", "unique", _duplicates("events_raw", "event_id")),
    "check_between": _check(
        "orders_raw", "amount", "between", _count_where("orders_raw", "amount < 0 or amount > 250000")
    ),
    "check_accepted_values": _check(
        "orders_raw", "currency", "accepted_values", _count_where("orders_raw", "currency not in ('USD', 'INR')")
    ),
    "check_row_count": _check(
        "orders_raw",
        "*",
        "row_count",
        "select cast(case when count(*) between 1 and 1000 then 0 else 1 end as bigint) as failures from orders_raw",
    ),
    "check_contract": """
        select 'fct_revenue' as table_name, column_name, issue from (values
            ('status', 'missing column'), ('note', 'undeclared column'),
            ('order_amount', 'type double, declared decimal(38,9)')) v(column_name, issue)
        union all
        select 'fct_revenue', c, 'null values' from (
            select 'order_id' as c, count(*) filter (order_id is null) as n from fct_revenue
            union all select 'user_id', count(*) filter (user_id is null) from fct_revenue
            union all select 'country', count(*) filter (country is null) from fct_revenue) where n > 0""",
    "check_contract_stg_orders": """
        select 'stg_orders' as table_name, c as column_name, 'null values' as issue from (
            select 'order_id' as c, count(*) filter (order_id is null) as n from stg_orders
            union all select 'user_id', count(*) filter (user_id is null) from stg_orders) where n > 0""",
    "run_checks": _declared_checks(),
    "source_freshness": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count, max(_loaded_at) as latest_load, "
        f"cast(date '2024-02-01' - max(_loaded_at) as integer) as days_stale, "
        f"case when 24 * (date '2024-02-01' - max(_loaded_at)) > {error} then 'error' "
        f"when 24 * (date '2024-02-01' - max(_loaded_at)) > {warn} then 'warn' else 'pass' end as status from {t}"
        for t, warn, error in (
            ("users_raw", 24, 48),
            ("orders_raw", 4, 8),
            ("refunds_raw", 24, 48),
            ("events_raw", 4, 30),
        )
    ),
    "row_count_minimums": " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count, cast({low} as bigint) as min_rows, "
        f"case when count(*) < {low} then 'fail' else 'pass' end as status from {source}"
        for name, source, low in (
            ("fct_revenue", "fct_revenue", 1),
            ("mart_growth_metrics", "growth_metrics", 365),
            ("mart_user_ltv", "user_ltv", 1),
            ("mart_ab_test_results", "ab_results", 1),
            ("mart_pipeline_monitoring", "(select unnest(['fact', 'growth', 'retention', 'tests']))", 1),
        )
    ),
    "pipeline_monitoring": """
        select model_name, row_count, latest_date, timestamp '2024-02-01' as checked_at,
               case when row_count = 0 then 'CRITICAL - empty table' when row_count < 2 then 'WARNING - low row count'
                    else 'OK' end as health_status,
               cast(date '2024-02-01' - latest_date as integer) as days_since_latest_data
        from (select 'fct_revenue' as model_name, count(*) as row_count, max(order_date) as latest_date from fct_revenue
              union all select 'mart_growth_metrics', count(*), max(event_date) from growth_metrics
              union all select 'mart_user_retention', count(*), max(cast(cohort_month as date)) from user_retention
              union all select 'mart_ab_test_results', count(*), max(experiment_start_date) from ab_results)""",
    # History
    "scd2_history": f"select *, valid_to is null as is_current from {VERSIONS}",
    "scd2_history_tracked": f"""
        select user_id, plan, updated_at as valid_from, lead(updated_at) over w as valid_to,
               lead(updated_at) over w is null as is_current
        from (select *, lag(plan) over (partition by user_id order by updated_at) as was from {PLAN_CHANGES})
        where was is distinct from plan window w as (partition by user_id order by updated_at)""",
    "asof_user_attributes": f"""
        select f.refund_id, f.user_id, f.refund_timestamp, v.plan
        from (select r.refund_id, cast(o.o_custkey as varchar) as user_id, r.refund_timestamp
              from stg_refunds r join orders o on r.order_id = cast(o.o_orderkey as varchar)) f
        left join {VERSIONS} v on f.user_id = v.user_id and v.valid_from <= f.refund_timestamp
             and (v.valid_to is null or f.refund_timestamp < v.valid_to)""",
    "scd2_apply": _scd2("n.signup_timestamp > o.signup_timestamp", "n.signup_timestamp"),
    "scd2_apply_columns": _scd2("n.country is distinct from o.country", "timestamp '2024-02-01'"),
    "scd2_apply_stored": _scd2("n.country is distinct from o.country", "timestamp '2024-02-01'"),
    "store_checked": "select * from stg_orders",
    # Metrics and dashboards
    "metric_query_growth": f"""
        select cast(date_trunc('week', event_date) as date) as period,
               cast(sum(dau) as bigint) as daily_active_users, cast(sum(wau) as bigint) as weekly_active_users,
               cast(sum(mau) as bigint) as monthly_active_users,
               cast(sum(dau) as double) / cast(sum(mau) as double) as dau_mau_stickiness
        from growth_metrics group by 1""",
    "metric_query_revenue": _metrics(
        "cast(date_trunc('quarter', order_date) as date)",
        "acquisition_channel, currency",
        f"{GROSS}, cast(sum(net_revenue) as decimal(38,9)) as total_net_revenue, count(order_id) as order_count, {AOV}",
        "fct_revenue",
    ),
    "metric_query_filtered": _metrics(
        "", "acquisition_channel", f"{GROSS}, count(order_id) as order_count", "fct_revenue", "where currency = 'USD'"
    ),
    "metric_query_combined": f"""
        select coalesce(g.period, r.period) as period, daily_active_users, total_revenue, order_count
        from (select cast(date_trunc('year', event_date) as date) as period,
                     cast(sum(dau) as bigint) as daily_active_users from growth_metrics group by 1) g
        full join (select cast(date_trunc('year', order_date) as date) as period, {GROSS},
                          count(order_id) as order_count from fct_revenue group by 1) r on g.period = r.period""",
    "product_dashboard_feed": """
        select p.*, g.dau, g.wau, g.mau, g.stickiness_ratio
        from product_metrics p join growth_metrics g on p.event_date = g.event_date""",
    "revenue_dashboard_feed": """
        select d.*, m.total_revenue, m.total_orders
        from (select cast(date_trunc('month', order_timestamp) as timestamp) as revenue_month, order_date,
                     count(order_id) as orders, cast(sum(order_amount) as decimal(38,9)) as gross_revenue,
                     cast(sum(net_revenue) as decimal(38,9)) as net_revenue
              from fct_revenue group by 1, 2) d join monthly_revenue m on d.revenue_month = m.revenue_month""",
    "retention_dashboard_feed": """
        select *, cast(date_diff('month', cohort_month, order_month) as integer) as months_since_signup
        from user_retention""",
    # Streams: the same tables, asked in batch
    "stream_source": "select order_id as message_key, customer_id from order_events",
    "stream_sink_keyed": """
        select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
               o_totalprice as amount from orders""",
    "stream_parse_order_events": "select * from order_events",
    "stream_split_valid": "select * from valid_events",
    "stream_split_rejected": "select * from order_events_marked where reject_reason is not null",
    "stream_city_metrics": CITY,
    "stream_seller_revenue": SELLER,
    "stream_top_cities": f"select * from ({CITY}) order by revenue desc, city desc limit 5",
    "stream_payment_distribution": PAYMENTS,
    "stream_running_totals": TOTALS,
    "stream_rolling_last_n_avg": LAST_100,
    "stream_rolling_last_n_avg_by_city": LAST_100_CITY,
    "commit_after_success": "select * from order_events",
    "bounded_run": "select status, count(*) as payments from payment_events group by 1",
    "stream_dedup": "select event_id, user_id, event_name, event_timestamp from stg_events",
    "stream_sessions": "select user_id, session_start, session_end, events_in_session from user_sessions",
    "stream_daily_metrics": """
        select event_date, total_events, purchases, daily_active_users, true as active_users_close from product_metrics""",
}

ORACLE = {name: with_tables(sql) for name, sql in SQL.items()}
