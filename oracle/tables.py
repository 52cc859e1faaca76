"""SQL of the raw, staging, fact and mart tables, for the independent check of the Spark results.

Each entry is one common table expression; `with_tables` puts the ones a query needs in front of it.
Written for DuckDB: NULL order is spelled out, sums are cast back to the declared types, and rounding
goes through a decimal so that halves are rounded up as in decimal arithmetic.
"""

from __future__ import annotations

import re


def dbl(decimal_sql: str) -> str:
    """Nearest double of an exact decimal."""
    return f"cast(cast({decimal_sql} as varchar) as double)"


def rnd(x: str, digits: int = 4) -> str:
    return f"cast(round(cast({x} as decimal(38,12)), {digits}) as double)"


def sdiv(n: str, d: str, digits: int = 4) -> str:
    quotient = rnd(f"cast({n} as double) / nullif(cast({d} as double), 0)", digits)
    return f"case when ({d}) is null or ({d}) = 0 then cast(0 as double) else {quotient} end"


def exact_sum(x: str) -> str:
    return dbl(f"sum(cast({x} as decimal(38,9)))")


def exact_mean(x: str) -> str:
    return f"{exact_sum(x)} / nullif(count({x}), 0)"


COPIES = "(select unnest([0, 1]) as copy)"
LOADED = "case when copy = 1 then date '2024-01-30' else date '2024-01-31' end as _loaded_at"

TABLES: dict[str, str] = {
    "users_raw": f"""
        select cast(c_custkey as varchar) as user_id,
               timestamp '1995-01-01' + to_days(cast(c_custkey % 1800 - copy as integer)) as signup_timestamp,
               case when c_custkey % 11 = 0 then null
                    when c_custkey % 3 = 0 then '  ' || lower(n_name) || ' '
                    else n_name end as country,
               c_mktsegment as acquisition_channel, {LOADED}
        from customer join nation on c_nationkey = n_nationkey
        join {COPIES} on copy = 0 or c_custkey % 10 = 0""",
    "orders_raw": f"""
        select cast(o_orderkey as varchar) as order_id,
               case when o_orderkey % 101 = 0 then 'unknown-' || cast(o_custkey as varchar)
                    else cast(o_custkey as varchar) end as user_id,
               o_orderdate - to_days(cast(copy as integer)) as created_at,
               case when o_orderkey % 50 = 0 then null else cast(o_totalprice as decimal(38,9)) end as amount,
               case o_orderkey % 3 when 0 then 'usd' when 1 then 'USD' else 'inr' end as currency,
               o_orderdate - to_days(cast(copy as integer)) + interval 1 minute as updated_at, {LOADED}
        from orders join {COPIES} on copy = 0 or o_orderkey % 10 = 0""",
    "refunds_raw": """
        select cast(l_orderkey * 10 + l_linenumber as varchar) as refund_id,
               cast(l_orderkey as varchar) as order_id,
               cast(l_extendedprice * (1 - l_discount) as decimal(38,9)) as refund_amount,
               'returned' as reason, l_shipdate as refund_timestamp, date '2024-01-31' as _loaded_at
        from lineitem where l_returnflag = 'R'""",
    "events_raw": f"""
        select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id,
               event_type as event_name, ts as event_timestamp, {LOADED}
        from events join {COPIES} on copy = 0 or event_id % 20 = 0""",
    "event_users": """
        select user_id as uid, count(*) filter (event_type = 'purchase') as buys from events group by 1""",
    "assignments_raw": """
        select cast(uid * 10 + n as varchar) as assignment_id, experiment_id, experiment_name,
               cast(uid as varchar) as user_id,
               case when treated then 'TREATMENT' else 'Control' end as experiment_group,
               cast(started as timestamp) as assigned_at, started as experiment_start_date
        from (
            select *, case when uid % 3 = 0 then date '2024-01-06' else date '2024-01-05' end as started
            from (
                select uid, 1 as n, 'exp_001' as experiment_id, 'layout_test' as experiment_name,
                       uid % 2 = 1 as treated from event_users
                union all
                select uid, 2, 'exp_002', 'onboarding_test', uid % 5 >= 2 from event_users
                union all
                select uid, 3, 'exp_003', 'engagement_test', buys >= 13 from event_users
            ))""",
    "assignments_contaminated": """
        select experiment_id, user_id, lower(experiment_group) as experiment_group from assignments_raw
        union all
        select experiment_id, user_id,
               case when experiment_group = 'Control' then 'treatment' else 'control' end
        from assignments_raw where cast(user_id as bigint) % 50 = 0""",
    "pre_raw": """
        select cast(user_id as varchar) as user_id,
               count(*) filter (event_type = 'purchase') as pre_experiment_purchases,
               count(*) as pre_experiment_events, cast(7 as bigint) as observation_period_days
        from events where ts < timestamp '2024-01-08' group by 1""",
    "converters": """
        select distinct cast(user_id as varchar) as user_id from events
        where event_type = 'purchase' and value > 150""",
    "order_events": """
        select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
               cast(suppkey as varchar) as seller_id, cast(partkey as varchar) as product_id,
               case when o_orderkey % 97 = 0 then -o_totalprice else o_totalprice end as amount,
               'USD' as currency,
               case when o_orderkey % 89 = 0 then null else n_name end as city,
               'REGION_' || cast(n_regionkey as varchar) as state,
               case when o_orderkey % 83 = 0 then null else o_orderpriority end as payment_method,
               o_orderstatus as status,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as "timestamp",
               'order_placed' as event_type
        from orders
        left join (select l_orderkey, min(l_suppkey) as suppkey, min(l_partkey) as partkey
                   from lineitem group by 1) on o_orderkey = l_orderkey
        left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey""",
    "order_events_marked": """
        select *, case
            when order_id is null then 'missing order_id'
            when customer_id is null then 'missing customer_id'
            when amount is null then 'missing amount'
            when city is null then 'missing city'
            when amount <= 0 then 'bad amount'
            when payment_method is null then 'missing payment_method'
            when seller_id is null then 'missing seller_id' end as reject_reason
        from order_events""",
    "valid_events": "select * exclude (reject_reason) from order_events_marked where reject_reason is null",
    "payment_events": """
        select 'PAY-' || cast(o_orderkey as varchar) as payment_id, cast(o_orderkey as varchar) as order_id,
               o_totalprice as amount, o_orderpriority as method,
               case when o_orderkey % 33 = 0 then 'failed' when o_orderkey % 50 = 0 then 'pending'
                    else 'success' end as status,
               'gateway_' || cast(o_orderkey % 4 as varchar) as gateway,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as "timestamp",
               'payment_processed' as event_type
        from orders""",
    "lake_orders": """
        select order_id, customer_id, seller_id, amount, city, status,
               cast(year(cast("timestamp" as timestamp)) as integer) as year,
               cast(month(cast("timestamp" as timestamp)) as integer) as month,
               cast(day(cast("timestamp" as timestamp)) as integer) as day
        from order_events""",
    "stg_orders": """
        select order_id, user_id, created_at as order_timestamp, created_at,
               cast(coalesce(amount, 0) as decimal(38,9)) as order_amount, upper(currency) as currency
        from (select *, row_number() over (partition by order_id
                  order by created_at desc nulls last, _loaded_at desc nulls last, user_id desc nulls last,
                           amount desc nulls last, currency desc nulls last) as rn from orders_raw)
        where rn = 1""",
    "stg_users": """
        select user_id, signup_timestamp, lower(trim(country)) as country,
               lower(trim(acquisition_channel)) as acquisition_channel
        from (select *, row_number() over (partition by user_id
                  order by signup_timestamp desc nulls last, _loaded_at desc nulls last, country desc nulls last,
                           acquisition_channel desc nulls last) as rn from users_raw)
        where rn = 1""",
    "stg_refunds": """
        select refund_id, order_id, refund_amount, refund_timestamp
        from (select *, row_number() over (partition by refund_id
                  order by refund_timestamp desc nulls last, _loaded_at desc nulls last, order_id desc nulls last,
                           refund_amount desc nulls last) as rn from refunds_raw)
        where rn = 1""",
    "stg_events": """
        select event_id, user_id, event_name, event_timestamp
        from (select *, row_number() over (partition by event_id
                  order by event_timestamp desc nulls last, _loaded_at desc nulls last, user_id desc nulls last,
                           event_name desc nulls last) as rn from events_raw)
        where rn = 1""",
    "first_events": """
        select user_id, event_name, event_timestamp
        from (select *, row_number() over (partition by user_id
                  order by event_timestamp asc nulls first, event_id asc nulls first,
                           event_name asc nulls first) as rn from events_raw)
        where rn = 1""",
    "stg_assignments": """
        select assignment_id, experiment_id, experiment_name, user_id,
               lower(experiment_group) as experiment_group, assigned_at, experiment_start_date
        from assignments_raw""",
    "stg_pre": f"""
        select *, {sdiv("pre_experiment_purchases", "observation_period_days")} as pre_experiment_conversion_rate
        from pre_raw""",
    "int_orders_enriched": """
        select o.order_id, o.user_id, o.order_timestamp, o.order_amount, o.currency,
               u.signup_timestamp, u.country, u.acquisition_channel
        from stg_orders o left join stg_users u on o.user_id = u.user_id""",
    "int_order_refunds": """
        select order_id, cast(sum(refund_amount) as decimal(38,9)) as total_refunded_amount
        from stg_refunds group by 1""",
    "fct_revenue": """
        select o.order_id, o.user_id, o.order_timestamp, cast(o.order_timestamp as date) as order_date,
               o.order_amount, o.currency, o.country, o.acquisition_channel,
               cast(coalesce(r.total_refunded_amount, 0) as decimal(38,9)) as total_refund_amount,
               cast(case when o.order_amount - coalesce(r.total_refunded_amount, 0) > 0
                         then o.order_amount - coalesce(r.total_refunded_amount, 0)
                         else 0 end as decimal(38,9)) as net_revenue
        from int_orders_enriched o left join int_order_refunds r on o.order_id = r.order_id""",
    "monthly_revenue": """
        select cast(date_trunc('month', order_timestamp) as timestamp) as revenue_month,
               cast(sum(order_amount) as decimal(38,9)) as total_revenue, count(order_id) as total_orders
        from fct_revenue group by 1""",
    "user_ltv": """
        select user_id, min(order_timestamp) as first_order_timestamp, max(order_timestamp) as last_order_timestamp,
               count(*) as total_orders, cast(sum(net_revenue) as decimal(38,9)) as lifetime_revenue
        from fct_revenue group by 1""",
    "user_retention": """
        select cohort_month, order_month, count(distinct user_id) as active_users
        from (select cast(date_trunc('month', u.signup_timestamp) as timestamp) as cohort_month,
                     cast(date_trunc('month', f.order_timestamp) as timestamp) as order_month, u.user_id
              from stg_users u join fct_revenue f on u.user_id = f.user_id)
        where order_month >= cohort_month group by 1, 2""",
    "clean_orders": """
        select order_id, user_id, created_at, cast(amount as double) as amount, upper(trim(currency)) as currency
        from (select *, row_number() over (partition by order_id order by created_at desc) as rn
              from orders_raw where amount > 0) where rn = 1""",
    "funnel_times": """
        select user_id, min(case when event_name = 'view' then event_timestamp end) as view_time,
               min(case when event_name = 'click' then event_timestamp end) as cart_time,
               min(case when event_name = 'purchase' then event_timestamp end) as purchase_time
        from stg_events group by 1""",
    "ab_user_level": """
        select a.experiment_id, a.experiment_name, a.user_id, a.experiment_group, a.experiment_start_date,
               case when c.user_id is not null then 1 else 0 end as converted,
               coalesce(p.pre_experiment_conversion_rate, 0) as pre_experiment_rate
        from stg_assignments a left join converters c on a.user_id = c.user_id
        left join stg_pre p on a.user_id = p.user_id""",
}


def _ab(cell_keys: str, start: str, suffix: str) -> dict[str, str]:
    """Cells, adjustment, pivot and results; pooled cells leave the start date out of the grouping."""
    return {
        f"ab_cells{suffix}": f"""
            select experiment_id, experiment_name, experiment_group, {start} as experiment_start_date,
                   count(distinct user_id) as users, cast(sum(converted) as bigint) as conversions,
                   {sdiv("sum(converted)", "count(distinct user_id)")} as conversion_rate,
                   avg(cast(converted as double)) as mean_y, avg(pre_experiment_rate) as mean_x,
                   covar_samp(cast(converted as double), pre_experiment_rate) as cov_yx,
                   var_samp(pre_experiment_rate) as var_x
            from ab_user_level group by {cell_keys}""",
        f"ab_cuped{suffix}": f"""
            select experiment_id, experiment_name, experiment_group, experiment_start_date, users, conversions,
                   conversion_rate, mean_y - ({sdiv("cov_yx", "var_x")}) * mean_x as cuped_conversion_rate
            from ab_cells{suffix}""",
        f"ab_pivot{suffix}": "select experiment_id, experiment_name, min(experiment_start_date) as experiment_start_date, "
        + ", ".join(
            f"max(case when experiment_group = '{g}' then {src} end) as {g}_{dst}"
            for src, dst in (
                ("users", "users"),
                ("conversions", "conversions"),
                ("conversion_rate", "rate"),
                ("cuped_conversion_rate", "cuped_rate"),
            )
            for g in ("control", "treatment")
        )
        + f" from ab_cuped{suffix} group by 1, 2",
        f"ab_z{suffix}": f"""
            select *, abs(treatment_rate - control_rate) / nullif(sqrt(
                   pooled * (1 - pooled) * (1.0::double / control_users + 1.0::double / treatment_users)), 0) as z
            from (select *, cast(control_conversions + treatment_conversions as double)
                            / (control_users + treatment_users) as pooled from ab_pivot{suffix})""",
        f"ab_results{suffix}": f"""
            select experiment_id, experiment_name, experiment_start_date, control_users, treatment_users,
                   control_users + treatment_users as total_users, control_conversions, treatment_conversions,
                   {rnd("control_rate")} as control_conversion_rate,
                   {rnd("treatment_rate")} as treatment_conversion_rate,
                   {rnd("treatment_rate - control_rate")} as absolute_lift,
                   {sdiv("treatment_rate - control_rate", "control_rate")} as relative_lift,
                   {rnd("control_cuped_rate")} as control_cuped_conversion_rate,
                   {rnd("treatment_cuped_rate")} as treatment_cuped_conversion_rate,
                   {rnd("treatment_cuped_rate - control_cuped_rate")} as cuped_absolute_lift,
                   coalesce(cast(abs(control_users - treatment_users) as double)
                            / (control_users + treatment_users) > 0.05, false) as sample_ratio_mismatch,
                   coalesce(z > 1.96, false) as is_significant,
                   cast(date_diff('day', experiment_start_date, date '2024-02-01') as integer) as days_running,
                   date_diff('day', experiment_start_date, date '2024-02-01') >= 7 as has_minimum_duration,
                   timestamp '2024-02-01' as calculated_at
            from ab_z{suffix}""",
    }


TABLES |= _ab("1, 2, 3, 4", "experiment_start_date", "")
TABLES |= _ab("1, 2, 3", "min(experiment_start_date)", "_pooled")


def _event_marts(source: str, suffix: str) -> dict[str, str]:
    """The event marts over one input: one row per event id, or the first event per user."""
    steps = ("view", "click", "signup", "purchase")
    return {
        f"product_metrics{suffix}": f"""
            select cast(event_timestamp as date) as event_date, count(distinct user_id) as daily_active_users,
                   count(*) as total_events, count(*) filter (event_name = 'purchase') as purchases,
                   count(*) filter (event_name = 'view') as product_views,
                   count(*) filter (event_name = 'click') as cart_adds,
                   {rnd("count(*) filter (event_name = 'purchase') / cast(count(distinct user_id) as double)")}
                       as purchase_conversion_rate
            from {source} group by 1""",
        f"growth_metrics{suffix}": f"""
            select event_date, dau, dau as wau, dau as mau, purchases, {sdiv("dau", "dau")} as stickiness_ratio,
                   {sdiv("purchases", "dau")} as purchase_conversion_rate
            from (select cast(event_timestamp as date) as event_date, count(distinct user_id) as dau,
                         count(*) filter (event_name = 'purchase') as purchases
                  from {source} group by 1)""",
        f"feature_adoption{suffix}": f"""
            select feature, users_using_feature, total_users,
                   {sdiv("users_using_feature", "total_users")} as adoption_rate
            from (select event_name as feature, count(distinct user_id) as users_using_feature
                  from {source} group by 1),
                 (select count(distinct user_id) as total_users from {source})""",
        f"growth_accounting{suffix}": growth_accounting_sql(source),
        f"multi_step_funnel{suffix}": " union all ".join(
            f"select '{s}' as step, count(*) as users from (select distinct user_id from {source} where event_name = '{s}')"
            for s in steps
        ),
        f"sequential_funnel{suffix}": sequential_sql(source, steps),
        f"user_sessions{suffix}": f"""
            select user_id, cast(session_id as bigint) as session_id, min(event_timestamp) as session_start,
                   max(event_timestamp) as session_end,
                   date_sub('second', min(event_timestamp), max(event_timestamp)) as session_duration,
                   count(*) as events_in_session
            from (select *, sum(starts) over (partition by user_id order by event_timestamp) as session_id
                  from (select *, case when previous is null or date_sub('minute', previous, event_timestamp) > 30
                                       then 1 else 0 end as starts
                        from (select user_id, event_timestamp, lag(event_timestamp) over (
                                  partition by user_id order by event_timestamp) as previous from {source})))
            group by 1, 2""",
    }


def growth_accounting_sql(source: str) -> str:
    return f"""
        select activity_date, count(distinct user_id) filter (status = 'new') as new_users,
               count(distinct user_id) filter (status = 'retained') as retained_users,
               count(distinct user_id) filter (status = 'resurrected') as resurrected_users,
               count(distinct user_id) as dau,
               {sdiv("count(distinct user_id) filter (status = 'retained')", "count(distinct user_id)")}
                   as retention_ratio,
               {sdiv("count(distinct user_id) filter (status = 'new')", "count(distinct user_id)")} as new_user_ratio
        from (select *, case when previous is null then 'new' when activity_date - previous > 7 then 'resurrected'
                             else 'retained' end as status
              from (select *, lag(activity_date) over (partition by user_id order by activity_date) as previous
                    from (select distinct user_id, cast(event_timestamp as date) as activity_date from {source})))
        group by 1"""


def sequential_sql(source: str, steps: tuple[str, ...], by: str = "") -> str:
    """Each step's users by a join with the step before; `by` splits the funnel by a column of the source."""
    key = f"{by}, user_id" if by else "user_id"
    match = f"e.{by} = p.{by} and e.user_id = p.user_id" if by else "e.user_id = p.user_id"
    parts = [f"l0 as (select {key}, min(event_timestamp) as t from {source} where event_name = '{steps[0]}' group by all)"]
    for i, step in enumerate(steps[1:], start=1):
        cols = ", ".join(f"e.{k.strip()}" for k in key.split(","))
        parts.append(
            f"l{i} as (select {cols}, min(e.event_timestamp) as t from {source} e join l{i - 1} p "
            f"on {match} and e.event_timestamp > p.t where e.event_name = '{step}' group by all)"
        )
    if by:
        final = " union all ".join(
            f"select d.{by}, '{s}' as step, count(p.user_id) as users from (select distinct {by} from l0) d "
            f"left join l{i} p on d.{by} = p.{by} group by 1"
            for i, s in enumerate(steps)
        )
    else:
        final = " union all ".join(f"select '{s}' as step, count(*) as users from l{i}" for i, s in enumerate(steps))
    return f"with {', '.join(parts)} {final}"


TABLES |= _event_marts("stg_events", "")
TABLES |= _event_marts("first_events", "_first_event")


def with_tables(query: str) -> str:
    """The query with the tables it needs, directly or through others, as common table expressions."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    tables = ",\n".join(f"{n} as ({TABLES[n]})" for n in needed)
    return f"with {tables}\nselect * from ({query})"
