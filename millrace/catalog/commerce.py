"""Loyalty, sales, restaurants, couriers, groups, turnover."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import query
from millrace.plans import groups, loyalty, restaurants, sales, turnover
from millrace.sources.scans import calendar


@query("order_latest_status", "status_log", """
    select distinct o_orderkey as order_id, o_custkey as user_id, o_totalprice as cost, s.status
    from orders join (
        select order_id, status, row_number() over (
                   partition by order_id
                   order by dttm desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as rn
        from status_log) s on o_orderkey = s.order_id
    where rn = 1""")
def order_latest_status(v, spark):
    orders = v("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("cost"),
    )
    return loyalty.latest_status(
        orders, v("status_log"), by=("dttm", "l_linenumber", "l_partkey", "l_suppkey")
    )


@query("rfm_segments", "rfm_users rfm_orders", """
    with use as (
        select u.user_id, coalesce(max(order_ts), timestamp '1900-01-01') as last_ts,
               count(order_id) as orders, coalesce(sum(payment), 0) as paid
        from rfm_users u left join (
            select * from rfm_orders
            where status = 'Closed' and order_ts >= timestamp '1996-01-01') o
            on u.user_id = o.user_id
        group by u.user_id)
    select user_id, ntile(5) over (order by last_ts, user_id) as recency,
           ntile(5) over (order by orders, user_id) as frequency,
           ntile(5) over (order by paid, user_id) as monetary_value
    from use""")
def rfm_segments(v, spark):
    return loyalty.rfm_segments(v("rfm_users"), v("rfm_orders"), "1996-01-01")


@query("daily_sales_fact", "order_log", """
    select extract(year from date_time) * 10000 + extract(month from date_time) * 100
               + extract(day from date_time) as date_id,
           item_id, customer_id, city_id, quantity,
           cast(case when status = 'refunded' then -payment_amount else payment_amount end
                as double) as payment_amount, status
    from order_log""")
def daily_sales_fact(v, spark):
    log = v("order_log")
    days = log.agg(F.to_date(F.min("date_time")).alias("first"), F.to_date(F.max("date_time")).alias("last")).first()
    return sales.sales_fact(log, calendar(spark, str(days["first"]), str(days["last"])))


@query("weekly_retention", "order_log", """
    with g as (
        select extract(isoyear from date_time) as period_year, extract(week from date_time) as period_id,
               item_id, customer_id, city_id, status, count(customer_id) as n,
               sum(payment_amount) as paid
        from order_log group by 1, 2, 3, 4, 5, 6)
    select count(case when n = 1 and status <> 'refunded' then 1 end) as new_customers_count,
           count(case when n > 1 and status <> 'refunded' then 1 end) as returning_customers_count,
           count(case when status = 'refunded' then 1 end) as refunded_customer_count,
           'weekly' as period_name, period_year, period_id, item_id,
           cast(sum(case when n = 1 and status <> 'refunded' then paid end) as double)
               as new_customers_revenue,
           cast(sum(case when n > 1 and status <> 'refunded' then paid end) as double)
               as returning_customers_revenue,
           sum(case when status = 'refunded' then 1 end) as customers_refunded
    from g group by period_year, period_id, item_id""")
def weekly_retention(v, spark):
    return sales.retention(v("order_log"))


@query("new_dimension_members", "order_log", """
    with early as (select * from order_log where date_time < timestamp '1996-06-01')
    select 'city' as kind, cast(city_id as string) as member, cast(null as string) as name,
           cast(null as int) as city_id
    from order_log where city_id not in (select city_id from early) group by city_id
    union all
    select 'customer', cast(customer_id as string), customer_name, max(city_id)
    from order_log where customer_id not in (select customer_id from early)
    group by customer_id, customer_name
    union all
    select 'item', cast(item_id as string), item_name, null
    from order_log where item_id not in (select item_id from early) group by item_id, item_name""")
def new_dimension_members(v, spark):
    log = v("order_log")
    early = log.filter(F.col("date_time") < F.lit("1996-06-01").cast("timestamp_ntz"))
    none = F.lit(None)

    def found(kind, key, attrs, latest=()):
        dim = early.select(key).distinct()
        rows = sales.new_members(log, dim, key, attrs, latest)
        return rows.select(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("member"),
            (F.col(attrs[0]) if attrs else none).cast("string").alias("name"),
            (F.col("city_id") if latest else none).cast("int").alias("city_id"),
        )

    return (
        found("city", "city_id", [])
        .unionByName(found("customer", "customer_id", ["customer_name"], ["city_id"]))
        .unionByName(found("item", "item_id", ["item_name"]))
    )


@query("settlement_report", "ps_sales ps_products ps_restaurants ps_orders ps_timestamps", """
    select p.restaurant_id, r.restaurant_name, t.date as settlement_date,
           count(distinct s.order_id) as orders_count,
           cast(sum(total_sum) as double) as orders_total_sum,
           cast(sum(bonus_payment) as double) as orders_bonus_payment_sum,
           cast(sum(bonus_grant) as double) as orders_bonus_granted_sum,
           cast(sum(total_sum) * cast(0.25 as decimal(4,2)) as double) as order_processing_fee,
           cast(sum(total_sum) - sum(total_sum) * cast(0.25 as decimal(4,2)) - sum(bonus_payment)
                as double) as restaurant_reward_sum
    from ps_sales s left join ps_products p on s.product_id = p.id
         left join ps_restaurants r on p.restaurant_id = r.id
         left join ps_orders o on s.order_id = o.id
         left join ps_timestamps t on o.timestamp_id = t.id
    where o.order_status = 'CLOSED'
    group by p.restaurant_id, r.restaurant_name, t.date""")
def settlement_report(v, spark):
    return restaurants.settlement(
        v("ps_sales"), v("ps_products"), v("ps_restaurants"), v("ps_orders"), v("ps_timestamps")
    )


@query("courier_ledger", "deliveries couriers", """
    with m as (
        select *, extract(year from order_ts) as settlement_year,
               extract(month from order_ts) as settlement_month,
               avg(rate) over (partition by courier_id, extract(year from order_ts),
                               extract(month from order_ts)) as rate_avg
        from deliveries),
    p as (
        select *, case when rate_avg < 4 then greatest(sum * cast(0.05 as decimal(4,2)), 100)
                       when rate_avg < 4.5 then greatest(sum * cast(0.07 as decimal(4,2)), 150)
                       when rate_avg < 4.9 then greatest(sum * cast(0.08 as decimal(4,2)), 175)
                       else greatest(sum * cast(0.1 as decimal(4,2)), 200) end as pay
        from m)
    select p.courier_id, c.name as courier_name, settlement_year, settlement_month,
           count(distinct order_id) as orders_count, cast(sum(sum) as double) as orders_total_sum,
           rate_avg, cast(sum(sum) * cast(0.25 as decimal(4,2)) as double) as order_processing_fee,
           cast(sum(pay) as double) as courier_order_sum,
           cast(sum(tip_sum) as double) as courier_tips_sum,
           cast(sum(pay) + sum(tip_sum) * cast(0.95 as decimal(4,2)) as double)
               as courier_reward_sum
    from p left join couriers c on p.courier_id = c.courier_id
    group by p.courier_id, c.name, settlement_year, settlement_month, rate_avg""")
def courier_ledger(v, spark):
    return restaurants.courier_ledger(v("deliveries"), v("couriers"))


@query("group_conversion", "h_groups l_user_group s_auth_history messages", """
    with ten as (select hk_group_id from h_groups order by registration_dt, group_id limit 10),
    added as (
        select l.hk_group_id, count(distinct l.hk_user_id) as cnt_added_users
        from l_user_group l join s_auth_history s
             on l.hk_l_user_group_activity = s.hk_l_user_group_activity
        where s.event = 'add' and l.hk_group_id in (select hk_group_id from ten)
        group by l.hk_group_id),
    wrote as (
        select hk_group_id, count(distinct hk_user_id) as n
        from messages where hk_group_id in (select hk_group_id from ten) group by hk_group_id)
    select a.hk_group_id, cnt_added_users, n as cnt_users_in_group_with_messages,
           cast(n as double) / cnt_added_users as group_conversion
    from added a left join wrote w on a.hk_group_id = w.hk_group_id""")
def group_conversion(v, spark):
    messages = v("messages")
    return groups.group_conversion(
        v("h_groups"), v("l_user_group"), v("s_auth_history"),
        messages.select("hk_group_id", "hk_message_id").distinct(),
        messages.select("hk_message_id", "hk_user_id").distinct(),
    )


@query("turnover_metrics", "transactions rates", """
    with d as (
        select *, cast(transaction_dt as date) as date_update
        from transactions
        where status = 'done' and transaction_dt > timestamp '1996-12-31'),
    total as (
        select d.date_update, d.currency_code as currency_from,
               sum(abs(amount)) as amount, any_value(r.currency_with_div) as rate
        from d left join rates r on d.date_update = cast(r.date_update as date)
             and d.currency_code = r.currency_code_with and r.currency_code = 420
        group by 1, 2),
    ops as (
        select date_update, currency_code as currency_from, count(distinct operation_id) as n
        from d group by 1, 2),
    per as (
        select date_update, currency_from, avg(n) as a from (
            select date_update, currency_code as currency_from, account_number_from,
                   count(distinct operation_id) as n
            from d group by 1, 2, 3) x group by 1, 2),
    acc as (
        select date_update, currency_from, count(*) as n from (
            select date_update, currency_code as currency_from, account_number_from as a from d
            union
            select date_update, currency_code, account_number_to from d) x group by 1, 2)
    select t.date_update, t.currency_from,
           cast(amount as double) / cast(coalesce(rate, 1) as double) as amount_total,
           ops.n as cnt_transactions, per.a as avg_transactions_per_account,
           acc.n as cnt_accounts_make_transactions
    from total t join ops using (date_update, currency_from)
         join per using (date_update, currency_from) join acc using (date_update, currency_from)""")
def turnover_metrics(v, spark):
    mart = v("transactions").select(F.col("transaction_dt").alias("date_update")).filter(
        F.col("date_update") <= F.lit("1996-12-31").cast("timestamp_ntz")
    )
    return turnover.turnover_metrics(v("transactions"), v("rates"), since=mart)
