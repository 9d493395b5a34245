"""The domains of the marts as views over the test tables.

One SQL text serves both engines; ``TSTYPE`` stands for the zone-less timestamp type. A view's text
may name other views.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Id, city, latitude, longitude, time zone.
CITIES = """
1;Sydney;-33.865;151.2094;Australia/Sydney
2;Melbourne;-37.8136;144.9631;Australia/Melbourne
3;Brisbane;-27.4678;153.0281;Australia/Brisbane
4;Perth;-31.9522;115.8589;Australia/Perth
5;Adelaide;-34.9289;138.6011;Australia/Adelaide
6;Gold Coast;-28.0167;153.4;Australia/Brisbane
7;Cranbourne;-38.0996;145.2834;Australia/Melbourne
8;Canberra;-35.2931;149.1269;Australia/Sydney
9;Newcastle;-32.9167;151.75;Australia/Sydney
10;Wollongong;-34.4331;150.8831;Australia/Sydney
11;Geelong;-38.15;144.35;Australia/Melbourne
12;Hobart;-42.8806;147.325;Australia/Hobart
13;Townsville;-19.2564;146.8183;Australia/Brisbane
14;Ipswich;-27.6167;152.7667;Australia/Brisbane
15;Cairns;-16.9303;145.7703;Australia/Brisbane
16;Toowoomba;-27.5667;151.95;Australia/Brisbane
17;Darwin;-12.4381;130.8411;Australia/Darwin
18;Ballarat;-37.55;143.85;Australia/Melbourne
19;Bendigo;-36.75;144.2667;Australia/Melbourne
20;Launceston;-41.4419;147.145;Australia/Hobart
21;Mackay;-21.1411;149.1861;Australia/Brisbane
22;Rockhampton;-23.375;150.5117;Australia/Brisbane
23;Maitland;-32.7167;151.55;Australia/Sydney
24;Bunbury;-33.3333;115.6333;Australia/Perth
"""


def _city_values() -> str:
    rows = []
    for line in CITIES.split("\n"):
        if line:
            i, city, lat, lng, zone = line.split(";")
            rows.append(f"({i}, '{city}', cast({lat} as double), cast({lng} as double), '{zone}')")
    return ", ".join(rows)


OPEN = "TSTYPE '2999-12-31 00:00:00'"

VIEWS: dict[str, str] = {
    "events_k": """
        select event_id, ts, user_id, event_type, value,
               cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
        from events""",
    # --- bank -------------------------------------------------------------------------------
    "bank_clients": f"""
        select c_custkey as client_id, c_name as last_name, c_mktsegment as first_name,
               cast(null as string) as patronymic, 'P' || cast(c_custkey as string) as passport_num,
               date '2024-01-01' + cast(c_custkey % 60 as int) as passport_valid_to,
               '+7' || cast(c_custkey as string) as phone,
               TSTYPE '2020-01-01 00:00:00' as effective_from, {OPEN} as effective_to
        from customer
        union all
        select c_custkey, c_name, c_mktsegment, cast(null as string),
               'P' || cast(c_custkey as string), date '2019-01-01', '+0',
               TSTYPE '2018-01-01 00:00:00', TSTYPE '2019-12-31 23:59:45'
        from customer""",
    "bank_accounts": f"""
        select 'A' || cast(c_custkey as string) as account, c_custkey as client,
               date '2024-01-01' + cast(c_custkey % 45 as int) as valid_to,
               TSTYPE '2020-01-01 00:00:00' as effective_from, {OPEN} as effective_to
        from customer""",
    "bank_cards": f"""
        select ' C' || cast(c_custkey as string) || ' ' as card_num,
               'A' || cast(c_custkey as string) as account,
               TSTYPE '2020-01-01 00:00:00' as effective_from, {OPEN} as effective_to
        from customer""",
    "bank_txns": """
        select event_id as trans_id, ts as trans_date, 'C' || cast(user_id as string) as card_num,
               cast(value as decimal(10,2)) as amt,
               case when event_type = 'purchase' then 'SUCCESS' else 'REJECT' end as oper_result,
               'T' || cast(k as string) as terminal
        from events_k""",
    "bank_terminals": f"""
        select 'T' || cast(k as string) as terminal, n_name as terminal_city,
               TSTYPE '2020-01-01 00:00:00' as effective_from, {OPEN} as effective_to
        from (select distinct k from events_k) t join nation on n_nationkey = k % 25
        union all
        select 'T' || cast(k as string), 'OLD', TSTYPE '2018-01-01 00:00:00',
               TSTYPE '2019-12-31 23:59:45'
        from (select distinct k from events_k) t""",
    "bank_blacklist": """
        select 'P' || cast(c_custkey as string) as passport, TSTYPE '2024-01-10 00:00:00' as entry_dt
        from customer where c_acctbal < 0
        union all
        select 'P' || cast(c_custkey as string), TSTYPE '2024-01-20 00:00:00'
        from customer where c_acctbal < 500""",
    # --- taxi -------------------------------------------------------------------------------
    "taxi_movement": """
        select event_id as movement_id, cast(floor(event_id / 3) as bigint) as ride,
               'car' || cast(cast(floor(event_id / 3) as bigint) % 40 as string) as car_plate_num,
               case when event_id % 3 = 0 then 'READY'
                    when cast(floor(event_id / 3) as bigint) % 10 = 0 then 'CANCEL'
                    when event_id % 3 = 1 then 'BEGIN' else 'END' end as event,
               ts as dt
        from events""",
    "taxi_rides": """
        select cast(floor(event_id / 3) as bigint) as ride_id,
               'from ' || min(event_type) as point_from, 'to ' || max(event_type) as point_to,
               max(cast(value as decimal(10,2))) * cast(0.05 as decimal(3,2)) as distance,
               max(cast(value as decimal(10,2))) * 3 as price,
               'ph' || cast(min(user_id) as string) as client_phone
        from events group by cast(floor(event_id / 3) as bigint)""",
    "taxi_days": """
        select distinct cast(ts as date) as d, cast(floor(event_id / 3) as bigint) % 40 as car
        from events""",
    "taxi_waybills": """
        select 'W' || cast(d as string) || '-' || cast(car as string) as waybill_num,
               'L' || cast((car + extract(day from d)) % 30 as string) as driver_license,
               'car' || cast(car as string) as car_plate_num,
               cast(d as TSTYPE) + (car % 4) * interval '6' hour as work_start_dt,
               cast(d as TSTYPE) + (car % 4) * interval '6' hour
                   + (8 + car % 20) * interval '1' hour as work_end_dt,
               cast(d as TSTYPE) as issue_dt
        from taxi_days""",
    "taxi_drivers": f"""
        select 'L' || cast(s_suppkey as string) as driver_license, s_suppkey + 1000 as personnel_num,
               s_name as last_name, 'F' || cast(s_suppkey as string) as first_name,
               cast(null as string) as middle_name, '55' || cast(s_suppkey as string) as card_num,
               TSTYPE '2020-01-01 00:00:00' as effective_from, {OPEN} as effective_to
        from supplier
        union all
        select 'L' || cast(s_suppkey as string), s_suppkey + 1000, s_name, 'old',
               cast(null as string), '54', TSTYPE '2018-01-01 00:00:00',
               TSTYPE '2019-12-31 23:59:45'
        from supplier""",
    "taxi_payments": """
        select '40' || cast(user_id as string) as card_num,
               cast(value as decimal(10,2)) as transaction_amt, ts as transaction_dt
        from events where event_type = 'purchase'""",
    "taxi_clients": """
        select 'ph' || cast(c_custkey as string) as phone_num,
               '40 ' || cast(c_custkey as string) as card_num, c_custkey as client_id
        from customer""",
    # --- loyalty ----------------------------------------------------------------------------
    "rfm_users": "select c_custkey as user_id from customer",
    "rfm_orders": """
        select o_orderkey as order_id, o_custkey as user_id, o_orderdate as order_ts,
               cast(o_totalprice as decimal(12,2)) as payment,
               case when o_orderstatus = 'F' then 'Closed' else 'Open' end as status
        from orders""",
    "status_log": """
        select l_orderkey as order_id, l_linestatus || '-' || l_returnflag as status,
               l_shipdate as dttm, l_linenumber, l_partkey, l_suppkey
        from lineitem""",
    # --- sales ------------------------------------------------------------------------------
    "order_log": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                   || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-'
                   || cast(cast(l_shipdate as date) as string) as uniq_id,
               o_orderdate as date_time, c_nationkey as city_id, o_custkey as customer_id,
               c_name as customer_name, p_type as item_id, p_type as item_name,
               cast(l_quantity as int) as quantity,
               cast(l_extendedprice as decimal(12,2)) as payment_amount,
               case when l_returnflag = 'R' then 'refunded' else 'shipped' end as status
        from lineitem join orders on l_orderkey = o_orderkey
             join part on l_partkey = p_partkey join customer on o_custkey = c_custkey""",
    # --- restaurants ------------------------------------------------------------------------
    "ps_sales": """
        select l_orderkey as order_id, l_suppkey * 1000000000 + l_partkey as product_id,
               cast(l_extendedprice as decimal(12,2)) as total_sum,
               cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))
                   as bonus_payment,
               cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as bonus_grant
        from lineitem""",
    "ps_products": """
        select distinct l_suppkey * 1000000000 + l_partkey as id, l_suppkey as restaurant_id
        from lineitem""",
    "ps_restaurants": "select s_suppkey as id, s_name as restaurant_name from supplier",
    "ps_orders": """
        select o_orderkey as id,
               extract(year from o_orderdate) * 10000 + extract(month from o_orderdate) * 100
                   + extract(day from o_orderdate) as timestamp_id,
               case when o_orderstatus = 'F' then 'CLOSED' when o_orderstatus = 'P'
                    then 'CANCELLED' else 'OPEN' end as order_status
        from orders""",
    "ps_timestamps": """
        select distinct
               extract(year from o_orderdate) * 10000 + extract(month from o_orderdate) * 100
                   + extract(day from o_orderdate) as id, cast(o_orderdate as date) as date
        from orders""",
    "deliveries": """
        select l_orderkey as order_id, o_orderdate as order_ts,
               cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                   || cast(l_partkey as string) as delivery_id,
               l_suppkey as courier_id, 'addr ' || cast(l_partkey as string) as address,
               l_shipdate as delivery_ts, cast(l_quantity as int) % 5 + 1 as rate,
               cast(l_extendedprice as decimal(12,2)) as sum,
               cast(l_tax as decimal(4,2)) * 100 as tip_sum
        from lineitem join orders on l_orderkey = o_orderkey""",
    "couriers": "select s_suppkey as courier_id, s_name as name from supplier",
    # --- groups -----------------------------------------------------------------------------
    "group_log": """
        select l_suppkey as group_id, o_custkey as user_id,
               case when l_linestatus = 'O' then l_partkey end as user_id_from,
               case when l_returnflag <> 'R' then 'add' else 'leave' end as event,
               l_shipdate as datetime
        from lineitem join orders on l_orderkey = o_orderkey""",
    "h_groups": """
        select l_suppkey as group_id, md5(cast(l_suppkey as string)) as hk_group_id,
               min(l_shipdate) as registration_dt
        from lineitem group by l_suppkey""",
    "h_users": "select c_custkey as user_id, md5(cast(c_custkey as string)) as hk_user_id from customer",
    "l_user_group": """
        select distinct
               md5(cast(group_id as string) || '#$#' || cast(user_id as string))
                   as hk_l_user_group_activity,
               md5(cast(user_id as string)) as hk_user_id,
               md5(cast(group_id as string)) as hk_group_id
        from group_log""",
    "s_auth_history": """
        select md5(cast(group_id as string) || '#$#' || cast(user_id as string))
                   as hk_l_user_group_activity, user_id_from, event, datetime as event_dt
        from group_log""",
    "messages": """
        select md5(cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                   || cast(l_partkey as string) || '-' || cast(l_suppkey as string))
                   as hk_message_id,
               md5(cast(l_suppkey as string)) as hk_group_id,
               md5(cast(o_custkey as string)) as hk_user_id
        from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'F'""",
    # --- geo --------------------------------------------------------------------------------
    "cities": f"""
        select * from (values {_city_values()}) as t(id, city, lat, lng, timezone)""",
    "geo_events": """
        select e.event_id, e.ts, e.user_id, cast(e.ts as date) as date,
               case e.event_type when 'view' then 'message' when 'signup' then 'subscription'
                    when 'click' then 'reaction' else 'other' end as event_type,
               c.lat + (e.event_id % 10) * cast(0.001 as double) as lat,
               c.lng + (e.event_id % 10) * cast(0.001 as double) as lon,
               case when e.event_type = 'view' then (e.user_id * 7 + e.k) % 150 end as message_to,
               case when e.event_type = 'signup' then e.k % 20 end as channel
        from events_k e join cities c
             on c.id = (e.user_id + cast(floor(extract(day from e.ts) / 10) as int)) % 24 + 1""",
    # --- turnover ---------------------------------------------------------------------------
    "transactions": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                   || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
                   as operation_id,
               o_custkey as account_number_from, l_suppkey as account_number_to,
               c_nationkey as currency_code,
               case when o_orderstatus = 'F' then 'done' else 'queued' end as status,
               case when l_returnflag = 'R' then -cast(l_extendedprice as decimal(12,2))
                    else cast(l_extendedprice as decimal(12,2)) end as amount,
               o_orderdate as transaction_dt
        from lineitem join orders on l_orderkey = o_orderkey
             join customer on o_custkey = c_custkey""",
    "rates": """
        select d as date_update, 420 as currency_code, n_nationkey as currency_code_with,
               cast(1 as decimal(6,2)) + n_nationkey * cast(0.1 as decimal(6,2))
                   as currency_with_div
        from (select distinct o_orderdate as d, c_nationkey as nk
              from orders join customer on o_custkey = c_custkey) t
             join nation on n_nationkey = nk
        where n_nationkey < 20
        union all
        select d, 840, n_nationkey, cast(7 as decimal(6,2))
        from (select distinct o_orderdate as d from orders) t join nation on n_regionkey = 1""",
    # --- histories --------------------------------------------------------------------------
    "dim_customer": f"""
        select c_custkey as id, c_mktsegment as segment, c_nationkey as nation,
               TSTYPE '2020-01-01 00:00:00' as effective_from, {OPEN} as effective_to,
               case when c_acctbal < -500 then 1 else 0 end as deleted
        from customer
        union all
        select c_custkey, 'OLD', c_nationkey, TSTYPE '2018-01-01 00:00:00',
               TSTYPE '2019-12-31 23:59:45', 0
        from customer""",
    "stg_customer": """
        select c_custkey as id,
               case when c_acctbal > 5000 then 'NEW ' || c_mktsegment
                    when c_acctbal between 0 and 500 then null
                    else c_mktsegment end as segment,
               c_nationkey as nation, TSTYPE '2023-01-01 00:00:00' as create_dt,
               case when c_acctbal > 7000 then null
                    else TSTYPE '2024-02-01 12:00:00' end as update_dt
        from customer where c_acctbal > -800
        union all
        select s_suppkey + 1000000000, 'FRESH', s_nationkey, TSTYPE '2024-01-15 00:00:00',
               cast(null as TSTYPE)
        from supplier""",
    "slice_customer": """
        select distinct o_custkey as id from orders where o_orderstatus = 'F'
        union
        select s_suppkey + 1000000000 from supplier where s_acctbal > 0""",
    # --- order messages ---------------------------------------------------------------------
    "order_lines": """
        select o_orderkey as order_id, o_orderdate as order_dt,
               case when o_orderstatus = 'P' then 'CANCELLED' else 'CLOSED' end as status,
               cast(o_totalprice as decimal(14,2)) as cost,
               cast(o_totalprice as decimal(14,2)) as payment,
               cast(s_suppkey as string) as restaurant_id, s_name as restaurant_name,
               cast(c_custkey as string) as user_id, c_name as username,
               case when c_acctbal > 0 then lower(c_name) end as login,
               cast(p_partkey as string) as product_id, p_name as product_name,
               p_type as category
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
             join supplier on l_suppkey = s_suppkey join customer on o_custkey = c_custkey""",
}


@cache
def _needs(name: str) -> tuple[str, ...]:
    """Views a view's text names, in an order in which each may be defined."""
    out: list[str] = []
    for other in VIEWS:
        if other != name and re.search(rf"\b{other}\b", VIEWS[name].split("--")[0]):
            if re.search(rf"(from|join)\s+{other}\b", VIEWS[name]):
                out += [n for n in (*_needs(other), other) if n not in out]
    return tuple(out)


def _ordered(names) -> list[str]:
    out: list[str] = []
    for n in names:
        out += [x for x in (*_needs(n), n) if x not in out]
    return out


def duck(names: str, query: str) -> str:
    """SQL for the checking engine: the named views in front of ``query``."""
    parts = [f"{n} as ({VIEWS[n]})" for n in _ordered(names.split())]
    query = query.strip()
    if parts:
        head = "with " + ", ".join(parts)
        query = head + (", " + query[5:] if query.lower().startswith("with ") else " " + query)
    return query.replace("TSTYPE", "timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view, or a test table, as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    texts = [VIEWS[n] for n in _ordered([name])]
    used = {t for t in TABLES if any(re.search(rf"(from|join)\s+{t}\b", x) for x in texts)}
    for t in used:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    parts = [f"{n} as ({VIEWS[n]})" for n in _needs(name)]
    head = "with " + ", ".join(parts) if parts else ""
    return spark.sql(f"{head} {VIEWS[name]}".replace("TSTYPE", "timestamp_ntz"))
