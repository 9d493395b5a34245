"""Documents, snowflake loads, files, sinks, data quality."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.base import query
from millrace.operators.quality import Rules, data_quality
from millrace.plans import restaurants, snowflake
from millrace.functions.values import decimal_comma
from millrace.session import materialize, scratch_path
from millrace.sources import documents, files, scans, sinks

TS = "timestamp_ntz"


def _ts(text: str):
    return F.lit(text).cast(TS)


# --- documents ------------------------------------------------------------------------------


def _order_docs(v):
    """Order documents as the source keeps them."""
    return v("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
            F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("CANCELLED")
            .alias("final_status"),
            F.struct((F.col("o_custkey") % 7).cast("string").alias("id")).alias("restaurant"),
            F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
        )).alias("object_value"),
        F.col("o_orderdate").alias("update_ts"),
    )


@query("json_documents", "", """
    with docs as (
        select cast(o_custkey as string) as object_id,
               '{"custkey":' || o_custkey || ',"orderkey":' || o_orderkey || ',"prio":"'
                   || o_orderpriority || '"}' as object_value,
               o_orderdate as update_ts, o_orderkey
        from orders),
    top as (select max(o_orderdate) as now from orders),
    old as (
        select object_id, max(object_value) as object_value, max(update_ts) as update_ts
        from (select cast(c_custkey as string) as object_id, '{"custkey":' || c_custkey || '}'
                         as object_value,
                     timestamp '2000-01-01' + cast(c_custkey % 700 as int) * interval '1' day
                         as update_ts
              from customer) x
        group by object_id),
    fresh as (
        select object_id, object_value, update_ts from (
            select *, row_number() over (
                       partition by object_id
                       order by update_ts desc, object_value desc) as rn
            from docs where update_ts > timestamp '2001-07-20' - interval '400' day) x
        where rn = 1)
    select object_id, object_value, update_ts from old
    where update_ts >= timestamp '2001-07-20' - interval '600' day
          and object_id not in (select object_id from fresh)
    union all
    select * from fresh""")
def json_documents(v, spark):
    rows = v("orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"),
        F.col("o_orderpriority").alias("prio"), F.col("o_orderdate").alias("ts"),
    )
    body = rows.drop("ts")
    docs = rows.select(
        F.col("custkey").cast("string").alias("object_id"),
        F.to_json(F.struct(*sorted(body.columns))).alias("object_value"),
        F.col("ts").alias("update_ts"),
    )
    target = v("customer").select(
        F.col("c_custkey").cast("string").alias("object_id"),
        F.to_json(F.struct(F.col("c_custkey").alias("custkey"))).alias("object_value"),
        (_ts("2000-01-01") + F.make_dt_interval((F.col("c_custkey") % 700).cast("int")))
        .alias("update_ts"),
    )
    # In two portions: the second one goes on where the first ended.
    portion = max(docs.count() // 3, 1)
    now, days = "2001-07-20 00:00:00", {"lookback_days": 400, "keep_days": 600}
    store, cursor = documents.land_documents(target, docs, now, limit=portion, **days)
    return documents.land_documents(materialize(store, "documents"), docs, now, after=cursor, **days)[0]


@query("snowflake_orders", "", """
    with t as (select distinct o_orderdate as ts from orders),
    r as (
        select o_orderkey as id, cast(o_orderkey as string) as order_key, o_orderdate as ts,
               case when o_orderstatus = 'F' then 'CLOSED' else 'CANCELLED' end as order_status,
               cast(o_custkey % 7 as string) as restaurant_id,
               cast(o_custkey as string) as user_id, c_custkey
        from orders left join (select * from customer where c_acctbal > -990) c
             on c_custkey = o_custkey),
    bad as (select min(id) as b from r where c_custkey is null)
    select id, order_key, r.ts, order_status, restaurant_id, user_id,
           extract(year from r.ts) as year, extract(month from r.ts) as month,
           extract(day from r.ts) as day, '00:00:00' as time, cast(r.ts as date) as date,
           'user ' || user_id as user_name, 'login' || user_id as user_login,
           'R' || restaurant_id as restaurant_name
    from r join t on t.ts = r.ts, bad where c_custkey is not null and (b is null or id < b)""")
def snowflake_orders(v, spark):
    order_docs = _order_docs(v)
    who = v("customer").filter(F.col("c_acctbal") > -990)
    key = F.col("c_custkey").cast("string")
    user_docs = documents.to_documents(
        who.select(
            key.alias("_id"), F.concat(F.lit("user "), key).alias("name"),
            F.concat(F.lit("login"), key).alias("login"),
        ).withColumn("update_ts", _ts("2020-01-01")),
        "_id", "update_ts",
    )
    places = v("orders").select((F.col("o_custkey") % 7).cast("string").alias("_id")).distinct()
    place_docs = documents.to_documents(
        places.withColumns({
            "name": F.concat(F.lit("R"), F.col("_id")),
            "update_ts": _ts("2020-01-01"),
            "menu": F.array().cast("array<struct<_id:string,name:string,price:decimal(14,2)>>"),
        }),
        "_id", "update_ts",
    )
    dim_r, dim_u = restaurants.restaurants(place_docs), restaurants.users(user_docs)
    dim_t = restaurants.timestamps(order_docs)
    loaded, _ = restaurants.orders(order_docs, dim_r, dim_t, dim_u, start=-1)
    return (
        loaded.join(dim_t, "ts").join(dim_u, "user_id").join(dim_r, "restaurant_id")
        .select("id", "order_key", "ts", "order_status", "restaurant_id", "user_id", "year",
                "month", "day", "time", "date", "user_name", "user_login", "restaurant_name")
    )


@query("product_sales_fact", "order_lines", """
    with menu as (
        select distinct restaurant_id, product_id, product_name from order_lines),
    prod as (
        select product_id, min(product_name) as product_name, min(restaurant_id) as restaurant_id
        from menu group by product_id),
    known as (select distinct cast(order_id as string) as order_key from order_lines
              where status = 'CLOSED'),
    pay as (
        select cast(l_orderkey as string) as order_key, cast(l_partkey as string) as product_id,
               max(cast(l_quantity as int)) as count,
               max(cast(l_extendedprice as decimal(14,2))) as total_sum
        from lineitem group by 1, 2)
    select p.product_id, p.order_key, p.count, cast(p.total_sum as double) as price,
           cast(p.total_sum as double) as total_sum, 0.0::double as bonus_payment,
           1.0::double as bonus_grant
    from pay p join known using (order_key) join prod using (product_id)""")
def product_sales_fact(v, spark):
    lines = v("order_lines")
    # A menu comes in documents of a thousand consecutive product numbers, which bounds their size.
    menu = lines.select(
        "restaurant_id", "restaurant_name",
        F.floor(F.col("product_id").cast("bigint") / 1000).alias("part"),
        F.struct(F.col("product_id").alias("_id"), F.col("product_name").alias("name"),
                 F.lit("1.00").cast("decimal(14,2)").alias("price")).alias("item"),
    ).distinct()
    place_docs = documents.to_documents(
        menu.groupBy(
            F.col("restaurant_id").alias("_id"), F.col("restaurant_name").alias("name"), "part"
        )
        .agg(F.collect_list("item").alias("menu"))
        .drop("part")
        .withColumn("update_ts", _ts("2020-01-01")),
        "_id", "update_ts",
    )
    place_docs = materialize(place_docs, "documents")
    products = restaurants.products(place_docs, restaurants.restaurants(place_docs))
    bought = v("lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.max(F.col("l_quantity").cast("int")).alias("quantity"),
        F.max(F.col("l_extendedprice").cast("decimal(14,2)")).alias("product_cost"),
    )
    payment = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_partkey").cast("string").alias("product_name"),
        F.col("product_cost").alias("price"), "quantity", "product_cost",
        F.lit("0.00").cast("decimal(14,2)").alias("bonus_payment"),
        F.lit("1.00").cast("decimal(14,2)").alias("bonus_grant"),
    )
    # One bonus event per order line, as many as the order has products.
    events = bought.select(
        (F.col("l_orderkey") * 10_000_000 + F.col("l_partkey")).alias("id"),
        _ts("2020-01-01").alias("event_ts"), F.lit("bonus_transaction").alias("event_type"),
        F.to_json(F.struct(
            F.lit("1").alias("user_id"), F.col("l_orderkey").cast("string").alias("order_id"),
            F.lit("2020-01-01 00:00:00").alias("order_date"),
            F.array(payment).alias("product_payments"),
        )).alias("event_value"),
    )
    balance = v("customer").select(
        F.col("c_custkey").alias("id"), _ts("2020-01-01").alias("event_ts"),
        F.lit("user_balance").alias("event_type"),
        F.to_json(F.struct(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance")))
        .alias("event_value"),
    )
    closed = lines.filter(F.col("status") == "CLOSED").select(
        F.col("order_id").cast("string").alias("order_key")
    )
    facts, _ = restaurants.product_sales(events.unionByName(balance), closed, products)
    return facts


def _delivery_docs(v):
    """Documents of places with their menus, of people and orders, and the bonus events."""
    lines, since = v("lineitem"), _ts("2020-01-01")
    product = F.concat_ws("-", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"))
    sold = lines.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(
        F.max(F.col("l_quantity").cast("int")).alias("quantity"),
        F.max(F.col("l_extendedprice").cast("decimal(14,2)")).alias("product_cost"),
    )
    # A menu comes in documents of a thousand consecutive part numbers, which bounds their size.
    item = F.struct(product.alias("_id"), product.alias("name"), F.lit("1.00").cast("decimal(14,2)").alias("price"))
    menus = lines.select(
        F.col("l_suppkey").cast("string").alias("_id"), F.floor(F.col("l_partkey") / 1000).alias("part"),
        item.alias("item"),
    ).distinct().groupBy("_id", "part").agg(F.collect_list("item").alias("menu")).drop("part")
    named = v("supplier").select(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_name").alias("name"))
    places = documents.to_documents(
        menus.join(named, "_id").withColumn("update_ts", since), "_id", "update_ts")
    who = F.col("c_custkey").cast("string")
    people = documents.to_documents(
        v("customer").select(who.alias("_id"), F.col("c_name").alias("name"), who.alias("login"))
        .withColumn("update_ts", since), "_id", "update_ts")
    at = lines.groupBy("l_orderkey").agg(F.min("l_suppkey").cast("string").alias("place"))
    bought = v("orders").join(at, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("o_orderkey").cast("string").alias("_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
            F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("CANCELLED").alias("final_status"),
            F.struct(F.col("place").alias("id")).alias("restaurant"),
            F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
        )).alias("object_value"),
        F.col("o_orderdate").alias("update_ts"),
    )
    payment = F.struct(
        product.alias("product_id"), product.alias("product_name"), F.col("product_cost").alias("price"), "quantity",
        "product_cost", F.lit("0.00").cast("decimal(14,2)").alias("bonus_payment"),
        F.lit("1.00").cast("decimal(14,2)").alias("bonus_grant"),
    )
    # One bonus event per order, its lines in the order of their keys.
    events = sold.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(payment)).alias("payments")).select(
        F.col("l_orderkey").alias("id"), since.alias("event_ts"), F.lit("bonus_transaction").alias("event_type"),
        F.to_json(F.struct(
            F.lit("1").alias("user_id"), F.col("l_orderkey").cast("string").alias("order_id"),
            F.lit("2020-01-01 00:00:00").alias("order_date"), F.col("payments").alias("product_payments"),
        )).alias("event_value"),
    )
    return places, people, bought, events


@query("snowflake_settlement", "", """
    with place as (
        select s_suppkey, s_name, row_number() over (order by cast(s_suppkey as varchar)) as id
        from supplier where s_suppkey in (select l_suppkey from lineitem)),
    pay as (
        select l_orderkey, l_partkey, l_suppkey,
               max(cast(l_extendedprice as decimal(14,2))) as total
        from lineitem group by 1, 2, 3),
    sums as (
        select l_suppkey, cast(o_orderdate as date) as day, count(distinct l_orderkey) as n,
               cast(sum(total) as double) as total, cast(count(*) as double) as granted
        from pay join orders on o_orderkey = l_orderkey where o_orderstatus = 'F' group by 1, 2)
    select cast(id as int) as restaurant_id, s_name as restaurant_name, day as settlement_date,
           n as orders_count, total as orders_total_sum, 0.0::double as orders_bonus_payment_sum,
           granted as orders_bonus_granted_sum, round(total * 0.25, 4) as order_processing_fee,
           round(total - total * 0.25, 4) as restaurant_reward_sum
    from sums join place on s_suppkey = l_suppkey""")
def snowflake_settlement(v, spark):
    docs = [materialize(d, "documents") for d in _delivery_docs(v)]
    ids = snowflake.key_ledger(spark, scratch_path(spark, "ids"))
    return snowflake.settlement(snowflake.load(ids, *docs))


@query("snowflake_two_loads", "", """
    with place as (
        select cast(s_suppkey as varchar) as key, s_suppkey % 2 as late,
               row_number() over (order by s_suppkey % 2, cast(s_suppkey as varchar)) as id
        from supplier where s_suppkey in (select l_suppkey from lineitem)),
    person as (
        select cast(c_custkey as varchar) as key, c_custkey % 2 as late,
               row_number() over (order by c_custkey % 2, cast(c_custkey as varchar)) as id
        from customer),
    sent as (
        select o_orderkey, o_orderdate as ts, cast(o_custkey as varchar) as person, cast(s as varchar) as place,
               case when o_custkey % 2 = 0 and s % 2 = 0 then 0 else 1 end as late
        from orders join (select l_orderkey, min(l_suppkey) as s from lineitem group by 1) on l_orderkey = o_orderkey),
    moment as (
        select ts, min(late) as late, row_number() over (order by min(late), ts) as id from sent group by ts),
    ordered as (
        select *, row_number() over (order by late, o_orderkey) as id from sent),
    loads as (select 1 as load union all select 2)
    select load, 'dm_restaurants' as tab, key, cast(id as int) as id, '' as refers from place, loads where late < load
    union all
    select load, 'dm_users', key, cast(id as int), '' from person, loads where late < load
    union all
    select load, 'dm_orders', cast(o_orderkey as varchar), cast(o.id as int),
           moment.id || '|' || place.id || '|' || person.id
    from ordered o join moment on moment.ts = o.ts join place on place.key = o.place join person on person.key = o.person,
         loads where o.late < load""")
def snowflake_two_loads(v, spark):
    docs = [materialize(d, "documents") for d in _delivery_docs(v)[:3]]
    even = F.col("object_id").cast("bigint") % 2 == 0
    early = F.get_json_object("object_value", "$.restaurant.id").cast("bigint") % 2 == 0
    early &= F.get_json_object("object_value", "$.user.id").cast("bigint") % 2 == 0
    no_events = spark.createDataFrame([], "id bigint, event_ts timestamp_ntz, event_type string, event_value string")
    ids = snowflake.key_ledger(spark, scratch_path(spark, "ids"))
    parts = []
    for number, loaded in ((1, [docs[0].filter(even), docs[1].filter(even), docs[2].filter(early)]), (2, docs)):
        tables = snowflake.load(ids, *loaded, no_events)
        refers = F.concat_ws("|", "timestamp_id", "restaurant_id", "user_id")
        parts += [
            tables[name].select(F.lit(number).alias("load"), F.lit(name).alias("tab"), F.col(key).alias("key"), "id",
                                (refers if name == "dm_orders" else F.lit("")).alias("refers"))
            for name, key in (("dm_restaurants", "restaurant_id"), ("dm_users", "user_id"), ("dm_orders", "order_key"))
        ]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query("delivery_fact", "deliveries couriers", """
    select order_id, order_ts, delivery_id, courier_id, address, delivery_ts, rate,
           cast(sum as double) as sum, cast(tip_sum as double) as tip_sum,
           case when courier_id in (select courier_id from deliveries
                                    where order_ts <= timestamp '1998-06-01')
                then 'known' else 'new' end as courier
    from deliveries where order_ts > (select max(order_ts) from deliveries
                                      where order_ts <= timestamp '1998-06-01')""")
def delivery_fact(v, spark):
    stg = v("deliveries")
    loaded = stg.filter(F.col("order_ts") <= _ts("1998-06-01"))
    dim = loaded.select("courier_id").distinct()
    fresh = restaurants.couriers(v("couriers"), dim).withColumn("courier", F.lit("new"))
    return (
        restaurants.deliveries(stg, loaded)
        .join(fresh.select("courier_id", "courier"), "courier_id", "left")
        .fillna("known", ["courier"])
    )


# --- files ----------------------------------------------------------------------------------


def _dated(v, spark, name: str, layout: str, tail: str):
    """Events in one folder per day, the day in the folder's name."""
    path = scratch_path(spark, name)
    folder = F.concat(F.lit(f"{name}_"), F.date_format("ts", layout), F.lit(tail))
    (
        v("events").select("event_id", "user_id", F.col("value").cast("string").alias("value"), "ts")
        .withColumn("snapshot", folder)
        .repartition("snapshot", F.col("event_id") % 2)
        .write.partitionBy("snapshot").option("sep", ";").option("header", True).csv(path)
    )
    schema = "event_id bigint, user_id bigint, value double, ts timestamp_ntz"
    return files.delimited(spark, path, schema).select("event_id", "user_id", "value", "_metadata")


@query("dated_snapshot", "", """
    select event_id, user_id, value, cast(cast(ts as date) as timestamp) as file_dt from events
    where cast(ts as date) = (select min(cast(ts as date)) from events
                              where cast(ts as date) > date '2024-01-09')""")
def dated_snapshot(v, spark):
    raw = _dated(v, spark, "terminals", "ddMMyyyy", ".csv")
    return files.next_dated_file(raw, "2024-01-09").drop("_metadata")


@query("newer_files", "", """
    select event_id, user_id, value, date_trunc('day', ts) as file_dt from events
    where date_trunc('day', ts) > timestamp '2024-01-20'""")
def newer_files(v, spark):
    raw = _dated(v, spark, "payment", "yyyy-MM-dd_00-00", ".csv")
    return files.newer_dated_files(raw, "2024-01-20 00:00:00").drop("_metadata")


@query("csv_scan", "", """
    select event_id, date_trunc('second', ts) as transaction_dt, 'c' || user_id as card_num,
           cast(cast(value as decimal(10,2)) as double) as amount from events""")
def csv_scan(v, spark):
    path = scratch_path(spark, "csv")
    text = F.col("value").cast("decimal(10,2)").cast("string")
    v("events").select(
        F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("dt"),
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("card"),
        F.translate(text, ".", ",").alias("amount"), "event_id",
    ).write.option("sep", "\t").csv(path)
    rows = files.delimited(
        spark, path, "transaction_dt timestamp_ntz, card_num string, amount string, event_id bigint",
        sep="\t", header=False, timestamp_format="dd.MM.yyyy HH:mm:ss",
    )
    return rows.withColumn("amount", decimal_comma("amount"))


@query("xml_waybills", "taxi_waybills", "select * from taxi_waybills")
def xml_waybills(v, spark):
    path = scratch_path(spark, "xml")

    def iso(c: str):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")

    v("taxi_waybills").select(
        F.col("waybill_num").alias("_number"), iso("issue_dt").alias("_issuedt"),
        F.col("car_plate_num").alias("car"),
        F.struct(F.col("driver_license").alias("license")).alias("driver"),
        F.struct(iso("work_start_dt").alias("start"), iso("work_end_dt").alias("stop"))
        .alias("period"),
    ).write.format("xml").option("rootTag", "waybills").option("rowTag", "waybill").save(path)
    return files.read_waybills(spark, path)


GROUP_LOG = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("user_id_from", T.IntegerType()), T.StructField("event", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()),
])


@query("load_rejects", "events_k", """
    select 'good' as kind, event_id, user_id, case when k < 50 then k end as user_id_from,
           event_type as event, date_trunc('second', ts) as datetime,
           cast(null as string) as rejected_data
    from events_k where event_type <> 'error'
    union all
    select 'rejected', null, null, null, null, null,
           event_id || ',user-' || user_id || ',' || case when k < 50 then '' || k else '' end
               || ',' || event_type || ',' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
    from events_k where event_type = 'error'""")
def load_rejects(v, spark):
    path = scratch_path(spark, "group_log")
    user = F.col("user_id").cast("string")
    line = F.concat_ws(
        ",", F.col("event_id").cast("string"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("user-"), user)).otherwise(user),
        F.when(F.col("k") < 50, F.col("k").cast("string")).otherwise(""),
        "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
    )
    v("events_k").select(line.alias("value")).write.text(path)
    good, rejected = files.load_with_rejects(spark, path, GROUP_LOG, header=False)
    return good.withColumn("kind", F.lit("good")).unionByName(
        rejected.select("rejected_data", F.lit("rejected").alias("kind")), allowMissingColumns=True
    )


@query("partition_window", "", """
    select event_id, user_id, cast(ts as date) as date from events
    where cast(ts as date) between date '2024-01-11' and date '2024-01-20'""")
def partition_window(v, spark):
    path = scratch_path(spark, "lake")
    rows = v("events").select("event_id", "user_id", F.to_date("ts").alias("date"))
    rows.repartition("date", F.col("event_id") % 2).write.partitionBy("date").parquet(path)
    return scans.read_days(spark, path, "2024-01-20", 10)


# --- sinks ----------------------------------------------------------------------------------


@query("period_replace", "order_log", """
    select extract(year from date_time) as sale_year, item_id, city_id, status,
           sum(quantity) as quantity, cast(sum(payment_amount) as double) as amount
    from order_log group by 1, 2, 3, 4""")
def period_replace(v, spark):
    sums = v("order_log").groupBy(
        "item_id", "city_id", "status", F.year("date_time").alias("sale_year")
    ).agg(F.sum("quantity").alias("quantity"), F.sum("payment_amount").alias("amount"))
    path = scratch_path(spark, "sales")
    # A first load with wrong figures for one year, which the rerun of that year puts right.
    wrong = F.when(F.col("sale_year") == 1997, F.col("quantity") + 1).otherwise(F.col("quantity"))
    # And a year of rows that should not be there, which the rerun of that year empties.
    stray = sums.filter(F.col("sale_year") == 1997).withColumn("sale_year", F.lit(1900))
    sinks.replace_period(sums.withColumn("quantity", wrong).unionByName(stray), path, "sale_year")
    sinks.replace_period(sums.filter(F.col("sale_year") == 1997), path, "sale_year", [1900, 1997])
    return sinks.read_table(spark, path, sums)


@query("dated_output", "", "select user_id, count(*) as n, max(ts) as last_ts from events group by 1")
def dated_output(v, spark):
    base = scratch_path(spark, "mart")
    mart = v("events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts")
    )
    for _ in range(2):
        path = sinks.dated_output(mart, base, "2024-01-31")
    return sinks.read_table(spark, path, mart)


@query("full_refresh", "", "select s_suppkey, s_name from supplier")
def full_refresh(v, spark):
    path = scratch_path(spark, "couriers")
    rows = v("supplier").select("s_suppkey", "s_name")
    sinks.full_refresh(rows.unionAll(rows), path)
    sinks.full_refresh(rows, path)
    return sinks.read_table(spark, path, rows)


@query("append_facts", "", "select event_id, user_id, value from events")
def append_facts(v, spark):
    path = scratch_path(spark, "facts")
    rows = v("events").select("event_id", "user_id", "value", "ts")
    early = rows.filter(F.col("ts") <= _ts("2024-01-15"))
    sinks.append_facts(early, path)
    late = scans.incremental(rows, "2024-01-15 00:00:00", update=None, create="ts")
    sinks.append_facts(late, path)
    return sinks.read_table(spark, path, rows).drop("ts")


@query("stage_cleanup", "order_log", """
    select uniq_id, customer_id, item_id, quantity, cast(payment_amount as double) as payment_amount,
           'shipped' as status
    from order_log""")
def stage_cleanup(v, spark):
    rows = v("order_log").select(
        "uniq_id", "customer_id", "item_id", "quantity", "payment_amount",
        F.xxhash64("uniq_id").alias("id"),
    )
    return scans.clean_stage(rows.unionAll(rows))


@query("sample_events", "", f"""
    select * from events
    where cast('0x' || substr(md5(cast(event_id as varchar) || '-7'), 1, 8) as bigint)
          < {int(0.05 * (1 << 32))}""")
def sample_events(v, spark):
    return scans.sample_events(v("events"), 0.05, seed=7)


# --- quality --------------------------------------------------------------------------------


@query("data_quality", "rfm_orders", """
    select 'orders' as "table", 'duplicate' as "check", 'order_id' as "column",
           count(*) - count(distinct order_id) as violations from rfm_orders
    union all select 'orders', 'null', 'user_id', count(*) filter (where user_id is null)
    from rfm_orders
    union all select 'orders', 'null', 'order_ts', count(*) filter (where order_ts is null)
    from rfm_orders
    union all select 'orders', 'check', 'payment >= 400000',
                     count(*) filter (where not payment >= 400000) from rfm_orders
    union all select 'lines', 'duplicate', 'l_orderkey,l_linenumber',
                     count(*) - count(distinct (l_orderkey, l_linenumber)) from lineitem
    union all select 'lines', 'check', 'quantity in 1..40',
                     count(*) filter (where not (l_quantity between 1 and 40)) from lineitem
    union all select 'customers', 'duplicate', 'c_custkey',
                     count(*) - count(distinct c_custkey) from customer
    union all select 'customers', 'type', 'c_name',
                     count(*) filter (where try_cast(c_name as int) is null) from customer""")
def quality(v, spark):
    return data_quality(
        {"orders": v("rfm_orders"), "lines": v("lineitem"), "customers": v("customer")},
        {
            "orders": Rules(
                ["order_id"], ["user_id", "order_ts"],
                checks={"payment >= 400000": F.col("payment") >= 400000},
            ),
            "lines": Rules(
                ["l_orderkey", "l_linenumber"],
                checks={"quantity in 1..40": F.col("l_quantity").between(1, 40)},
            ),
            "customers": Rules(["c_custkey"], types={"c_name": "int"}),
        },
    )
