"""Change operators: histories, upserts, cursors, incremental scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import query
from millrace.operators import scd2, upsert
from millrace.sources import scans

NOW = "2024-03-01 00:00:00"
END = "timestamp '2999-12-31'"
GAP = "interval '15' second"
VIEWS = "dim_customer stg_customer slice_customer"
COLS = "id, segment, nation, effective_from, effective_to, deleted"
SPAN = ("effective_from", "effective_to")


def span_text(df):
    """Version bounds as text: the open end lies beyond the range of nanosecond timestamps."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in SPAN})


def span_sql(sql: str, cols: str) -> str:
    """The same for a SQL twin with the given other columns."""
    text = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" for c in SPAN)
    return f"select {cols}, {text} from ({sql}) versions"


def _oracle(insert: bool, change: bool, delete: bool) -> str:
    new = []
    if insert:
        new.append("o_id is null or (o_del = 1 and n_from > o_from)")
    if change:
        new.append(
            "(o_del = 0 and n_from > o_from and (o_seg is distinct from n_seg "
            "or o_nat is distinct from n_nat))"
        )
    takes = f"n_id is not null and coalesce({' or '.join(f'({x})' for x in new)}, false)" \
        if new else "false"
    gone = "not kept and (takes or o_del = 0)" if delete else "false"
    return span_sql(f"""
    with o as (select * from dim_customer where effective_to = {END}),
    j as (
        select coalesce(o.id, n.id) as id, o.id as o_id, o.segment as o_seg, o.nation as o_nat,
               o.effective_from as o_from, o.deleted as o_del, n.id as n_id, n.segment as n_seg,
               n.nation as n_nat, coalesce(n.update_dt, n.create_dt) as n_from,
               coalesce(o.id, n.id) in (select id from slice_customer) as kept
        from o full join stg_customer n on o.id = n.id),
    k as (select *, {takes} as takes from j),
    m as (select *, coalesce({gone}, false) as gone from k),
    f as (select *, case when gone then timestamp '{NOW}' - {GAP} else {END} end as last_end from m)
    select {COLS} from dim_customer where effective_to <> {END}
    union all
    select id, o_seg, o_nat, o_from, case when takes then n_from - {GAP} else last_end end, o_del
    from f where o_id is not null
    union all
    select id, n_seg, n_nat, n_from, last_end, 0 from f where takes
    union all
    select id, case when takes then n_seg else o_seg end, case when takes then n_nat else o_nat end,
           timestamp '{NOW}', {END}, 1 from f where gone""", "id, segment, nation, deleted")


ATTRS = ["segment", "nation"]


@query("scd2_insert", VIEWS, _oracle(True, False, False))
def scd2_insert(v, spark):
    return span_text(scd2.scd2_new(v("dim_customer"), v("stg_customer"), "id", ATTRS))


@query("scd2_change", VIEWS, _oracle(False, True, False))
def scd2_change(v, spark):
    return span_text(scd2.scd2_change(v("dim_customer"), v("stg_customer"), "id", ATTRS))


@query("scd2_delete", VIEWS, _oracle(False, False, True))
def scd2_delete(v, spark):
    return span_text(
        scd2.scd2_delete(v("dim_customer"), v("slice_customer"), NOW, "id", ATTRS)
    )


@query("scd2_apply", VIEWS, _oracle(True, True, True))
def scd2_apply(v, spark):
    return span_text(
        scd2.scd2_apply(
            v("dim_customer"), v("stg_customer"), v("slice_customer"), NOW, "id", ATTRS
        )
    )


@query("upsert_latest", "", """
    with t as (select c_custkey as id, c_mktsegment as note, timestamp '1970-01-01' as ts
               from customer),
    r as (select id, note, ts from (
              select o_custkey + 100 as id, o_orderpriority || '/' || o_orderstatus as note,
                     o_orderdate as ts, row_number() over (
                         partition by o_custkey
                         order by o_orderdate desc, o_orderpriority || '/' || o_orderstatus desc) rn
              from orders) x where rn = 1)
    select * from t where id not in (select id from r) union all select * from r""")
def upsert_latest(v, spark):
    target = v("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("note"),
        F.lit("1970-01-01").cast("timestamp_ntz").alias("ts"),
    )
    rows = v("orders").select(
        (F.col("o_custkey") + 100).alias("id"),
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("note"),
        F.col("o_orderdate").alias("ts"),
    )
    return upsert.upsert(target, rows, ["id"], "ts")


@query("insert_if_absent", "", """
    with t as (select distinct o_orderdate as day from orders
               where o_orderdate < timestamp '1996-01-01'),
    keyed as (select day, row_number() over (order by day) as id from t),
    new as (select distinct l_shipdate as day from lineitem
            where l_shipdate not in (select day from t))
    select day, id from keyed
    union all
    select day, row_number() over (order by day) + (select max(id) from keyed) from new""")
def insert_if_absent(v, spark):
    schema = "day timestamp_ntz, id bigint"
    early = v("orders").filter(
        F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    ).select(F.col("o_orderdate").alias("day"))
    nothing = spark.createDataFrame([], schema)
    target = upsert.insert_if_absent(nothing, early, ["day"], "id")
    rows = v("lineitem").select(F.col("l_shipdate").alias("day"))
    return target.unionByName(upsert.insert_if_absent(target, rows, ["day"], "id"))


@query("cursor_stop_first_bad", "", """
    with looked as (
        select o_orderkey, o_custkey, c_custkey, o_orderstatus
        from orders left join (select * from customer where c_acctbal > -900) c
             on o_custkey = c_custkey),
    bad as (select min(o_orderkey) as b from looked
            where o_orderstatus <> 'P' and c_custkey is null),
    good as (select o_orderkey, o_custkey from looked, bad
             where o_orderstatus <> 'P' and c_custkey is not null
                   and (b is null or o_orderkey < b))
    select 'row' as kind, o_orderkey, o_custkey from good
    union all
    select 'cursor', coalesce(max(o_orderkey), -1), null from good""")
def cursor_stop_first_bad(v, spark):
    known = v("customer").filter(F.col("c_acctbal") > -900).select("c_custkey")
    looked = v("orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(
        known, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    rows, cursor = upsert.resolve_until(
        looked, "o_orderkey", stop=F.col("c_custkey").isNull(),
        skip=F.col("o_orderstatus") == "P", start=-1,
    )
    return _with_cursor(rows.select("o_orderkey", "o_custkey"), cursor)


def _with_cursor(rows, cursor):
    tail = cursor.select(
        F.lit("cursor").alias("kind"), F.col("cursor").alias("o_orderkey"),
        F.lit(None).cast("bigint").alias("o_custkey"),
    )
    return rows.withColumn("kind", F.lit("row")).unionByName(tail)


@query("high_water", "", """
    select 'orders' as name, greatest(timestamp '1995-01-01', max(o_orderdate)) as cursor from orders
    union all select 'ships', max(l_shipdate) from lineitem
    union all select 'idle', timestamp '1995-06-01'""")
def high_water(v, spark):
    control = spark.createDataFrame(
        [("orders", "1995-01-01"), ("idle", "1995-06-01")], "name string, cursor string"
    ).withColumn("cursor", F.col("cursor").cast("timestamp_ntz"))
    control = upsert.advance(control, "orders", v("orders"), "o_orderdate")
    control = upsert.advance(control, "ships", v("lineitem"), "l_shipdate")
    none = v("orders").filter(F.col("o_orderdate") > F.lit("2100-01-01").cast("timestamp_ntz"))
    return upsert.advance(control, "idle", none, "o_orderdate")


@query("incremental_scan", "", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
    where coalesce(case when l_returnflag = 'R' then l_shipdate + interval '365' day end, l_shipdate)
          > timestamp '1997-01-01'""")
def incremental_scan(v, spark):
    late = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate") + F.expr("INTERVAL 365 DAYS"))
    rows = v("lineitem").withColumns({"create_dt": F.col("l_shipdate"), "update_dt": late})
    return scans.incremental(rows, "1997-01-01 00:00:00").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )


@query("cursor_batch", "", """
    with b as (select o_orderkey, o_custkey from orders
               where o_orderkey > 200 and o_orderdate > timestamp '1995-01-01'
               order by o_orderkey limit 500)
    select 'row' as kind, o_orderkey, o_custkey from b
    union all select 'cursor', coalesce(max(o_orderkey), 200), null from b""")
def cursor_batch(v, spark):
    rows, cursor = scans.cursor_batch(
        v("orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey", 200, 500,
        ts="o_orderdate", since="1995-01-01 00:00:00",
    )
    return _with_cursor(rows.select("o_orderkey", "o_custkey"), cursor)
