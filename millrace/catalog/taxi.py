"""Taxi: facts and driver marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import query
from millrace.catalog.history import span_sql, span_text
from millrace.plans import taxi
from millrace.session import materialize

WAYBILLS = """
    wb as (
        select waybill_num, max(personnel_num) as driver_pers_num,
               max(car_plate_num) as car_plate_num, max(work_start_dt) as work_start_dt,
               max(work_end_dt) as work_end_dt, max(issue_dt) as issue_dt
        from taxi_waybills w left join taxi_drivers d on w.driver_license = d.driver_license
             and d.effective_to = timestamp '2999-12-31'
        group by waybill_num)"""
RIDES = """
    moved as (
        select ride, max(car_plate_num) as car_plate_num,
               max(case when event = 'READY' then dt end) as ride_arrival_dt,
               max(case when event = 'BEGIN' then dt end) as ride_start_dt,
               max(case when event in ('END', 'CANCEL') then dt end) as ride_end_dt
        from taxi_movement group by ride),
    rf as (
        select ride_id, point_from as point_from_txt, point_to as point_to_txt,
               distance as distance_val, price as price_amt, client_phone as client_phone_num,
               driver_pers_num, r.car_plate_num, ride_arrival_dt, ride_start_dt, ride_end_dt
        from (
            select *, row_number() over (
                       partition by ride_id order by work_start_dt, waybill_num) as rk
            from (select r.*, m.* exclude (ride) from taxi_rides r join moved m
                       on r.ride_id = m.ride where ride_end_dt is not null) x
                 left join (select waybill_num, driver_pers_num, car_plate_num as plate,
                                   work_start_dt, work_end_dt from wb) w
                 on x.car_plate_num = plate
                    and ride_arrival_dt between work_start_dt and work_end_dt) r
        where rk = 1)"""
VIEWS = "taxi_waybills taxi_drivers taxi_movement taxi_rides"
DOUBLE_RIDES = (
    "ride_id, point_from_txt, point_to_txt, cast(distance_val as double) as distance_val, "
    "cast(price_amt as double) as price_amt, client_phone_num, driver_pers_num, car_plate_num, "
    "ride_arrival_dt, ride_start_dt, ride_end_dt"
)


def _waybills(v):
    return taxi.waybill_facts(v("taxi_waybills"), v("taxi_drivers"))


def _rides(v):
    return taxi.ride_facts(v("taxi_rides"), v("taxi_movement"), _waybills(v))


@query("waybill_facts", VIEWS, f"with {WAYBILLS} select * from wb "
       "where issue_dt >= timestamp '2024-01-05'")
def waybill_facts(v, spark):
    stg = v("taxi_waybills")
    loaded = stg.filter(F.col("issue_dt") < F.lit("2024-01-05").cast("timestamp_ntz"))
    return taxi.waybill_facts(stg, v("taxi_drivers"), loaded.select("waybill_num"))


@query("payment_facts", "taxi_payments", """
    select distinct card_num, cast(transaction_amt as double) as transaction_amt, transaction_dt
    from taxi_payments where transaction_dt >= timestamp '2024-01-05'""")
def payment_facts(v, spark):
    stg = v("taxi_payments")
    loaded = stg.filter(F.col("transaction_dt") < F.lit("2024-01-05").cast("timestamp_ntz"))
    return taxi.payment_facts(stg.unionAll(stg), loaded)


@query("ride_facts", VIEWS, f"with {WAYBILLS}, {RIDES} select {DOUBLE_RIDES} from rf")
def ride_facts(v, spark):
    return _rides(v)


@query("driver_payout", VIEWS, f"""
    with {WAYBILLS}, {RIDES},
    fares as (
        select driver_pers_num, cast(ride_arrival_dt as date) as report_dt,
               sum(price_amt) as fare, sum(distance_val) as km
        from rf where ride_start_dt is not null group by 1, 2)
    select driver_pers_num as personnel_num, last_name, first_name, middle_name, card_num,
           cast(fare * cast(0.8 as decimal(5,4)) - km * cast(3.3082 as decimal(10,6)) - km * 5
                as double) as amount, report_dt
    from fares left join taxi_drivers d on personnel_num = driver_pers_num
         and d.effective_to = timestamp '2999-12-31'""")
def driver_payout(v, spark):
    return taxi.driver_payout(_rides(v), v("taxi_drivers"))


@query("driver_speeding", VIEWS, f"""
    with {WAYBILLS}, {RIDES},
    fast as (
        select driver_pers_num as personnel_num, ride_id as ride, ride_arrival_dt,
               round(cast(distance_val as double)
                     / (epoch_us(ride_end_dt) - epoch_us(ride_start_dt)) * 3.6e9) as speed
        from rf where ride_start_dt is not null
             and epoch_us(ride_end_dt) > epoch_us(ride_start_dt))
    select personnel_num, ride, speed,
           case when personnel_num is not null then
                count(*) over (partition by personnel_num order by ride_arrival_dt, ride) end
               as violations_cnt, cast(ride_arrival_dt as date) as report_dt
    from fast where speed > 85""")
def driver_speeding(v, spark):
    return taxi.driver_speeding(_rides(v))


@query("driver_overtime", VIEWS, f"""
    with {WAYBILLS},
    f as (
        select driver_pers_num, work_start_dt, work_end_dt, cast(work_start_dt as date) as d,
               min(work_start_dt) over (
                   partition by driver_pers_num, cast(work_start_dt as date)) as first_start
        from wb where driver_pers_num is not null)
    select driver_pers_num as personnel_num, first_start as start_work_dt,
           cast(sum(epoch_us(least(work_end_dt, first_start + interval '24' hour))
                    - epoch_us(work_start_dt)) as double) / 3600000000 as working_time,
           d as report_dt
    from f group by 1, 2, 4
    having sum(epoch_us(least(work_end_dt, first_start + interval '24' hour))
               - epoch_us(work_start_dt)) > 8 * 3600000000""")
def driver_overtime(v, spark):
    return taxi.driver_overtime(_waybills(v))


PROFILE = """
    use as (
        select client_phone_num, count(ride_start_dt) as rides_cnt,
               count(case when ride_start_dt is null then 1 end) as cancelled_cnt,
               sum(case when ride_start_dt is not null then price_amt end) as spent_amt
        from rf group by client_phone_num),
    pay as (
        select c.phone_num, sum(transaction_amt) as received
        from taxi_clients c left join taxi_payments p on replace(c.card_num, ' ', '') = p.card_num
        group by c.phone_num),
    profile as (
        select p.phone_num, rides_cnt, cancelled_cnt, spent_amt,
               spent_amt - coalesce(received, 0) as debt_amt
        from pay p left join use u on p.phone_num = u.client_phone_num)"""


@query("client_profile", VIEWS + " taxi_clients taxi_payments", f"""
    with {WAYBILLS}, {RIDES}, {PROFILE}
    select phone_num, rides_cnt, cancelled_cnt, cast(spent_amt as double) as spent_amt,
           cast(debt_amt as double) as debt_amt from profile""")
def client_profile(v, spark):
    return taxi.client_profile(_rides(v), v("taxi_payments"), v("taxi_clients"))


@query("client_profile_history", VIEWS + " taxi_clients taxi_payments", span_sql(f"""
    with {WAYBILLS}, {RIDES}, {PROFILE},
    early as (
        select c.phone_num, c.client_id, count(ride_start_dt) as rides_cnt,
               count(case when ride_id is not null and ride_start_dt is null then 1 end)
                   as cancelled_cnt,
               sum(case when ride_start_dt is not null then price_amt end) as spent_amt
        from taxi_clients c join (select * from rf where ride_arrival_dt < timestamp '2024-01-20') r
             on c.phone_num = r.client_phone_num
        group by 1, 2),
    old as (
        select e.*, e.spent_amt - coalesce(received, 0) as debt_amt
        from early e join pay p on e.phone_num = p.phone_num),
    both_ as (
        select coalesce(o.phone_num, n.phone_num) as phone_num, o.client_id,
               o.phone_num is not null as has_old,
               o.rides_cnt as r0, o.cancelled_cnt as c0, o.spent_amt as s0, o.debt_amt as d0,
               n.rides_cnt as r1, n.cancelled_cnt as c1, n.spent_amt as s1, n.debt_amt as d1,
               o.phone_num is null or o.rides_cnt is distinct from n.rides_cnt
                   or o.cancelled_cnt is distinct from n.cancelled_cnt
                   or o.spent_amt is distinct from n.spent_amt
                   or o.debt_amt is distinct from n.debt_amt as fresh
        from old o full join profile n on o.phone_num = n.phone_num),
    new_ as (
        select phone_num, row_number() over (order by phone_num)
               + (select coalesce(max(client_id), 0) from old) as new_id
        from both_ where not has_old)
    select phone_num, r0 as rides_cnt, c0 as cancelled_cnt, cast(s0 as double) as spent_amt,
           cast(d0 as double) as debt_amt, client_id, timestamp '2024-01-20' as effective_from,
           case when fresh then timestamp '2024-02-01' - interval '15' second
                else timestamp '2999-12-31' end as effective_to, 0 as deleted
    from both_ where has_old
    union all
    select phone_num, r1, c1, cast(s1 as double), cast(d1 as double), coalesce(client_id, new_id),
           timestamp '2024-02-01', timestamp '2999-12-31', 0
    from both_ left join new_ using (phone_num) where fresh""",
    "phone_num, rides_cnt, cancelled_cnt, spent_amt, debt_amt, client_id, deleted"))
def client_profile_history(v, spark):
    # Both profiles start from the same rides.
    rides, payments, clients = materialize(_rides(v), "rides"), v("taxi_payments"), v("taxi_clients")
    early = rides.filter(F.col("ride_arrival_dt") < F.lit("2024-01-20").cast("timestamp_ntz"))
    old = taxi.client_profile(early, payments, clients).filter(F.col("rides_cnt").isNotNull())
    history = old.join(clients.select("phone_num", "client_id"), "phone_num").withColumns(
        {
            "effective_from": F.lit("2024-01-20").cast("timestamp_ntz"),
            "effective_to": F.lit("2999-12-31").cast("timestamp_ntz"),
            "deleted": F.lit(0),
        }
    )
    now = taxi.client_profile(rides, payments, clients)
    return span_text(
        taxi.client_profile_history(
            history, now, clients.select("phone_num"), "2024-02-01 00:00:00"
        )
    )
