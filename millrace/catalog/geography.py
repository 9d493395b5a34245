"""Located events: nearest city, user, zone and friend marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.base import query
from millrace.plans import geography


def dist(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0 * asin(sqrt(power(sin((radians({lat2}) - radians({lat1})) / 2), 2) "
        f"+ cos(radians({lat1})) * cos(radians({lat2})) "
        f"* power(sin((radians({lon2}) - radians({lon1})) / 2), 2)))"
    )


LOCATED = f"""
    near as (
        select event_id, user_id, ts, event_type, lat, lon, message_to, channel, zone_id
        from (select e.*, c.id as zone_id, row_number() over (
                         partition by event_id
                         order by {dist('e.lat', 'e.lon', 'c.lat', 'c.lng')}, c.id) as rn
              from geo_events e cross join cities c) x
        where rn = 1)"""


def nested(v):
    """Events in the lake's form, with the acting fields inside a struct."""
    e = v("geo_events")
    is_message = F.col("event_type") == "message"
    return e.select(
        "event_id", "event_type", "lat", "lon", "date",
        F.struct(
            F.when(is_message, F.col("user_id")).alias("message_from"),
            "message_to",
            F.when(~is_message, F.col("user_id")).alias("user"),
            F.col("channel").alias("subscription_channel"),
            F.col("ts").alias("datetime"),
        ).alias("event"),
    )


@query("nearest_city", "geo_events cities", f"""
    with {LOCATED} select event_id, user_id, n.zone_id, c.city from near n
    join cities c on c.id = n.zone_id""")
def nearest_city(v, spark):
    cities = v("cities")
    rows = geography.nearest_city(geography.flat(nested(v)), cities)
    names = cities.select(F.col("id").alias("zone_id"), "city")
    return rows.join(names, "zone_id").select("event_id", "user_id", "zone_id", "city")


@query("user_geo", "geo_events cities", f"""
    with {LOCATED},
    steps as (
        select *, case when lag(zone_id) over w is distinct from zone_id then 1 else 0 end as turn
        from near where event_type = 'message'
        window w as (partition by user_id order by ts, event_id)),
    numbered as (
        select *, sum(turn) over (partition by user_id order by ts, event_id) as run from steps),
    stays as (
        select user_id, run, any_value(zone_id) as zone_id, min(ts) as t0, max(ts) as t1
        from numbered group by user_id, run),
    named as (
        select s.*, c.city, c.timezone,
               cast(t1 as date) - cast(t0 as date) as days
        from stays s join cities c on c.id = s.zone_id)
    select user_id, arg_max(city, run) as act_city,
           arg_max(city, run) filter (where days > 7) as home_city, count(*) as travel_count,
           string_agg(city, '>' order by run) as travel_array,
           (arg_max(t1, run) at time zone 'UTC') at time zone arg_max(timezone, run) as local_time
    from named group by user_id""")
def user_geo(v, spark):
    mart = geography.user_geo(nested(v), v("cities"), home_days=7)
    return mart.withColumn("travel_array", F.array_join("travel_array", ">"))


@query("zone_activity", "geo_events cities", f"""
    with {LOCATED},
    zoned as (
        select *, last_value(case when event_type = 'message' then zone_id end ignore nulls) over (
                   partition by user_id order by ts, event_id
                   rows between unbounded preceding and current row) as zone
        from near),
    firsts as (
        select arg_min(ts, (ts, event_id)) as ts, arg_min(zone, (ts, event_id)) as zone
        from zoned where event_type = 'message' group by user_id),
    base as (
        select ts, zone, event_type from zoned where zone is not null
             and event_type in ('message', 'reaction', 'subscription')
        union all select ts, zone, 'registration' from firsts),
    dated as (
        select cast(date_trunc('month', ts) as date) as month,
               cast(date_trunc('week', ts) as date) as week, zone as zone_id, event_type from base),
    counted as (
        select month, week, zone_id,
               {', '.join(
                   f"count(*) filter (where event_type = '{t}') as {c}"
                   for t, c in (('message', 'm'), ('reaction', 'r'), ('subscription', 's'),
                                ('registration', 'u')))}
        from dated group by month, week, zone_id)
    select month, week, zone_id,
           {', '.join(
               f"sum({c}) over (partition by {p}, zone_id) as {p}_{n}"
               for p in ('week', 'month')
               for n, c in (('message', 'm'), ('reaction', 'r'), ('subscription', 's'),
                            ('user', 'u')))}
    from counted""")
def zone_activity(v, spark):
    return geography.zone_activity(nested(v), v("cities"))


@query("friend_candidates", "geo_events cities", f"""
    with {LOCATED},
    last_ as (
        select user_id, lat, lon, ts, zone_id from (
            select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
            from near where event_type = 'message') x where rn = 1),
    subs as (select distinct channel, user_id from near where event_type = 'subscription'),
    pairs as (
        select distinct a.user_id as user_left, b.user_id as user_right
        from subs a join subs b on a.channel = b.channel and a.user_id < b.user_id
             join last_ la on la.user_id = a.user_id join last_ lb on lb.user_id = b.user_id
        where {dist('la.lat', 'la.lon', 'lb.lat', 'lb.lon')} <= 1),
    wrote as (
        select distinct least(user_id, message_to) as l, greatest(user_id, message_to) as r
        from near where event_type = 'message')
    select user_left, user_right, l.zone_id, timestamp '2024-02-01' as processed_dttm,
           (l.ts at time zone 'UTC') at time zone c.timezone as local_time
    from pairs p join last_ l on l.user_id = p.user_left join cities c on c.id = l.zone_id
    where not exists (select 1 from wrote where wrote.l = user_left and wrote.r = user_right)""")
def friend_candidates(v, spark):
    return geography.friend_candidates(nested(v), v("cities"), "2024-02-01 00:00:00")
