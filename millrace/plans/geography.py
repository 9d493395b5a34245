"""Marts over located events.

Events hold event_id, event_type, lat, lon, date and the struct ``event`` with ``user``,
``message_from``, ``message_to``, ``subscription_channel`` and ``datetime``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.sphere import haversine_km
from millrace.functions.values import local_time
from millrace.operators.chunked import carried, runs, sized_chunk
from millrace.operators.joins import nearest, pairs_within
from millrace.session import materialize


def flat(events: DataFrame) -> DataFrame:
    """Event fields as columns; the acting user of a message is its sender."""
    return events.select(
        "event_id", "event_type", "lat", "lon",
        F.coalesce("event.message_from", "event.user").alias("user_id"),
        F.col("event.message_to").alias("message_to"),
        F.col("event.subscription_channel").alias("channel"),
        F.col("event.datetime").alias("ts"),
    )


def nearest_city(rows: DataFrame, cities: DataFrame, name: str = "zone_id") -> DataFrame:
    return nearest(rows, cities, "lat", "lon", "id", "lat", "lng", name)


def stays(events: DataFrame, cities: DataFrame, chunk: str = "hour") -> DataFrame:
    """Runs of a user's messages from one city: user_id, run, zone_id, run_start, run_end, run_rows."""
    sent = flat(events.filter(F.col("event_type") == "message")).select("user_id", "ts", "event_id", "lat", "lon")
    located = nearest_city(sized_chunk(sent, ["user_id"], ["ts", "event_id"], chunk), cities).drop("lat", "lon")
    return runs(located, ["user_id"], "_chunk", ["ts", "event_id"], "zone_id")


def journeys(events: DataFrame, cities: DataFrame, most: int = 10_000, chunk: str = "hour") -> DataFrame:
    """Journeys in pieces of at most ``most`` stays: user_id, piece (from 0) and the cities of its stays in order.

    For users of any length: the pieces of a user one after the other are the ``travel_array`` of ``user_geo``, and no
    task holds more than a piece.
    """
    city = cities.select(F.col("id").alias("zone_id"), "city")
    named = stays(events, cities, chunk).join(city, "zone_id", "left")
    return (
        named.groupBy("user_id", F.floor(F.col("run") / most).alias("piece"))
        .agg(F.array_sort(F.collect_list(F.struct("run", "city"))).alias("_stays"))
        .select("user_id", "piece", F.transform("_stays", lambda j: j["city"]).alias("cities"))
    )


def user_geo(
    events: DataFrame, cities: DataFrame, home_days: int = 27, chunk: str = "hour"
) -> DataFrame:
    """Current and home city, journeys and local time of users who sent messages.

    A journey is a run of messages from one city, so coming back counts again. One array holds all journeys of a user,
    as the mart wants it; ``journeys`` gives them in pieces.
    """
    visited = stays(events, cities, chunk)
    city = cities.select(F.col("id").alias("zone_id"), "city", "timezone")
    named = visited.join(city, "zone_id", "left")
    long_stay = F.datediff("run_end", "run_start") > home_days
    # One array per user is the mart's own result; it holds journeys, not messages.
    journey = F.array_sort(F.collect_list(F.struct("run", "city")))
    users = named.groupBy("user_id").agg(
        F.max_by("city", "run").alias("act_city"),
        F.max_by("city", F.when(long_stay, F.col("run"))).alias("home_city"),
        F.count(F.lit(1)).alias("travel_count"),
        journey.alias("_journey"),
        F.max_by(F.struct("run_end", "timezone"), "run").alias("_last"),
    )
    return users.select(
        "user_id", "act_city", "home_city", "travel_count",
        F.transform("_journey", lambda j: j["city"]).alias("travel_array"),
        local_time("_last.run_end", "_last.timezone").alias("local_time"),
    )


def zone_activity(events: DataFrame, cities: DataFrame, chunk: str = "hour") -> DataFrame:
    """Messages, reactions, subscriptions and registrations per zone, by week and month.

    Events other than messages stand where their user's last message was sent from; those before any
    message have no zone and are not counted. A user's first message is the registration.
    """
    rows = flat(events)
    is_message = F.col("event_type") == "message"
    # Only messages keep their coordinates, so only they are searched for.
    sent = rows.select(
        "user_id", "ts", "event_id", "event_type",
        F.when(is_message, F.col("lat")).alias("lat"), F.when(is_message, F.col("lon")).alias("lon"),
    )
    chunked = sized_chunk(sent, ["user_id"], ["ts", "event_id"], chunk)
    line = nearest_city(chunked, cities, "_zone").drop("lat", "lon")
    zoned = carried(
        line, ["user_id"], "_chunk", ["ts", "event_id"], "_zone", "zone_id", "last"
    ).filter(F.col("zone_id").isNotNull())
    kinds = {"message": "message", "reaction": "reaction", "subscription": "subscription"}
    told = F.col("event_type") == "message"
    # Per user first: a user has few rows then, the earliest of which is the registration.
    users = (
        zoned.filter(F.col("event_type").isin(*kinds.values()))
        .groupBy(
            "user_id", F.trunc("ts", "month").alias("month"), F.trunc("ts", "week").alias("week"),
            "zone_id",
        )
        .agg(
            *[F.count_if(F.col("event_type") == v).alias(k) for k, v in kinds.items()],
            F.min(F.when(told, F.struct("ts", "event_id"))).alias("_first"),
        )
    )
    rank = F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.col("_first").asc_nulls_last())
    )
    base = (
        users.withColumn("user", (rank == 1).cast("int"))
        .groupBy("month", "week", "zone_id")
        .agg(*[F.sum(k).alias(k) for k in (*kinds, "user")])
    )

    def total(period: str, k: str):
        return F.sum(k).over(Window.partitionBy(period, "zone_id"))

    # One row per zone, week and month is left, so the totals are plain windows.
    return base.select(
        "month", "week", "zone_id",
        *[total(p, k).alias(f"{p}_{k}") for p in ("week", "month") for k in (*kinds, "user")],
    )


def friend_candidates(
    events: DataFrame, cities: DataFrame, now: str, radius_km: float = 1.0, block: int = 2000, listed: int = 1000
) -> DataFrame:
    """Pairs of users in one channel, at most ``radius_km`` apart, who never wrote to each other.

    A user stands where the last message was sent from. Every pair of a crowded place is a row, as the mart asks for
    pairs, but no pair is shuffled: people bring along what decides on a pair and what its row shows. That is their
    home, the channels before the one they meet in (a pair counts in the first one it shares) and people nearby with
    whom they exchanged messages. Users with more than ``listed`` channels or such people bring no lists; their pairs
    are freed of repetitions and of those who wrote by a grouping and a join.
    """
    rows = flat(events)
    sent = F.col("event_type") == "message"
    last = materialize(
        rows.filter(sent & F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .groupBy("user_id")
        .agg(F.max_by(F.struct("lat", "lon", "ts"), F.struct("ts", "event_id")).alias("_l"))
        .select("user_id", "_l.*"), "last"
    )
    subscribed = (
        rows.filter((F.col("event_type") == "subscription") & F.col("channel").isNotNull())
        .select("channel", "user_id")
        .distinct()
    )
    wrote = (
        rows.filter((F.col("event_type") == "message") & F.col("message_to").isNotNull())
        .select(
            F.least("user_id", "message_to").alias("left_key"),
            F.greatest("user_id", "message_to").alias("right_key"),
        )
        .distinct()
    )
    home = nearest_city(last, cities).join(
        cities.select(F.col("id").alias("zone_id"), "timezone"), "zone_id", "left"
    ).select("user_id", F.struct("zone_id", local_time("ts", "timezone").alias("local_time")).alias("home"))
    channels = subscribed.groupBy("user_id").agg(F.count("*").alias("_n"), F.collect_set("channel").alias("_all"))
    users = (
        last.select("user_id", "lat", "lon")
        .join(home.hint("merge"), "user_id")
        .join(channels, "user_id")
        .join(_correspondents(wrote, last, radius_km), "user_id", "left")
        .withColumn("short", (F.col("_n") <= listed) & (F.coalesce(F.size("_others"), F.lit(0)) <= listed))
    )
    met = materialize(
        users.select(
            "user_id", "lat", "lon", "home", "short", F.when(F.col("short"), F.coalesce("_others", F.array())).alias("others"),
            F.when(F.col("short"), F.col("_all")).alias("_all"))
        .join(subscribed, "user_id")
        .withColumn("earlier", F.filter("_all", lambda c: c < F.col("channel")))
        .drop("_all"), "met"
    )
    near = pairs_within(
        met, "channel", "user_id", "lat", "lon", radius_km, block, ["home", "short", "earlier", "others"])
    both = F.col("left.short") & F.col("right.short")
    apart = ~(
        F.arrays_overlap("left.earlier", "right.earlier")
        | F.array_contains("left.others", F.col("right_key")) | F.array_contains("right.others", F.col("left_key"))
    )
    shown = ["left_key", "right_key", "left.home"]
    pairs = near.filter(F.when(both, apart)).select(*shown)
    if not met.filter(~F.col("short")).isEmpty():
        rest = near.filter(~both).select(*shown).distinct()
        pairs = pairs.unionByName(rest.join(wrote, ["left_key", "right_key"], "left_anti"))
    return pairs.select(
        F.col("left_key").alias("user_left"),
        F.col("right_key").alias("user_right"),
        "home.zone_id",
        F.lit(now).cast("timestamp_ntz").alias("processed_dttm"),
        "home.local_time",
    )


def _correspondents(wrote: DataFrame, last: DataFrame, radius_km: float) -> DataFrame:
    """user_id, _others: of each two users near each other who wrote, the one with fewer such others names the other."""
    def spot(side: str) -> DataFrame:
        # All users, who look small to the optimizer when stored, are not broadcast.
        return last.select(F.col("user_id").alias(f"{side}_key"), *[
            F.col(c).alias(f"{side}_{c}") for c in ("lat", "lon")]).hint("merge")

    # A hair more than the radius: the distance may be rounded otherwise where the pair is found the other way round.
    near = haversine_km("left_lat", "left_lon", "right_lat", "right_lon") <= radius_km * (1 + 1e-6) + 1e-6
    pairs = wrote.filter(F.col("left_key") < F.col("right_key")).join(spot("left"), "left_key").join(
        spot("right"), "right_key").filter(near).select("left_key", "right_key")
    counts = pairs.select(F.explode(F.array("left_key", "right_key")).alias("user_id")).groupBy("user_id").agg(
        F.count("*").alias("_n"))

    def count(side: str) -> DataFrame:
        return counts.select(F.col("user_id").alias(f"{side}_key"), F.col("_n").alias(f"_{side}"))

    fewer = F.col("_left") <= F.col("_right")
    return pairs.join(count("left"), "left_key").join(count("right"), "right_key").select(
        F.when(fewer, F.col("left_key")).otherwise(F.col("right_key")).alias("user_id"),
        F.when(fewer, F.col("right_key")).otherwise(F.col("left_key")).alias("_other"),
    ).groupBy("user_id").agg(F.collect_list("_other").alias("_others"))
