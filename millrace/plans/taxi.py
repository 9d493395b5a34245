"""Facts and marts of the taxi warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import elapsed_us, strip_blanks
from millrace.operators.chunked import carried, time_chunk
from millrace.operators.joins import current, range_first, spread_join, unseen
from millrace.operators.scd2 import fill_surrogates, scd2_apply
from millrace.session import materialize


def ride_facts(
    rides: DataFrame, movement: DataFrame, waybills: DataFrame, fact: DataFrame | None = None,
    chunk: str = "hour",
) -> DataFrame:
    """Finished rides: event times pivoted from car movement, driver from the car's waybill."""
    moved = movement.groupBy("ride").agg(
        F.max("car_plate_num").alias("car_plate_num"),
        F.max(F.when(F.col("event") == "READY", F.col("dt"))).alias("ride_arrival_dt"),
        F.max(F.when(F.col("event") == "BEGIN", F.col("dt"))).alias("ride_start_dt"),
        F.max(F.when(F.col("event").isin("END", "CANCEL"), F.col("dt"))).alias("ride_end_dt"),
    ).filter(F.col("ride_end_dt").isNotNull())
    one_each = rides.groupBy("ride_id").agg(
        F.max("point_from").alias("point_from_txt"),
        F.max("point_to").alias("point_to_txt"),
        F.max("distance").alias("distance_val"),
        F.max("price").alias("price_amt"),
        F.max("client_phone").alias("client_phone_num"),
    )
    done = one_each.join(moved, one_each["ride_id"] == moved["ride"]).drop("ride")
    if fact is not None:
        done = unseen(done, fact, ["ride_id"])
    with_driver = range_first(
        done, waybills, ["car_plate_num"], "ride_arrival_dt", "work_start_dt", "work_end_dt",
        ["driver_pers_num"], "waybill_num", chunk,
    )
    return with_driver.select(
        "ride_id", "point_from_txt", "point_to_txt", "distance_val", "price_amt",
        "client_phone_num", "driver_pers_num", "car_plate_num", "ride_arrival_dt",
        "ride_start_dt", "ride_end_dt",
    )


def waybill_facts(stg: DataFrame, drivers: DataFrame, fact: DataFrame | None = None) -> DataFrame:
    """One row per new waybill with the personnel number of its current driver."""
    one_each = stg.groupBy("waybill_num").agg(
        *[
            F.max(c).alias(c)
            for c in ("driver_license", "car_plate_num", "work_start_dt", "work_end_dt", "issue_dt")
        ]
    )
    new = unseen(one_each, fact, ["waybill_num"]) if fact is not None else one_each
    who = current(drivers).select(
        "driver_license", F.col("personnel_num").alias("driver_pers_num")
    )
    return new.join(who, "driver_license", "left").select(
        "waybill_num", "driver_pers_num", "car_plate_num", "work_start_dt", "work_end_dt",
        "issue_dt",
    )


def payment_facts(stg: DataFrame, fact: DataFrame) -> DataFrame:
    """Distinct payments whose card and time are new."""
    rows = stg.select("card_num", "transaction_amt", "transaction_dt").distinct()
    return unseen(rows, fact, ["card_num", "transaction_dt"])


def _on(day: str | None, ts: str):
    return F.lit(True) if day is None else F.to_date(ts) == F.lit(day).cast("date")


def driver_payout(
    rides: DataFrame, drivers: DataFrame, report_date: str | None = None, service: float = 0.2,
    fuel_price: float = 47.26, fuel_per_100km: int = 7, wear_per_km: int = 5,
) -> DataFrame:
    """Pay per driver and day; rides are summed before the driver's data are joined."""
    fares = (
        rides.filter(F.col("ride_start_dt").isNotNull() & _on(report_date, "ride_arrival_dt"))
        .groupBy("driver_pers_num", F.to_date("ride_arrival_dt").alias("report_dt"))
        .agg(F.sum("price_amt").alias("fare"), F.sum("distance_val").alias("km"))
    )
    share = F.lit(str(round(1 - service, 4))).cast("decimal(5,4)")
    fuel = F.lit(str(round(fuel_price * fuel_per_100km / 100, 6))).cast("decimal(10,6)")
    amount = F.col("fare") * share - F.col("km") * fuel - F.col("km") * F.lit(wear_per_km)
    who = current(drivers).select(
        F.col("personnel_num").alias("driver_pers_num"), "last_name", "first_name",
        "middle_name", "card_num",
    )
    return fares.join(who, "driver_pers_num", "left").select(
        F.col("driver_pers_num").alias("personnel_num"), "last_name", "first_name",
        "middle_name", "card_num", amount.alias("amount"), "report_dt",
    )


def driver_speeding(
    rides: DataFrame, report_date: str | None = None, limit_kmh: int = 85, chunk: str = "hour"
) -> DataFrame:
    """Rides above the speed limit with the driver's running violation number, the first being 1."""
    us = elapsed_us("ride_start_dt", "ride_end_dt")
    speed = F.round(F.col("distance_val").cast("double") / F.col("_us") * 3.6e9)
    fast = (
        rides.filter(F.col("ride_start_dt").isNotNull())
        .select("driver_pers_num", "ride_id", "ride_arrival_dt", "distance_val", us.alias("_us"))
        .filter(F.col("_us") > 0)
        .withColumn("speed", speed)
        .filter(F.col("speed") > limit_kmh)
        .withColumn("_chunk", time_chunk("ride_arrival_dt", chunk))
        .drop("_us", "distance_val")
    )
    # The few violations are written once; numbering them reads them twice.
    fast = materialize(fast, "violations")
    # Rides without a driver share no history; they keep the number NULL.
    known = carried(
        fast.filter(F.col("driver_pers_num").isNotNull()), ["driver_pers_num"], "_chunk",
        ["ride_arrival_dt", "ride_id"], "ride_id", "violations_cnt", "count",
    )
    unknown = fast.filter(F.col("driver_pers_num").isNull())
    both = known.unionByName(unknown, allowMissingColumns=True)
    return both.filter(_on(report_date, "ride_arrival_dt")).select(
        F.col("driver_pers_num").alias("personnel_num"), F.col("ride_id").alias("ride"), "speed",
        "violations_cnt", F.to_date("ride_arrival_dt").alias("report_dt"),
    )


def driver_overtime(
    waybills: DataFrame, report_date: str | None = None, limit_hours: float = 8
) -> DataFrame:
    """Drivers whose waybills of a day add up to more than ``limit_hours``.

    The 24 hours run from the driver's first start of the day; work past their end is not counted.
    """
    day = waybills.filter(_on(report_date, "work_start_dt")).select(
        F.col("driver_pers_num").alias("personnel_num"),
        F.to_date("work_start_dt").alias("report_dt"), "work_start_dt", "work_end_dt",
    )
    keys = ["personnel_num", "report_dt"]
    first = day.groupBy(*keys).agg(F.min("work_start_dt").alias("start_work_dt"))
    end = F.least(F.col("work_end_dt"), F.col("start_work_dt") + F.expr("INTERVAL 24 HOURS"))
    return (
        day.filter(F.col("personnel_num").isNotNull())
        .transform(lambda d: spread_join(d, first, keys))
        .withColumn("_us", elapsed_us("work_start_dt", end))
        .groupBy(*keys, "start_work_dt")
        .agg((F.sum("_us") / F.lit(3_600_000_000)).alias("working_time"))
        .filter(F.col("working_time") > limit_hours)
        .select("personnel_num", "start_work_dt", "working_time", "report_dt")
    )


def client_profile(rides: DataFrame, payments: DataFrame, clients: DataFrame) -> DataFrame:
    """Rides, cancellations, money spent and debt per client phone."""
    began = F.col("ride_start_dt").isNotNull()
    use = rides.groupBy(F.col("client_phone_num").alias("phone_num")).agg(
        F.count_if(began).alias("rides_cnt"),
        F.count_if(~began).alias("cancelled_cnt"),
        F.sum(F.when(began, F.col("price_amt"))).alias("spent_amt"),
    )
    got = payments.groupBy("card_num").agg(F.sum("transaction_amt").alias("received"))
    cards = clients.select("phone_num", strip_blanks("card_num").alias("card_num")).distinct()
    paid = (
        cards.join(got, "card_num", "left")
        .groupBy("phone_num").agg(F.sum("received").alias("received"))
    )
    # A client without rides keeps NULL measures; one without payments owes all that was spent.
    return paid.join(use, "phone_num", "left").select(
        "phone_num", "rides_cnt", "cancelled_cnt", "spent_amt",
        (F.col("spent_amt") - F.coalesce("received", F.lit(0))).alias("debt_amt"),
    )


PROFILE = ["rides_cnt", "cancelled_cnt", "spent_amt", "debt_amt"]


def client_profile_history(
    history: DataFrame, profile: DataFrame, key_slice: DataFrame, now: str
) -> DataFrame:
    """Versions of computed client measures: the aggregate is the staged state at ``now``.

    A history with ``client_id`` gives new clients the next numbers, in the order of their phones.
    """
    kinds = {c: history.schema[c].dataType for c in PROFILE}
    stg = profile.select(
        "phone_num", *[F.col(c).cast(kinds[c]).alias(c) for c in PROFILE],
        F.lit(now).cast("timestamp_ntz").alias("create_dt"),
        F.lit(None).cast("timestamp_ntz").alias("update_dt"),
    )
    if "client_id" not in history.columns:
        return scd2_apply(history, stg, key_slice, now, "phone_num", PROFILE)
    versions = scd2_apply(history, stg, key_slice, now, "phone_num", PROFILE, carry=["client_id"])
    return fill_surrogates(versions, "phone_num", "client_id")
