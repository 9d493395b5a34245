"""Marts on small hand-made tables, a positive and a negative case per decision."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import bank, geography, groups, loyalty, restaurants, sales, taxi, turnover

END = "2999-12-31 00:00:00"


def frame(spark, schema, rows, *stamps):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def people(spark):
    return frame(
        spark,
        "card_num string, client_id int, fio string, passport string, passport_valid_to string, "
        "phone string, valid_to string",
        [("c1", 1, "A B", "p1", "2024-01-10", "1", "2024-01-20"),
         ("c2", 2, "A B", "p2", None, "2", None),
         ("c1b", 1, "A B", "p1", "2024-01-10", "1", "2024-01-20")],
    ).withColumns({c: F.col(c).cast("date") for c in ("passport_valid_to", "valid_to")})


def txns(spark, rows):
    return frame(
        spark, "trans_id int, trans_date string, card_num string, amt double, oper_result string, "
        "terminal string", rows, "trans_date",
    )


def when(df):
    return sorted(str(r["event_dt"]) for r in df.collect())


def test_passport_and_contract(spark):
    t = txns(spark, [
        (1, "2024-01-10 10:00:00", "c1", 1.0, "SUCCESS", "t"),   # last valid day
        (2, "2024-01-11 10:00:00", "c1", 1.0, "SUCCESS", "t"),   # expired
        (3, "2024-01-05 10:00:00", "c2", 1.0, "SUCCESS", "t"),   # listed, before the entry
        (4, "2024-01-07 10:00:00", "c2", 1.0, "SUCCESS", "t"),   # listed, after it
        (5, "2024-01-21 10:00:00", "c1", 1.0, "SUCCESS", "t"),
    ])
    black = frame(
        spark, "passport string, entry_dt string",
        [("p2", "2024-01-06"), ("p2", "2024-01-09")], "entry_dt",
    )
    got = bank.fraud_passport(t, people(spark), black)
    assert when(got) == ["2024-01-07 10:00:00", "2024-01-11 10:00:00", "2024-01-21 10:00:00"]
    assert when(bank.fraud_passport(t, people(spark), black, "2024-01-12")) == ["2024-01-21 10:00:00"]
    assert when(bank.fraud_contract(t, people(spark))) == ["2024-01-21 10:00:00"]


def test_city_hop(spark):
    terms = frame(
        spark, "terminal string, terminal_city string, effective_to string",
        [("t1", "X", END), ("t2", "Y", END), ("t1", "Y", "2020-01-01 00:00:00")], "effective_to",
    )
    t = txns(spark, [
        (1, "2024-01-01 10:00:00", "c1", 1.0, "S", "t1"),
        (2, "2024-01-01 10:59:00", "c1b", 1.0, "S", "t2"),   # 59 minutes, other card, same client
        (3, "2024-01-01 12:00:00", "c1", 1.0, "S", "t1"),    # 61 minutes
        (4, "2024-01-01 12:01:00", "c1", 1.0, "S", "t1"),    # same city
        (5, "2024-01-01 12:02:00", "c2", 1.0, "S", "t2"),    # another client of the same name
        (6, "2024-01-01 23:50:00", "c1", 1.0, "S", "t1"),    # across midnight
        (7, "2024-01-02 00:10:00", "c1", 1.0, "S", "t2"),
    ])
    got = bank.fraud_city_hop(t, people(spark), terms)
    assert when(got) == ["2024-01-01 10:00:00", "2024-01-01 23:50:00"]


def test_amount_probe(spark):
    def chain(start, card, minutes, amounts, results):
        begin = dt.datetime.fromisoformat(start)
        return [
            (hash((start, i)) % 10**6, str(begin + dt.timedelta(minutes=m)), card, a, r, "t")
            for i, (m, a, r) in enumerate(zip(minutes, amounts, results))
        ]

    reject = ["REJECT"] * 3 + ["SUCCESS"]
    rows = chain("2024-01-01 10:00:00", "c1", [0, 5, 10, 20], [9.0, 8.0, 7.0, 6.0], reject)
    rows += chain("2024-01-02 10:00:00", "c1", [0, 5, 10, 21], [9.0, 8.0, 7.0, 6.0], reject)
    rows += chain("2024-01-03 10:00:00", "c1", [0, 5, 10, 15], [9.0, 8.0, 8.0, 6.0], reject)
    rows += chain("2024-01-04 10:00:00", "c1", [0, 5, 10, 15], [9.0, 8.0, 7.0, 6.0],
                  ["REJECT", "SUCCESS", "REJECT", "SUCCESS"])
    rows += chain("2024-01-05 23:55:00", "c1", [0, 4, 8, 12], [9.0, 8.0, 7.0, 6.0], reject)
    got = bank.fraud_amount_probe(txns(spark, rows), people(spark))
    assert when(got) == ["2024-01-01 10:20:00", "2024-01-06 00:07:00"]


def rides(spark, rows):
    return frame(
        spark, "ride_id int, driver_pers_num int, distance_val double, price_amt double, "
        "client_phone_num string, ride_arrival_dt string, ride_start_dt string, ride_end_dt string",
        rows, "ride_arrival_dt", "ride_start_dt", "ride_end_dt",
    )


def test_ride_facts_and_waybills(spark):
    drivers = frame(
        spark, "driver_license string, personnel_num int, effective_to string",
        [("L1", 1, END), ("L2", 2, END), ("L1", 9, "2020-01-01 00:00:00")], "effective_to",
    )
    bills = frame(
        spark, "waybill_num string, driver_license string, car_plate_num string, "
        "work_start_dt string, work_end_dt string, issue_dt string",
        [("w1", "L1", "car", "2024-01-01 08:00:00", "2024-01-01 12:00:00", "2024-01-01"),
         ("w1", "L1", "car", "2024-01-01 08:00:00", "2024-01-01 12:00:00", "2024-01-01"),
         ("w2", "L2", "car", "2024-01-01 11:00:00", "2024-01-01 15:00:00", "2024-01-01"),
         ("w3", "L7", "car", "2024-01-02 08:00:00", "2024-01-02 12:00:00", "2024-01-02")],
        "work_start_dt", "work_end_dt", "issue_dt",
    )
    facts = taxi.waybill_facts(bills, drivers)
    assert sorted((r["waybill_num"], r["driver_pers_num"]) for r in facts.collect()) == [
        ("w1", 1), ("w2", 2), ("w3", None)
    ]
    assert taxi.waybill_facts(bills, drivers, facts).count() == 0
    moves, say = [], []
    for ride, at, end in [(1, "08:00:00", "END"), (2, "12:00:00", "END"), (3, "12:00:01", "CANCEL"),
                          (4, "15:00:01", "END"), (5, "09:00:00", None)]:
        say.append((ride, "a", "b", 1.0, 2.0, "p"))
        moves.append((ride, "car", "READY", f"2024-01-01 {at}"))
        if end == "END":
            moves.append((ride, "car", "BEGIN", f"2024-01-01 {at}"))
        if end:
            moves.append((ride, "car", end, "2024-01-01 20:00:00"))
    movement = frame(spark, "ride int, car_plate_num string, event string, dt string", moves, "dt")
    ride = spark.createDataFrame(
        say, "ride_id int, point_from string, point_to string, distance double, price double, "
        "client_phone string",
    )
    got = taxi.ride_facts(ride, movement, facts)
    assert sorted(
        (r["ride_id"], r["driver_pers_num"], r["ride_start_dt"] is None) for r in got.collect()
    ) == [(1, 1, False), (2, 1, False), (3, 2, True), (4, None, False)]


def test_driver_marts(spark):
    day = "2024-01-01 "
    r = rides(spark, [
        (1, 1, 100.0, 50.0, "p", day + "10:00:00", day + "10:00:00", day + "11:00:00"),  # 100 km/h
        (2, 1, 85.0, 50.0, "p", day + "12:00:00", day + "12:00:00", day + "13:00:00"),   # 85 km/h
        (3, 1, 90.0, 50.0, "p", "2024-01-02 10:00:00", "2024-01-02 10:00:00", "2024-01-02 11:00:00"),
        (4, 1, 90.0, 50.0, "p", day + "14:00:00", None, day + "15:00:00"),               # cancelled
        (5, 1, 90.0, 50.0, "p", day + "16:00:00", day + "16:00:00", "2024-01-02 16:30:00"),  # > a day
    ])
    fast = taxi.driver_speeding(r).collect()
    assert sorted((x["ride"], x["violations_cnt"]) for x in fast) == [(1, 1), (3, 2)]
    only = taxi.driver_speeding(r, "2024-01-02").collect()
    assert [(x["ride"], x["violations_cnt"]) for x in only] == [(3, 2)]
    drivers = frame(
        spark, "personnel_num int, last_name string, first_name string, middle_name string, "
        "card_num string, effective_to string",
        [(1, "L", "F", None, "k", END), (1, "old", "F", None, "k", "2020-01-01 00:00:00")],
        "effective_to",
    )
    paid = taxi.driver_payout(
        r.withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price_amt", "distance_val")}),
        drivers, "2024-01-02",
    ).collect()
    assert len(paid) == 1 and paid[0]["last_name"] == "L"
    assert abs(float(paid[0]["amount"]) - (50 * 0.8 - 47.26 * 7 * 90 / 100 - 5 * 90)) < 1e-9
    bills = frame(
        spark, "driver_pers_num int, work_start_dt string, work_end_dt string",
        [(1, day + "06:00:00", day + "12:00:00"), (1, day + "20:00:00", "2024-01-02 09:00:00"),
         (2, day + "08:00:00", day + "16:00:00")],
        "work_start_dt", "work_end_dt",
    )
    over = taxi.driver_overtime(bills).collect()
    assert [(x["personnel_num"], x["working_time"]) for x in over] == [(1, 16.0)]


def test_client_profile(spark):
    day = "2024-01-01 "
    r = rides(spark, [
        (1, 1, 1.0, 50.0, "p", day + "10:00:00", day + "10:00:00", day + "11:00:00"),
        (2, 1, 1.0, 30.0, "p", day + "12:00:00", None, day + "13:00:00"),
        (3, 1, 1.0, 20.0, "q", day + "12:00:00", day + "12:00:00", day + "13:00:00"),
    ])
    pay = spark.createDataFrame([("11", 10.0), ("11", 5.0)], "card_num string, transaction_amt double")
    clients = spark.createDataFrame(
        [("p", "1 1"), ("p", "2 2"), ("q", "33"), ("idle", "44")], "phone_num string, card_num string"
    )
    got = {x["phone_num"]: tuple(x)[1:] for x in taxi.client_profile(r, pay, clients).collect()}
    assert got == {"p": (1, 1, 50.0, 35.0), "q": (1, 0, 20.0, 20.0), "idle": (None,) * 4}


def test_rfm_and_latest_status(spark):
    users = spark.range(1, 4).select(F.col("id").alias("user_id"))
    orders = frame(
        spark, "order_id int, user_id int, order_ts string, payment double, status string",
        [(1, 1, "2023-01-01", 5.0, "Closed"), (2, 2, "2021-01-01", 9.0, "Closed"),
         (3, 2, "2023-02-01", 9.0, "Open")], "order_ts",
    )
    got = {r["user_id"]: tuple(r)[1:] for r in loyalty.rfm_segments(users, orders, "2022-01-01").collect()}
    # Fewer users than tiles: users 2 and 3 have no closed order in the period and rank lowest.
    assert got == {2: (1, 1, 1), 3: (2, 2, 2), 1: (3, 3, 3)}
    log = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (1, "c", 2)], "order_id int, status string, dttm int"
    )
    last = loyalty.latest_status(orders.select("order_id", "user_id"), log, by=("dttm", "status"))
    assert [tuple(r) for r in last.collect()] == [(1, 1, "c")]


def test_retention_and_new_members(spark):
    log = frame(
        spark, "date_time string, customer_id int, city_id int, item_id int, payment_amount double, "
        "status string",
        [("2021-01-01", 1, 1, 1, 5.0, "shipped"), ("2020-12-31", 1, 1, 1, 5.0, "shipped"),
         ("2021-01-01", 2, 1, 1, 7.0, "shipped"), ("2021-01-01", 3, 1, 1, 7.0, "refunded"),
         ("2021-12-31", 2, 1, 1, 7.0, "shipped")], "date_time",
    )
    got = {
        (r["period_year"], r["period_id"]): (
            r["new_customers_count"], r["returning_customers_count"], r["refunded_customer_count"],
            r["new_customers_revenue"], r["returning_customers_revenue"])
        for r in sales.retention(log).collect()
    }
    assert got == {(2020, 53): (1, 1, 1, 7.0, 10.0), (2021, 52): (1, 0, 0, 7.0, None)}
    dim = spark.createDataFrame([(1,)], "customer_id int")
    new = sales.new_members(log, dim, "customer_id", [], ["city_id"])
    assert sorted(tuple(r) for r in new.collect()) == [(2, 1), (3, 1)]


def test_courier_ledger_bands(spark):
    rows = []
    for courier, rates in ((1, [3, 4]), (2, [4, 4]), (3, [4, 5]), (4, [5] * 9 + [4]), (5, [5, 5])):
        for i, rate in enumerate(rates):
            rows.append((f"{courier}-{i}", "2024-01-05", courier, rate, "1000.00", "10.00"))
    # The month after is a group of its own.
    rows.append(("x", "2024-02-05", 1, 5, "5000.00", "0.00"))
    d = frame(spark, "order_id string, order_ts string, courier_id int, rate int, sum string, "
              "tip_sum string", rows, "order_ts")
    d = d.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("sum", "tip_sum")})
    names = spark.createDataFrame([(i, f"n{i}") for i in range(1, 6)], "courier_id int, name string")
    got = {
        (r["courier_id"], r["settlement_month"]): float(r["courier_order_sum"])
        for r in restaurants.courier_ledger(d, names).collect()
    }
    # Below 4: floor 100; at 4: floor 150; at 4.5: floor 175; at 4.9 and above: floor 200, then 10 %.
    assert got == {(1, 1): 200.0, (2, 1): 300.0, (3, 1): 350.0, (4, 1): 2000.0, (5, 1): 400.0,
                   (1, 2): 500.0}


def test_turnover(spark):
    t = frame(
        spark, "operation_id string, account_number_from int, account_number_to int, "
        "currency_code int, status string, amount double, transaction_dt string",
        [("a", 1, 2, 10, "done", -8.0, "2024-01-01 10:00:00"),
         ("b", 1, 1, 10, "done", 4.0, "2024-01-01 11:00:00"),
         ("c", 3, 1, 20, "done", 5.0, "2024-01-01 11:00:00"),
         ("d", 3, 1, 20, "queued", 5.0, "2024-01-01 11:00:00"),
         ("e", 3, 1, 20, "done", 5.0, "2024-01-02 11:00:00")], "transaction_dt",
    )
    rates = frame(
        spark, "date_update string, currency_code int, currency_code_with int, currency_with_div double",
        [("2024-01-01", 420, 10, 2.0), ("2024-01-01", 7, 20, 9.0)], "date_update",
    )
    def metrics(since):
        return sorted(
            (str(r["date_update"]), *tuple(r)[1:])
            for r in turnover.turnover_metrics(t, rates, since).collect()
        )

    everything = [
        ("2024-01-01", 10, 6.0, 2, 2.0, 2), ("2024-01-01", 20, 5.0, 1, 1.0, 2),
        ("2024-01-02", 20, 5.0, 1, 1.0, 2),
    ]
    empty = frame(spark, "date_update string", [("2024-01-01",)], "date_update")
    assert metrics(None) == everything
    assert metrics(empty.filter("false")) == everything  # first run
    assert metrics(empty) == everything[2:]


def geo(spark, rows):
    df = frame(
        spark, "event_id int, event_type string, user int, to int, channel string, lat double, "
        "lon double, ts string", rows, "ts",
    )
    return df.select(
        "event_id", "event_type", "lat", "lon", F.to_date("ts").alias("date"),
        F.struct(
            F.when(F.col("event_type") == "message", F.col("user")).alias("message_from"),
            F.col("to").alias("message_to"), "user", F.col("channel").alias("subscription_channel"),
            F.col("ts").alias("datetime"),
        ).alias("event"),
    )


def cities(spark):
    return spark.createDataFrame(
        [(1, "S", -33.865, 151.2094, "Australia/Sydney"), (2, "P", -31.9522, 115.8589, "Australia/Perth")],
        "id int, city string, lat double, lng double, timezone string",
    )


def test_user_geo(spark):
    s, p = (-33.8, 151.2), (-31.9, 115.8)
    rows = [
        (1, "message", 1, 9, None, *s, "2024-01-01 00:00:00"),
        (2, "message", 1, 9, None, *s, "2024-01-29 00:00:00"),   # 28 days
        (3, "message", 1, 9, None, *p, "2024-01-30 00:00:00"),
        (4, "message", 1, 9, None, *s, "2024-02-01 00:00:00"),   # a return counts again
        (5, "message", 2, 9, None, *p, "2024-01-01 00:00:00"),
        (6, "message", 2, 9, None, *p, "2024-01-28 00:00:00"),   # 27 days
    ]
    got = {r["user_id"]: r for r in geography.user_geo(geo(spark, rows), cities(spark)).collect()}
    one, two = got[1], got[2]
    assert (one["act_city"], one["home_city"], one["travel_count"]) == ("S", "S", 3)
    assert one["travel_array"] == ["S", "P", "S"]
    assert str(one["local_time"]) == "2024-02-01 11:00:00"
    assert (two["act_city"], two["home_city"], two["travel_count"]) == ("P", None, 1)


def test_zone_activity_carries_coordinates(spark):
    s, p = (-33.8, 151.2), (-31.9, 115.8)
    rows = [
        (1, "reaction", 1, None, None, *p, "2024-01-01 00:00:00"),   # before any message
        (2, "message", 1, 9, None, *s, "2024-01-02 00:00:00"),
        (3, "reaction", 1, None, None, None, None, "2024-01-31 00:00:00"),
        (4, "message", 1, 9, None, *s, "2024-02-01 00:00:00"),       # same week, next month
    ]
    got = {
        (str(r["month"]), str(r["week"])): tuple(r)[3:]
        for r in geography.zone_activity(geo(spark, rows), cities(spark)).collect()
    }
    assert got == {
        ("2024-01-01", "2024-01-01"): (1, 0, 0, 1, 1, 1, 0, 1),
        ("2024-01-01", "2024-01-29"): (1, 1, 0, 0, 1, 1, 0, 1),
        ("2024-02-01", "2024-01-29"): (1, 1, 0, 0, 1, 0, 0, 0),
    }


def test_friend_candidates(spark):
    near = [(-33.865, 151.2094), (-33.866, 151.2094), (-33.867, 151.2094)]
    rows = [
        (i, "subscription", u, None, "ch", *near[u - 1], "2024-01-01 00:00:00")
        for i, u in enumerate((1, 2, 3))
    ]
    rows += [
        (10, "message", 2, 1, None, *near[1], "2024-01-02 00:00:00"),  # one direction is enough
        (11, "subscription", 4, None, "ch", -31.9, 115.8, "2024-01-01 00:00:00"),  # far away
        (12, "subscription", 5, None, "other", *near[0], "2024-01-01 00:00:00"),   # other channel
        (13, "reaction", 3, None, None, -31.9, 115.8, "2024-01-09 00:00:00"),      # no message: no place
    ]
    # The place is where the last message was sent from.
    places = {1: near[0], 3: near[2], 4: (-31.9, 115.8), 5: near[0]}
    rows += [(20 + u, "message", u, 9, None, *at, "2024-01-03 00:00:00") for u, at in places.items()]
    got = geography.friend_candidates(geo(spark, rows), cities(spark), "2024-03-01 00:00:00")
    assert sorted((r["user_left"], r["user_right"]) for r in got.collect()) == [(1, 3), (2, 3)]


def _crowd(seed: int, people: int) -> list[tuple]:
    """Users in two places and several channels, who write to a few of each other and to user 0 above all."""
    draw = random.Random(seed)
    rows, ids = [], itertools.count()
    for u in range(people):
        at = (10.0 + draw.choice([0, 0.004, 0.02]), 20.0)
        rows += [(next(ids), "subscription", u, None, c, *at, "2024-01-01 00:00:00") for c in draw.choices("abcdef", k=3)]
        for to in (0, *draw.choices(range(people), k=2)):
            rows.append((next(ids), "message", u, draw.choice([to, None]), None, *at, "2024-01-02 00:00:00"))
    return rows


def _friends(rows: list[tuple]) -> list[tuple]:
    joined, wrote, at = {}, set(), {}
    for _, kind, u, to, channel, lat, _, _ in rows:
        if kind == "message":
            wrote |= {(u, to), (to, u)}
            at[u] = lat
        else:
            joined.setdefault(u, set()).add(channel)
    return sorted((a, b) for a in joined for b in joined if a < b and joined[a] & joined[b] and (a, b) not in wrote
                  and abs(at[a] - at[b]) < 0.008)


@pytest.mark.parametrize("block,listed", [(2000, 1000), (5, 1000), (2000, 2), (5, 2), (2000, 0)])
def test_friend_candidates_of_a_crowd(spark, block, listed):
    """Every pair once, whatever channels it shares, with and without lists and blocks."""
    rows = _crowd(3, 60)
    got = geography.friend_candidates(
        geo(spark, rows), cities(spark), "2024-03-01 00:00:00", block=block, listed=listed)
    assert sorted((r["user_left"], r["user_right"]) for r in got.collect()) == _friends(rows)


def test_friend_candidates_shuffle_no_pairs(spark):
    """Pairs are neither grouped nor joined once they are found."""
    got = geography.friend_candidates(geo(spark, _crowd(4, 30)), cities(spark), "2024-03-01 00:00:00")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [left_key" not in plan and "(left_key" not in plan


def test_courier_ledger_is_dealt_by_rows(spark):
    """Many small tasks give the sums of one; the number of tasks follows the rows."""
    rows = [(f"{i // 2}", f"2024-0{i % 3 + 1}-05", i % 4, i % 5 + 1, f"{100 + i}.00", "1.50") for i in range(200)]
    d = frame(spark, "order_id string, order_ts string, courier_id int, rate int, sum string, "
              "tip_sum string", rows, "order_ts")
    d = d.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("sum", "tip_sum")})
    names = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "courier_id int, name string")
    whole, cut = (restaurants.courier_ledger(d, names, rows=n) for n in (1000, 7))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))
    orders = {(c, m): len({i // 2 for i in range(200) if i % 4 == c and i % 3 + 1 == m}) for c in range(4) for m in (1, 2, 3)}
    assert {(r["courier_id"], r["settlement_month"]): r["orders_count"] for r in cut.collect()} == orders
    assert ", 29" in cut._jdf.queryExecution().optimizedPlan().toString()


def test_group_conversion(spark):
    g = frame(spark, "group_id int, hk_group_id string, registration_dt string",
              [(1, "g1", "2020-01-01"), (2, "g2", "2020-01-02"), (3, "g3", "2020-01-03")],
              "registration_dt")
    member = spark.createDataFrame(
        [("l1", "g1", "u1"), ("l2", "g1", "u2"), ("l3", "g2", "u1"), ("l4", "g3", "u1")],
        "hk_l_user_group_activity string, hk_group_id string, hk_user_id string",
    )
    events = spark.createDataFrame(
        [("l1", "add"), ("l2", "add"), ("l2", "add"), ("l3", "add"), ("l4", "add")],
        "hk_l_user_group_activity string, event string",
    )
    dialogs = spark.createDataFrame([("g1", "m1"), ("g2", "m2")], "hk_group_id string, hk_message_id string")
    sent = spark.createDataFrame([("m1", "u1"), ("m2", "u1")], "hk_message_id string, hk_user_id string")
    got = groups.group_conversion(g, member, events, dialogs, sent, oldest=2)
    assert [tuple(r) for r in got.collect()] == [("g2", 1, 1, 1.0), ("g1", 2, 1, 0.5)]


def test_product_sales_skips_and_stops(spark):
    import json

    def event(i, order, product, kind="bonus_transaction"):
        body = {"user_id": "1", "order_id": order, "order_date": "x", "product_payments": [
            {"product_id": product, "product_name": "n", "price": 1.5, "quantity": i,
             "product_cost": 3.0, "bonus_payment": 0, "bonus_grant": 0}]}
        return (i, "2024-01-01", kind, json.dumps(body))

    rows = [event(1, "o1", "p1"), event(2, "zz", "p9"), event(3, "o1", "p1"),
            event(4, "o1", "p1", "user_balance"), event(5, "o1", "p9"), event(6, "o1", "p2")]
    ev = frame(spark, "id int, event_ts string, event_type string, event_value string", rows, "event_ts")
    known = spark.createDataFrame([("o1",)], "order_key string")
    prods = spark.createDataFrame([("p1",), ("p2",)], "product_id string")
    facts, cursor = restaurants.product_sales(ev, known, prods)
    # The unknown order is skipped, the unknown product ends the load, the later event overwrites.
    assert [(r["product_id"], r["count"]) for r in facts.collect()] == [("p1", 3)]
    assert cursor.first()["cursor"] == 3


def test_deliveries_first_load_takes_all(spark):
    d = frame(
        spark, "order_id int, order_ts string, delivery_id int, courier_id int, address string, "
        "delivery_ts string, rate int, sum double, tip_sum double",
        [(1, "2024-01-01", 1, 1, "a", "2024-01-01", 5, 1.0, 0.0),
         (2, "2024-01-02", 2, 1, "a", "2024-01-02", 5, 1.0, 0.0)], "order_ts", "delivery_ts",
    )
    assert restaurants.deliveries(d, d.filter("false")).count() == 2
    assert [r["order_id"] for r in restaurants.deliveries(d, d.filter("order_id = 1")).collect()] == [2]
