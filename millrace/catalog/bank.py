"""Bank: fraud marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from millrace.catalog.base import query
from millrace.plans import bank
from millrace.session import materialize, scratch_path
from millrace.sources.sinks import append_report, read_table

PEOPLE = """
    people as (
        select trim(cr.card_num) as card_num, cl.client_id,
               concat_ws(' ', last_name, first_name, patronymic) as fio,
               passport_num as passport, passport_valid_to, phone, acc.valid_to
        from bank_accounts acc
             join bank_clients cl on acc.client = cl.client_id
                  and acc.effective_to = timestamp '2999-12-31'
                  and cl.effective_to = timestamp '2999-12-31'
             join bank_cards cr on acc.account = cr.account
                  and cr.effective_to = timestamp '2999-12-31')"""
PASSPORT = """
    f1 as (
        select distinct trans_date as event_dt, p.passport, fio, phone, 1 as event_type,
               cast(trans_date as date) as report_dt
        from bank_txns t join people p on t.card_num = p.card_num
             left join bank_blacklist b on p.passport = b.passport
        where cast(trans_date as date) > passport_valid_to
              or (b.passport is not null and trans_date > b.entry_dt))"""
CONTRACT = """
    f2 as (
        select distinct trans_date as event_dt, passport, fio, phone, 2 as event_type,
               cast(trans_date as date) as report_dt
        from bank_txns t join people p on t.card_num = p.card_num
        where valid_to < cast(trans_date as date))"""
CITY_HOP = """
    hop as (
        select t.*, p.passport, p.fio, p.phone, te.terminal_city as city,
               lead(te.terminal_city) over w as next_city, lead(trans_date) over w as next_dt
        from bank_txns t join people p on t.card_num = p.card_num
             left join bank_terminals te on t.terminal = te.terminal
                  and te.effective_to = timestamp '2999-12-31'
        window w as (partition by client_id order by trans_date, trans_id)),
    f3 as (
        select distinct trans_date as event_dt, passport, fio, phone, 3 as event_type,
               cast(trans_date as date) as report_dt
        from hop where city <> next_city and next_dt - trans_date <= interval '1' hour)"""
PROBE = """
    probe as (
        select t.*, p.passport, p.fio, p.phone,
               lead(trans_date, 3) over w as dt3, lead(amt, 1) over w as a1,
               lead(amt, 2) over w as a2, lead(amt, 3) over w as a3,
               lead(oper_result, 1) over w as r1, lead(oper_result, 2) over w as r2,
               lead(oper_result, 3) over w as r3
        from bank_txns t join people p on t.card_num = p.card_num
        window w as (partition by client_id order by trans_date, trans_id)),
    f4 as (
        select distinct dt3 as event_dt, passport, fio, phone, 4 as event_type,
               cast(dt3 as date) as report_dt
        from probe
        where oper_result = 'REJECT' and r1 = 'REJECT' and r2 = 'REJECT' and r3 = 'SUCCESS'
              and amt > a1 and a1 > a2 and a2 > a3
              and epoch_us(dt3) - epoch_us(trans_date) <= 259200000000)"""
VIEWS = "bank_clients bank_accounts bank_cards bank_txns"


def _people(v):
    return bank.card_holders(v("bank_accounts"), v("bank_clients"), v("bank_cards"))


@query("fraud_passport", VIEWS + " bank_blacklist", f"with {PEOPLE}, {PASSPORT} select * from f1")
def passport(v, spark):
    return bank.fraud_passport(v("bank_txns"), _people(v), v("bank_blacklist"))


@query("fraud_contract", VIEWS, f"with {PEOPLE}, {CONTRACT} select * from f2")
def contract(v, spark):
    return bank.fraud_contract(v("bank_txns"), _people(v))


@query("fraud_city_hop", VIEWS + " bank_terminals", f"with {PEOPLE}, {CITY_HOP} select * from f3")
def city_hop(v, spark):
    return bank.fraud_city_hop(v("bank_txns"), _people(v), v("bank_terminals"))


@query("fraud_amount_probe", VIEWS, f"with {PEOPLE}, {PROBE} select * from f4")
def amount_probe(v, spark):
    return bank.fraud_amount_probe(v("bank_txns"), _people(v), within="3 days")


@query(
    "fraud_report",
    VIEWS + " bank_blacklist bank_terminals",
    f"with {PEOPLE}, {PASSPORT}, {CONTRACT}, {CITY_HOP}, {PROBE} "
    "select * from f1 union all select * from f2 union all select * from f3 "
    "union all select * from f4",
)
def report(v, spark):
    people, txns = materialize(_people(v), "holders"), v("bank_txns")
    rows = bank.fraud_report(
        bank.fraud_passport(txns, people, v("bank_blacklist")), bank.fraud_contract(txns, people),
        bank.fraud_city_hop(txns, people, v("bank_terminals")),
        bank.fraud_amount_probe(txns, people, within="3 days"),
    )
    path = scratch_path(spark, "rep_fraud")
    # One shuffle by day keeps the files few; a busy day is spread over several tasks.
    spread = materialize(rows, "fraud").repartition(
        "report_dt", F.pmod(F.xxhash64("passport"), F.lit(4))
    )
    # The first run also reports a day whose signals turn out false; the rerun of that day empties it.
    last, false_alarm = date(2024, 1, 15), date(1999, 1, 1)
    rerun = spread.filter(F.col("report_dt") == F.lit(last))
    append_report(spread.unionByName(rerun.withColumn("report_dt", F.lit(false_alarm))), path)
    append_report(rerun, path, dates=[false_alarm, last])
    return read_table(spark, path, rows)
