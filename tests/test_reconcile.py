"""The whole reconciliation on the sixteen scenarios, and what closed months do with it."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.plans import marts, schemas, store
from ledgerloom.plans import reconcile as R
from ledgerloom.plans.store import TableStore
from ledgerloom.storage import fresh_path

DAY = dt.date(2026, 5, 29)
#: The published scenarios. operator, id, account, amount, arrival, hour, plan, type.
PARTNER = [
    ("telco_a", "TXNA1", "2348010000001", "0.975", DAY, 11, "PLN_A1"), ("telco_a", "TXNA2", "2348010000002", "1.3", DAY, 11, "PLN_A1"),
    ("telco_a", "TXNA3", "2348010000003", "0.975", DAY, 11, "PLN_A1"), ("telco_a", "TXNA4", "2348010000004", "0.975", DAY, 11, "PLN_A1"),
    ("telco_a", "TXNA6", "2348019999999", "0.975", DAY, 11, "PLN_A1"), ("telco_a", "TXNA7", "2348010000007", "0.975", dt.date(2026, 6, 1), 11, "PLN_A1"),
    ("telco_a", "TXNA12", "2348010000012", "0.975", DAY, 22, "PLN_A1"), ("telco_b", "TXNB1", "923000000001", "1.98", DAY, 9, "PLN_B1"),
    ("telco_c", "TXNC1", "905000000001", "3.7355", DAY, 11, "PLN_C1"), ("telco_d", None, "8801000000001", "2.73", DAY, 2, "PLN_D1"),
    ("telco_d", None, "8801000000999", "9.0909", DAY, 2, "PLN_DX"), ("telco_f", "TXNF1", "94000000001", "1.485", DAY, 4, "PLN_F1"),
]
#: operator, id, user, subscription, amount, type, day, hour.
PLATFORM = [
    ("telco_a", "TXNA1", "U_A1", "SUB_A1", "0.98", "recursion_success", DAY, 12), ("telco_a", "TXNA2", "U_A2", "SUB_A2", "0.98", "recursion_success", DAY, 12),
    ("telco_a", "TXNA3", "U_A3", "SUB_A3", "0.97", "recursion_success", DAY, 12), ("telco_a", "TXNA6", "U_ORPHAN", "S_ORPHAN", "0.98", "recursion_success", DAY, 12),
    ("telco_a", "TXNA7", "U_A7", "SUB_A7", "0.98", "recursion_success", DAY, 12), ("telco_a", "TXNA12", "U_A12", "SUB_A12", "0.98", "recursion_success", DAY, 22),
    ("telco_a", None, "U_A5", "SUB_A5", "0.98", "recursion_success", DAY, 12), ("telco_a", "TXNA1", "U_A1", "SUB_A1", "0.98", "subscription_success", dt.date(2026, 5, 1), 0),
    ("telco_a", None, "U_A16", "SUB_A16", "0", "recursion_failure", DAY, 6), ("telco_b", "TXNB1", "U_B1", "SUB_B1", "1.98", "recursion_success", DAY, 9),
    ("telco_c", "TXNC1", "U_C1", "SUB_C1", "3.74", "recursion_success", DAY, 14), ("telco_d", None, "U_D1", "SUB_D1", "2.73", "recursion_success", DAY, 8),
    ("telco_d", None, "U_D9", "SUB_D9", "5.0", "recursion_success", DAY, 8),
]


def ledgers(spark):
    at = lambda day, hour: dt.datetime.combine(day, dt.time(hour))
    p = [(f"p{n}", o, i, a, None, "refund" if i == "TXNF1" else "recursion_success", plan, Decimal(m), DAY, at(DAY, h), arrival) for n, (o, i, a, m, arrival, h, plan) in enumerate(PARTNER)]
    i = [(f"i{n}", o, k, u, s, t, None, Decimal(m), d, at(d, h), d) for n, (o, k, u, s, m, t, d, h) in enumerate(PLATFORM)]
    tail = "txn_type string, plan_code string, amount decimal(18,4), business_date date, ts timestamp, arrival date"
    return (
        spark.createDataFrame(p, f"event_id string, operator_code string, partner_txn_id string, account_id string, identity string, {tail}"),
        spark.createDataFrame(i, f"event_id string, operator_code string, partner_txn_id string, identity string, sub_id string, {tail}"),
    )


def bridge(spark):
    rows = [("telco_d", "8801000000001", "U_D1"), ("telco_d", "8801000000999", "U_D9")]
    return spark.createDataFrame([(*r, dt.date(2020, 1, 1), dt.date(9999, 12, 31)) for r in rows], "operator_code string, account_id string, user_id string, effective_from date, effective_to date")


def churn(spark):
    return spark.createDataFrame([("telco_a", "U_ORPHAN", dt.datetime(2026, 5, 20))], "operator_code string, user_id string, churn_ts timestamp")


def fact(spark, day=None):
    p, i = ledgers(spark)
    periods = spark.createDataFrame([], "period_month string, status string")
    return R.reconcile(p, i, bridge(spark), churn(spark), periods, "2026-05", F.lit("2026-06-02").cast("timestamp"), day=day)


def test_published_scenarios(spark):
    rows = fact(spark).collect()
    assert len(rows) == 15 and [(r.business_date, r.sub_id, r.break_category) for r in rows if r.business_date != DAY] == [(dt.date(2026, 5, 1), "SUB_A1", "missing_at_partner")]
    today = [r for r in rows if r.business_date == DAY]
    by = {}
    for r in today:
        by.setdefault(r.break_category, set()).add(r.partner_txn_id or r.sub_id or r.account_id)
    assert by == {
        "matched": {"TXNA1", "TXNA3", "TXNA12", "TXNB1", "TXNC1", "SUB_D1"}, "amount_mismatch": {"TXNA2"}, "missing_on_platform": {"TXNA4", "8801000000999", "TXNF1"},
        "missing_at_partner": {"SUB_A5", "SUB_D9"}, "orphan_churn": {"TXNA6"}, "late_arrival": {"TXNA7"},
    }
    methods = {}
    for r in today:
        methods.setdefault((r.match_method, r.match_confidence), []).append(r)
    assert {k: len(v) for k, v in methods.items()} == {("partner_txn_id", 1.0): 8, ("fallback_identity", 0.9): 1, ("fallback_below_floor", 0.7): 2, ("unmatched", 0.0): 3}
    assert [r.lag_days for r in today if r.break_category == "late_arrival"] == [3]


def test_published_totals_and_the_day_alone(spark):
    rows = fact(spark, DAY)
    assert rows.count() == 14
    mart = {r.operator_code: (r.partner_txn_count, r.internal_txn_count, r.partner_amount_total, r.internal_amount_total) for r in marts.daily(rows).collect()}
    d = Decimal
    assert mart == {
        "telco_a": (7, 7, d("7.1500"), d("6.8500")), "telco_b": (1, 1, d("1.9800"), d("1.9800")), "telco_c": (1, 1, d("3.7355"), d("3.7400")),
        "telco_d": (2, 2, d("11.8209"), d("7.7300")), "telco_f": (1, 0, d("1.4850"), d("0.0000")),
    }
    close = {r.operator_code: (r.gross_revenue, r.refunds, r.variance_under_review) for r in marts.close(rows, "2026-05").collect()}
    assert close == {
        "telco_a": (d("7.15"), d("0.00"), d("2.29")), "telco_b": (d("1.98"), d("0.00"), d("0.00")), "telco_c": (d("3.74"), d("0.00"), d("0.00")),
        "telco_d": (d("11.82"), d("0.00"), d("14.09")), "telco_f": (d("0.00"), d("1.49"), d("1.49")),
    }


def test_adjustments_are_booked_once(spark):
    """A month is closed; then a row of it arrives. Run after run it is one adjustment, booked once, in the open month."""
    tables = TableStore(spark, fresh_path(spark, "closed"))
    p, i = ledgers(spark)
    names = {"amount": "amount_reporting", "ts": "txn_ts_utc", "arrival": "file_arrival_date"}
    late = p.where("partner_txn_id = 'TXNA4'")
    tables.replace("partner_txn", p.where("partner_txn_id IS NULL OR partner_txn_id != 'TXNA4'").withColumnsRenamed(names), ["business_date"])
    tables.replace("platform_txn", i.withColumnsRenamed({**names, "identity": "user_id"}), ["business_date"])
    tables.replace("account_user_bridge", bridge(spark))
    tables.replace("user_churn_events", churn(spark))
    tables.replace("dim_plan", schemas.empty(spark, "dim_plan"))
    tables.replace("fx_rate_daily", schemas.empty(spark, "fx_rate_daily"))
    cli.run_day(tables, None, "2026-05")
    frozen = {r.break_id for r in tables.read(cli.FACT).collect()}
    assert len(frozen) == 14 and tables.read(cli.ADJUSTMENTS).count() == 0
    store.close_period(tables, "2026-05", "me", F.lit("2026-06-02").cast("timestamp"))
    with pytest.raises(store.ClosedPeriod):
        cli.run_day(tables, DAY, "2026-06")
    tables.append("partner_txn", late.withColumnsRenamed(names))
    cli.run_day(tables, DAY, "2026-06")
    cli.run_day(tables, None, "2026-06")
    with pytest.raises(store.ClosedPeriod):
        cli.run_day(tables, DAY, "2026-06")
    (one,) = tables.read(cli.ADJUSTMENTS).collect()
    assert (one.partner_txn_id, one.adj_period, one.original_business_date, one.is_closed_month) == ("TXNA4", "2026-06", DAY, True)
    assert {r.break_id for r in tables.read(cli.FACT).collect()} == frozen
    assert [(r.operator_code, r.gross_revenue, r.missing_on_platform_cnt) for r in cli.close_report(tables, "2026-06").collect()] == [("telco_a", Decimal("0.98"), 1)]
    assert {r.operator_code: r.gross_revenue for r in cli.close_report(tables, "2026-05").collect()}["telco_a"] == Decimal("6.18")


def test_full_run_empties_days_that_yield_nothing(spark):
    tables = TableStore(spark, fresh_path(spark, "emptied"))
    p, i = ledgers(spark)
    names = {"amount": "amount_reporting", "ts": "txn_ts_utc", "arrival": "file_arrival_date"}
    tables.replace("partner_txn", p.withColumnsRenamed(names), ["business_date"])
    tables.replace("platform_txn", i.withColumnsRenamed({**names, "identity": "user_id"}), ["business_date"])
    tables.replace("account_user_bridge", bridge(spark))
    tables.replace("user_churn_events", churn(spark))
    tables.replace("dim_plan", schemas.empty(spark, "dim_plan"))
    tables.replace("fx_rate_daily", schemas.empty(spark, "fx_rate_daily"))
    cli.run_day(tables, None, "2026-05")
    assert tables.days(cli.FACT, "business_date") == [dt.date(2026, 5, 1), DAY]
    around = [DAY + dt.timedelta(days=n) for n in range(-7, 8)]
    assert all("business_date=2026-05-29" in f for f in cli._ledger(tables, "platform_txn", around).inputFiles())  # other days are not listed
    tables.replace("platform_txn", i.where(F.col("business_date") == F.lit(DAY)).withColumnsRenamed({**names, "identity": "user_id"}), ["business_date"])
    cli.run_day(tables, None, "2026-05")
    assert tables.days(cli.FACT, "business_date") == [DAY] == tables.days(cli.MART, "business_date")
    kept = cli.close_month(tables, "2026-05", "me").count()
    assert kept == 5 and store.is_closed(tables.read("recon_period_control"), "2026-05")
