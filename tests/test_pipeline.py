"""The steps of the command line over a store, from landing files to a tied-out mart, twice."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.plans import schemas, store
from ledgerloom.plans.store import ClosedPeriod, TableStore
from ledgerloom.sources import feeds
from ledgerloom.storage import cleanup, fresh_path

SPECS = """
operators:
  op:
    file_format: csv
    csv_options: {header: true, delimiter: ","}
    timezone: UTC
    currency: USD
    column_map: {partner_txn_id: id, msisdn_or_account: acc, txn_type: kind, plan_code: plan, amount: amount, txn_ts: at}
    txn_type_map: {OK: recursion_success, NEW: subscription_success}
"""
AT = dt.datetime(2026, 5, 29, 9)


def test_end_to_end(spark):
    root = fresh_path(spark, "pipe")
    tables, landing = TableStore(spark, f"{root}/store"), f"{root}/landing"
    os.makedirs(f"{landing}/op/2026-05-29")
    with open(f"{landing}/op/2026-05-29/a.csv", "w") as f:
        f.write("id,acc,kind,plan,amount,at\nT1,A1,OK,P,1.00,2026-05-29T09:00:00\n,A2,NEW,P,2.00,2026-05-29T09:00:00\nT3,A1,OK,P,7.00,2026-05-29T09:00:00\n")
    day = dt.date(2026, 5, 29)
    quotes = spark.createDataFrame([("NGN", day, Decimal("0.00065"))], "currency string, rate_date date, rate_to_reporting decimal(18,8)")
    cli.load_fx(tables, quotes)
    cli.load_plans(tables, spark.createDataFrame([("op", "P", Decimal(2), "USD", "daily", dt.date(2026, 1, 1))], "operator_code string, plan_code string, price_original decimal(18,4), currency string, billing_period string, effective_from date"))
    for _ in range(2):  # landing files delivered again change nothing
        cli.ingest_feeds(tables, feeds.load_specs(SPECS), landing)
    assert tables.read("partner_txn").count() == 3
    initial = spark.createDataFrame([("s1", "U2", None, "P", "active", AT, Decimal(2))], "sub_id string, user_id string, partner_txn_id string, plan_id string, status string, created_ts timestamp, amount decimal(18,4)")
    success = spark.createDataFrame([("r1", "s0", "U1", "T1", Decimal(1), AT, 1)], "recursion_id string, sub_id string, user_id string, partner_txn_id string, amount decimal(18,4), recurrence_ts timestamp, billing_cycle int")
    failure = spark.createDataFrame([], "failure_id string, sub_id string, user_id string, partner_txn_id string, amount decimal(18,4), failure_reason string, attempt_ts timestamp, retry_count int")
    for name, df in (("sub_initial", initial), ("sub_recursion_success", success), ("sub_recursion_failure", failure)):
        df.write.parquet(f"{root}/oltp/{name}_op")
    cli.ingest_cdc(tables, f"{root}/oltp", ["op", "absent"])
    with pytest.raises(FileNotFoundError):
        cli.ingest_cdc(tables, f"{root}/nowhere", ["op"])
    tables.replace("account_user_bridge", spark.createDataFrame([("op", "A2", "U2", "s1", dt.date(2020, 1, 1), dt.date(9999, 12, 31), True)], schemas.SCHEMAS["account_user_bridge"]))
    tables.replace("user_churn_events", schemas.empty(spark, "user_churn_events"))
    cli.run_day(tables, day, "2026-05")
    first = {r.break_id: r.break_category for r in tables.read("fact_reconciliation_break").collect()}
    assert sorted(first.values()) == ["matched", "matched", "missing_on_platform"]
    cli.backfill(tables, day, day, "2026-05")
    assert {r.break_id: r.break_category for r in tables.read("fact_reconciliation_break").collect()} == first
    fact = schemas.conforming(tables.read("fact_reconciliation_break"), "fact_reconciliation_break")
    assert fact.where("plan_price_ok").count() == 1 and fact.where("plan_price_ok = false").count() == 2
    assert tables.read("reconciliation_daily").first().break_count == 1 and tables.read("recon_run_log").count() == 2
    store.export_csv(tables.read("reconciliation_daily"), f"{root}/csv")
    assert spark.read.csv(f"{root}/csv", header=True).count() == 1
    store.close_period(tables, "2026-05", "me", F.lit("2026-06-01").cast("timestamp"))
    with pytest.raises(ClosedPeriod):
        cli.run_day(tables, day, "2026-06")
    assert tables.read("fact_adjustments").count() == 0
    assert json.dumps(sorted(first)) and "PARTITIONED BY (business_date)" in schemas.create_statement("partner_txn", "/x")


def test_schemas_parse_and_cleanup(spark):
    for name in schemas.SCHEMAS:
        assert schemas.empty(spark, name).count() == 0
    path = fresh_path(spark, "gone")
    spark.range(3).write.parquet(path)
    # Only what this driver wrote is deleted; tests that follow write anew.
    cleanup(spark)
    assert not os.path.exists(path)


def test_links_and_churn_come_from_landing_files(spark):
    root = fresh_path(spark, "learned")
    tables, landing, oltp = TableStore(spark, f"{root}/store"), f"{root}/landing", f"{root}/oltp"
    at = lambda month, day: dt.datetime(2026, month, day, 9)

    def deliver(name, day, feed, renewals, churned):
        os.makedirs(f"{landing}/op/{day}")
        with open(f"{landing}/op/{day}/{name}.csv", "w") as f:
            f.write("id,acc,kind,plan,amount,at\n" + "".join(f"{i},{a},OK,P,{m},{t.isoformat()}\n" for i, a, m, t in feed))
        spark.createDataFrame(renewals, "recursion_id string, sub_id string, user_id string, partner_txn_id string, amount decimal(18,4), recurrence_ts timestamp, billing_cycle int").write.mode("append").parquet(f"{oltp}/sub_recursion_success_op")
        spark.createDataFrame(churned, "user_id string, operator_code string, churn_ts timestamp, churn_reason string, last_known_sub_id string, _op string, _commit_ts timestamp").write.mode("append").parquet(f"{oltp}/user_churn_events")
        cli.ingest_feeds(tables, feeds.load_specs(SPECS), landing)
        for _ in range(2):  # change data delivered again changes nothing
            cli.ingest_cdc(tables, oltp, ["op"])

    cli.load_fx(tables, spark.createDataFrame([("NGN", dt.date(2026, 5, 28), Decimal("0.00065"))], "currency string, rate_date date, rate_to_reporting decimal(18,8)"))
    cli.load_plans(tables, spark.createDataFrame([("op", "P", Decimal(1), "USD", "daily", dt.date(2026, 1, 1))], "operator_code string, plan_code string, price_original decimal(18,4), currency string, billing_period string, effective_from date"))
    spark.createDataFrame([], "sub_id string, user_id string, partner_txn_id string, plan_id string, status string, created_ts timestamp, amount decimal(18,4)").write.parquet(f"{oltp}/sub_initial_op")
    spark.createDataFrame([], "failure_id string, sub_id string, user_id string, partner_txn_id string, amount decimal(18,4), failure_reason string, attempt_ts timestamp, retry_count int").write.parquet(f"{oltp}/sub_recursion_failure_op")
    one, three = Decimal(1), Decimal(3)
    deliver(
        "a", "2026-05-29", [("T1", "A1", 1, at(5, 28)), ("", "A1", 1, at(5, 29)), ("T2", "A2", 3, at(5, 29))],
        [("r1", "s0", "U1", "T1", one, at(5, 28), 1), ("r2", "s0", "U1", None, one, at(5, 29), 2), ("r3", "s2", "U2", "T2", three, at(5, 29), 1)],
        [("U2", "op", at(5, 20), "left", "s2", "I", at(5, 20)), (None, "op", at(5, 20), "?", None, "I", at(5, 20))],
    )
    cli.run_day(tables, None, "2026-05")
    fact = sorted((r.business_date.day, r.match_method, r.break_category) for r in tables.read("fact_reconciliation_break").collect())
    assert fact == [(28, "partner_txn_id", "matched"), (29, "fallback_identity", "matched"), (29, "partner_txn_id", "orphan_churn")]
    deliver(
        "b", "2026-06-01", [("T4", "A1", 1, at(6, 1))], [("r4", "s9", "U9", "T4", one, at(6, 1), 1)],
        [("U2", "op", at(5, 20), "left", "s2", "D", at(5, 31))],
    )
    links = sorted((r.account_id, r.user_id, r.effective_from, r.effective_to, r.is_current) for r in tables.read("account_user_bridge").collect())
    never = dt.date(9999, 12, 31)
    assert links == [
        ("A1", "U1", dt.date(2026, 5, 28), dt.date(2026, 6, 1), False), ("A1", "U9", dt.date(2026, 6, 1), never, True), ("A2", "U2", dt.date(2026, 5, 29), never, True),
    ]
    assert [(r.user_id, r.is_deleted, r.churn_reason) for r in tables.read("user_churn_events").collect()] == [("U2", True, "left")]


def test_change_data_before_any_feed(spark):
    root = fresh_path(spark, "early")
    tables = TableStore(spark, f"{root}/store")
    tables.replace("platform_txn", schemas.empty(spark, "platform_txn"))
    tables.replace("account_user_bridge", spark.createDataFrame([("op", "A2", "U2", "s1", dt.date(2020, 1, 1), dt.date(9999, 12, 31), True)], schemas.SCHEMAS["account_user_bridge"]))
    cli.load_churn(tables, f"{root}/nowhere")
    cli.learn_links(tables)
    assert tables.read("user_churn_events").count() == 0 and [r.user_id for r in tables.read("account_user_bridge").collect()] == ["U2"]
