import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import cdc, feeds
from ledgerloom.storage import shared_dir

SPECS = """
defaults: {reporting_currency: USD, unknown_setting: 1}
operators:
  plain:
    file_format: csv
    file_glob: "plain_*.csv"
    csv_options: {header: true, delimiter: ",", quote: '"'}
    timezone: Africa/Lagos
    currency: NGN
    column_map: {partner_txn_id: ref, msisdn_or_account: phone, txn_type: kind, plan_code: plan, amount: amount, currency: ccy, txn_ts: at}
    txn_type_map: {OK: recursion_success, NEW: subscription_success}
    negative_amount_means_refund: true
  comma:
    file_format: csv
    csv_options: {header: true, delimiter: ";"}
    timezone: Europe/Istanbul
    currency: TRY
    decimal_comma: true
    ts_format: dd/MM/yyyy HH:mm:ss
    column_map: {partner_txn_id: gone, msisdn_or_account: acc, txn_type: kind, amount: amount, txn_ts: at}
    txn_type_map: {1: subscription_success, 2: recursion_success}
  nested:
    file_format: json
    json_options: {multiline: true}
    timezone: Asia/Karachi
    currency: PKR
    amount_scale: 0.01
    ts_format: epoch_millis
    column_map: {partner_txn_id: t.id, msisdn_or_account: s.phone, txn_type: t.kind, amount: t.minor, currency: t.ccy, txn_ts: t.ms}
    txn_type_map: {rnw: recursion_success}
  lines:
    file_format: json
    json_options: {multiline: false}
    timezone: UTC
    currency: USD
    ts_format: iso8601
    column_map: {partner_txn_id: id, txn_type: type, amount: amount, txn_ts: at}
    txn_type_map: {renewal: recursion_success}
  off: {enabled: false, file_format: csv, timezone: UTC, currency: USD, column_map: {}, txn_type_map: {a: b}}
"""


@pytest.fixture(scope="module")
def landing(spark):
    import os

    root = f"{shared_dir(spark)}/landing"
    for name, text in {
        "plain/2026-05-29/plain_1.csv": "ref,phone,kind,plan,amount,ccy,at\nT1,0801,ok,P1,\"1,500.00\",NGN,2026-05-29T00:30:00\nT1,0801,ok,P1,\"1,500.00\",NGN,2026-05-29T00:30:00\nT2,0802,OK,P1,-3.50,,2026-05-29T10:00:00+02:00\nT3,0803,huh,P1,abc,USD,bad\n",
        "plain/2026-05-29/other.csv": "ref\nX\n",
        "comma/2026-05-29/c.csv": "acc;kind;amount;at\n77;2;1.234,50;29/05/2026 12:00:00\n",
        "nested/2026-05-29/n.json": json.dumps([{"t": {"id": "K1", "kind": "rnw", "minor": 55999, "ccy": "PKR", "ms": 1780042200000}, "s": {"phone": "92"}}]),
        "lines/2026-05-30/l.json": '{"id":"W1","type":"renewal","amount":9.9,"at":"2026-05-29T23:30:00-03:00"}\n{"id":"W2","type":"renewal","amount":1,"at":"2026-05-29T09:00:00Z"}\n',
    }.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    return root


def test_specs():
    specs = feeds.load_specs(SPECS)
    assert [s.operator for s in feeds.enabled(specs)] == ["plain", "comma", "nested", "lines"] and specs["comma"].txn_type_map["1"] == "subscription_success"
    with pytest.raises(ValueError):
        feeds.FeedSpec("x", "xml", "UTC", "USD", {}, {})


def ledger(spark, landing):
    parts = [feeds.conform(feeds.read_raw(spark, s, f"{landing}/{s.operator}/*"), s) for s in feeds.enabled(feeds.load_specs(SPECS))]
    return cdc.union_with_drift(parts)


def test_conform(spark, landing):
    rows = ledger(spark, landing).collect()
    by = {(r.operator_code, r.partner_txn_id): r for r in rows}
    one = by[("plain", "T1")]
    assert one.amount_original == Decimal("1500.0000") and one.txn_ts_utc == dt.datetime(2026, 5, 28, 23, 30) and one.business_date == dt.date(2026, 5, 28)
    assert one.source_file == "plain_1.csv" and one.file_arrival_date == dt.date(2026, 5, 29) and len(rows) == 8
    flipped = by[("plain", "T2")]
    assert flipped.txn_type == "refund" and flipped.amount_original == Decimal("3.5000") and flipped.txn_ts_utc == dt.datetime(2026, 5, 29, 8) and flipped.currency_original == "NGN"
    bad = by[("plain", "T3")]
    assert bad.txn_type is None and bad.dq_unmapped_type and bad.amount_original is None and bad.txn_ts_utc is None
    comma = by[("comma", None)]
    assert comma.amount_original == Decimal("1234.5000") and comma.txn_ts_utc == dt.datetime(2026, 5, 29, 9) and comma.txn_type == "recursion_success" and comma.plan_code is None
    assert by[("nested", "K1")].amount_original == Decimal("559.9900") and by[("nested", "K1")].txn_ts_utc == dt.datetime(2026, 5, 29, 8, 10)
    assert by[("lines", "W1")].txn_ts_utc == dt.datetime(2026, 5, 30, 2, 30) and by[("lines", "W2")].txn_ts_utc == dt.datetime(2026, 5, 29, 9)
    assert len({r.event_id for r in rows}) == 7  # the repeated row keeps its id


def test_fx(spark, landing):
    fx = spark.createDataFrame([("NGN", dt.date(2026, 5, 28), "0.00065000"), ("PKR", dt.date(2026, 5, 29), None)], "currency string, rate_date date, rate string").withColumn("rate", F.col("rate").cast("decimal(18,8)"))
    got = {(r.operator_code, r.partner_txn_id): r for r in feeds.apply_fx(ledger(spark, landing), fx, "USD").collect()}
    assert got[("plain", "T1")].amount_reporting == Decimal("0.9750") and not got[("plain", "T1")].fx_missing
    assert got[("nested", "K1")].fx_missing and got[("nested", "K1")].amount_reporting is None and got[("lines", "W1")].amount_reporting == Decimal("9.9000")


def test_change_data(spark):
    at = lambda n: dt.datetime(2026, 5, 1, n)
    initial = spark.createDataFrame([("s1", "u1", "T1", "p", "failed", at(1), Decimal(1), at(1), "I"), ("s1", "u1", "T1", "p", "active", at(1), Decimal(2), at(2), "U"), ("s2", "u2", None, "p", "active", at(1), Decimal(1), at(1), "D")],
                                    "sub_id string, user_id string, partner_txn_id string, plan_id string, status string, created_ts timestamp, amount decimal(18,4), _commit_ts timestamp, _op string").withColumn("operator_code", F.lit("o"))
    success = spark.createDataFrame([("r1", "s1", "u1", None, Decimal(3), at(3), 2)], "recursion_id string, sub_id string, user_id string, partner_txn_id string, amount decimal(18,4), recurrence_ts timestamp, billing_cycle int").withColumn("operator_code", F.lit("o"))
    failure = spark.createDataFrame([("f1", "s1", "u1", "T9", Decimal(3), "poor", at(4), 1)], "failure_id string, sub_id string, user_id string, partner_txn_id string, amount decimal(18,4), failure_reason string, attempt_ts timestamp, retry_count int").withColumn("operator_code", F.lit("o"))
    rows = cdc.platform_ledger(cdc.latest_versions(initial, "sub_id"), cdc.latest_versions(success, "recursion_id"), cdc.latest_versions(failure, "failure_id")).collect()
    assert {(r.txn_type, r.amount_original, r.partner_txn_id) for r in rows} == {("subscription_success", Decimal(2), "T1"), ("recursion_success", Decimal(3), None), ("recursion_failure", Decimal(0), None)}
    assert cdc.read_entity(spark, f"{shared_dir(spark)}/nowhere", "sub_initial", ["a"]) is None


def test_reporting_zone_canonical_types_and_offsets(spark):
    raw = spark.createDataFrame(
        [("1", "OK", "2026-05-29T23:30:00"), ("2", "ODD", "2026-05-29T20:00:00Z"), ("3", "?", "29-05-2026"), ("4", "OK", "2026-05-29 23:30:00+05:30")],
        "id string, kind string, at string",
    ).withColumns({"raw_row_hash": F.lit(""), "operator_code": F.lit("op"), "source_file": F.lit("f"), "file_arrival_date": F.lit(None).cast("date")})
    spec = feeds.FeedSpec("op", "csv", "UTC", "USD", {"partner_txn_id": "id", "txn_type": "kind", "txn_ts": "at"}, {"OK": "recursion_success", "ODD": "no_such_type"}, reporting_timezone="Asia/Karachi")
    got = {r.partner_txn_id: (r.business_date, r.dq_unmapped_type) for r in feeds.conform(raw, spec).collect()}
    assert got == {"1": (dt.date(2026, 5, 30), False), "2": (dt.date(2026, 5, 30), True), "3": (None, True), "4": (dt.date(2026, 5, 29), False)}
    # The year of a date with hyphens is no offset.
    form = feeds.FeedSpec("op", "csv", "UTC", "USD", {}, {"a": "b"}, ts_format="dd-MM-yyyy")
    assert str(raw.where("id = '3'").select(feeds.parsed_instant(form, F.col("at")).alias("t")).first().t) == "2026-05-29 00:00:00"
