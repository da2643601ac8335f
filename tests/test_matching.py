"""The assignment against a sequential greedy pass, and the stages on a hand-made case set."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions.money import within_tolerance
from ledgerloom.operators import matching as M
from ledgerloom.plans import reconcile as R

SCORED = "p_event_id string, i_event_id string, confidence decimal(6,3), gap long"
LEDGER = "event_id string, operator_code string, partner_txn_id string, account_id string, identity string, txn_type string, plan_code string, amount decimal(18,4), business_date date, ts timestamp, arrival date"
DAY = dt.date(2026, 5, 29)


def greedy(rows):
    used, out = set(), set()
    for p, i, c, g in sorted(rows, key=lambda r: (-r[2], r[3], r[0], r[1])):
        if ("p", p) not in used and ("i", i) not in used:
            used |= {("p", p), ("i", i)}
            out.add((p, i))
    return out


def test_assignment_equals_sequential_greedy(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = {(f"p{rng.randrange(25)}", f"i{rng.randrange(25)}"): (Decimal(rng.choice(["0.800", "0.900", "1.000"])), rng.randrange(4)) for _ in range(150)}
        rows = [(p, i, c, g) for (p, i), (c, g) in rows.items()]
        got = {(r.p_event_id, r.i_event_id) for r in M.assign(spark.createDataFrame(rows, SCORED)).collect()}
        assert got == greedy(rows)
    assert M.assign(spark.createDataFrame([], SCORED)).count() == 0


def test_tolerance(spark):
    rows = [("1.00", "1.01", True), ("1.00", "1.0101", False), ("100", "100.5", True), ("100", "100.5001", False), ("100.5025", "100", True), (None, "1", False), ("1", None, False), ("-100", "-100.5", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean").select(F.col("a").cast("decimal(18,4)").alias("a"), F.col("b").cast("decimal(18,4)").alias("b"), "want")
    assert df.where(within_tolerance(F.col("a"), F.col("b"), "0.01", "0.005") != F.col("want")).count() == 0


def row(event, txn, who, kind="recursion_success", amount="1.00", day=DAY, plan=None, late=0, op="telco"):
    at = dt.datetime.combine(day, dt.time(9))
    return (event, op, txn, who, who, kind, plan, Decimal(amount), day, at, day + dt.timedelta(days=late))


def test_stages(spark):
    p = [
        row("P1", "T1", "A1"), row("P2", "T2", "A1", amount="1.50"), row("P3", "T3", "A1"), row("P4", None, "A2", amount="2.00"), row("P5", None, "A3", amount="9.00"), row("P6", "T6", "A1", late=3),
        row("P7", "T7", "A7"), row("P8", "T8", "A1", kind="refund"), row("P9", None, "A9"), row("P10", "T10", "A1", kind="cancel"),
    ]
    i = [
        row("I1", "T1", "U1"), row("I2", "T2", "U1"), row("I4", None, "U2", amount="2.00"), row("I5", None, "U3", amount="5.00"), row("I6", "T6", "U1"), row("I7", "T7", "U7"),
        row("I8", "T99", "U8", day=DAY - dt.timedelta(days=40)), row("I9", "T3", "U1", day=DAY - dt.timedelta(days=28)),
    ]
    bridge = [("telco", f"A{n}", f"U{n}", dt.date(2020, 1, 1), dt.date(9999, 12, 31)) for n in (1, 2, 3, 7)] + [("telco", "A2", "U_OLD", dt.date(2019, 1, 1), dt.date(2020, 1, 1))]
    churn = [("telco", "U7", dt.datetime(2026, 5, 28, 3), False), ("telco", "U1", dt.datetime(2026, 5, 29, 1), False), ("telco", "U2", dt.datetime(2026, 1, 1), True)]
    b = spark.createDataFrame(bridge, "operator_code string, account_id string, user_id string, effective_from date, effective_to date")
    c = spark.createDataFrame(churn, "operator_code string, user_id string, churn_ts timestamp, is_deleted boolean")
    periods = spark.createDataFrame([("2026-04", "closed")], "period_month string, status string")
    run = lambda: R.reconcile(spark.createDataFrame(p, LEDGER), spark.createDataFrame(i, LEDGER), b, c, periods, "2026-06", F.lit("2026-06-01").cast("timestamp"))
    rows = {(r.partner_event_id, r.platform_event_id): r for r in run().collect()}
    said = {k: (r.break_category, r.match_method, r.match_confidence) for k, r in rows.items()}
    assert said[("P1", "I1")] == ("matched", "partner_txn_id", 1.0)
    assert said[("P2", "I2")] == ("amount_mismatch", "partner_txn_id", 1.0)
    assert said[("P3", None)] == ("missing_on_platform", "unmatched", 0.0) and said[(None, "I9")] == ("missing_at_partner", "unmatched", 0.0)
    assert said[("P4", "I4")] == ("matched", "fallback_identity", 0.9)
    assert said[("P5", None)] == ("missing_on_platform", "fallback_below_floor", 0.7) and said[(None, "I5")] == ("missing_at_partner", "fallback_below_floor", 0.7)
    assert said[("P6", "I6")][0] == "late_arrival" and rows[("P6", "I6")].lag_days == 3 and rows[("P6", "I6")].is_late
    assert said[("P7", "I7")][0] == "orphan_churn" and said[("P8", None)][0] == "missing_on_platform" and said[("P9", None)][1] == "unmatched"
    assert ("P10", None) not in said and len(said) == 12
    old = rows[(None, "I8")]
    assert old.is_closed_month and old.adj_period == "2026-06" and old.original_business_date == old.business_date
    assert all(r.variance == (r.partner_amount or 0) - (r.internal_amount or 0) for r in rows.values())
    assert {r.break_id for r in rows.values()} == {r.break_id for r in run().collect()}


def test_split_of_closed_months(spark):
    schema = "break_id string, break_category string, partner_amount decimal(18,4), internal_amount decimal(18,4), match_method string, is_closed_month boolean"
    now = [("a", "matched", Decimal(1), Decimal(1), "x", False), ("b", "matched", Decimal(1), Decimal(1), "x", True), ("c", "matched", Decimal(2), Decimal(1), "x", True), ("d", "matched", None, None, "x", True)]
    then = [("b", "matched", Decimal(1), Decimal(1), "x", True), ("c", "matched", Decimal(1), Decimal(1), "x", True)]
    current, adjustments = R.split_closed(spark.createDataFrame(now, schema), spark.createDataFrame(then, schema))
    assert [r.break_id for r in current.collect()] == ["a"] and {r.break_id for r in adjustments.collect()} == {"c", "d"}
