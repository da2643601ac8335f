"""Ledger queries over a handful of orders, so that each way to match or miss is there once."""

import datetime as dt

import pytest

from ledgerloom.plans import ledger_queries as Q
from ledgerloom.storage import fresh_path


@pytest.fixture(scope="module")
def orders(spark):
    """1 has a key. Of the keyless, 5 and 20 agree, 70 differs in its amount only, 35 in its amount and lacks a plan."""
    root, at = fresh_path(spark, "orders"), dt.datetime(1993, 1, 5)
    rows = [(1, 1, "F"), (5, 1, "F"), (20, 4, "O"), (35, 2, "F"), (70, 5, "O")]
    rows = [(k, c, s, "1-URGENT", 1000.0 * k, at + dt.timedelta(days=7 * n)) for n, (k, c, s) in enumerate(rows)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double, o_orderdate timestamp").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(c, "BUILDING") for c in (1, 2, 4, 5)], "c_custkey long, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    return root


def test_fact_has_the_fallback_pairs(spark, orders):
    fact = {(r.partner_event_id, r.platform_event_id): (r.match_method, r.match_confidence, r.break_category) for r in Q.fact_rows(spark, orders).collect()}
    assert fact == {
        ("1", "1"): ("partner_txn_id", 1.0, "matched"), ("5", "5"): ("fallback_identity", 0.9, "matched"), ("20", "20"): ("fallback_identity", 1.0, "matched"),
        ("70", "70"): ("fallback_identity", 0.8, "amount_mismatch"), ("35", None): ("fallback_below_floor", 0.7, "missing_on_platform"),
        (None, "35"): ("fallback_below_floor", 0.7, "missing_at_partner"),
    }
    assert {r.break_category: r.n for r in Q.category_histogram(spark, orders).collect()} == {"matched": 3, "amount_mismatch": 1, "missing_on_platform": 1, "missing_at_partner": 1}


def test_review_queue_holds_weak_pairs_only(spark, orders):
    queue = [(r.partner_event_id, r.platform_event_id, r.match_method, r.match_confidence) for r in Q.review_queue(spark, orders).collect()]
    assert queue == [(None, "35", "fallback_below_floor", 0.7), ("35", None, "fallback_below_floor", 0.7), ("70", "70", "fallback_identity", 0.8)]


def test_merge_latest_keeps_every_key(spark):
    root, old, new = fresh_path(spark, "lines"), dt.datetime(1995, 6, 16), dt.datetime(1995, 6, 17)
    rows = [(1, 4, old, 1.0), (1, 5, old, 2.0), (2, 7, old, 3.0), (2, 7, new, 4.0), (3, 6, new, 5.0)]
    rows = [(*r, 1, 1, 1.0, 0.0, 0.0) for r in rows]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_extendedprice double, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double").write.parquet(f"{root}/lineitem.parquet")
    merged = sorted((r.l_orderkey, r.l_linenumber, r.l_extendedprice) for r in Q.merge_latest(spark, root).collect())
    assert merged == [(1, 4, 1.0), (1, 5, 2.0), (2, 7, 4.0), (3, 6, 5.0)]


def test_ts_parse_answers_for_every_row(spark):
    root = fresh_path(spark, "times")
    texts = ["2026-05-29T10:00:00", "2026-05-29T10:00:00+02:00", "2026-05-29T10:00:00.250Z", "2026-05-29 10:00:00", "2026-05-29 10:00:00 WAT", "1780266214", "n/a", "", None]
    rows = [("f", n, "telco_a", x) for n, x in enumerate(texts)] + [("f", 99, "telco_c", texts[0])]
    spark.createDataFrame(rows, "source_file string, source_row int, operator_code string, event_time string").write.parquet(f"{root}/operator_feed.parquet")
    got = {r.source_row: (r["at"], str(r.business_date)) for r in Q.ts_parse(spark, root).collect()}
    none, lagos = (None, "None"), ("2026-05-29 09:00:00", "2026-05-29")
    assert got == {0: lagos, 1: ("2026-05-29 08:00:00", "2026-05-29"), 2: ("2026-05-29 10:00:00", "2026-05-29"), 3: lagos, 4: none, 5: none, 6: none, 7: none, 8: none}


def test_epoch_parse_answers_for_every_row(spark):
    root = fresh_path(spark, "epochs")
    values = [1780124480302, 0, -1, 1779736781, 1780124480302000000, None]
    rows = [("f", n, (x, 100 + n)) for n, x in enumerate(values)]
    spark.createDataFrame(rows, "source_file string, source_row int, transaction struct<ts_epoch_ms: long, value_minor: long>").write.parquet(f"{root}/telco_b_feed.parquet")
    got = {r.source_row: (r["at"], float(r.amount)) for r in Q.epoch_parse(spark, root).collect()}
    assert got == {
        0: ("2026-05-30 07:01:20", 1.0), 1: ("1970-01-01 00:00:00", 1.01), 2: ("1969-12-31 23:59:59", 1.02), 3: ("1970-01-21 14:22:16", 1.03), 4: (None, 1.04), 5: (None, 1.05),
    }
