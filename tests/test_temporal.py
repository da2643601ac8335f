import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators import temporal as T
from ledgerloom.plans import store as S
from ledgerloom.storage import fresh_path

D = dt.date


def test_versions_arriving_in_any_order_and_again(spark):
    versions = [("a", D(2026, 1, 1), "1"), ("a", D(2026, 2, 1), "1"), ("a", D(2026, 3, 1), "2"), ("a", D(2026, 4, 1), "3"), ("b", D(2026, 1, 1), "9")]
    frame = lambda rows: spark.createDataFrame(rows, "k string, effective_from date, content string")
    want = {("a", D(2026, 1, 1), D(2026, 3, 1)), ("a", D(2026, 3, 1), D(2026, 4, 1)), ("a", D(2026, 4, 1), T.OPEN_END), ("b", D(2026, 1, 1), T.OPEN_END)}
    for seed in range(3):
        random.Random(seed).shuffle(versions)
        history = T.merge_versions(frame(versions[:0]), frame(versions[:3]), ["k"], "effective_from", "content")
        full = T.merge_versions(frame([v for v in versions[:3]]), frame(versions), ["k"], "effective_from", "content")
        assert {(r.k, r.effective_from, r.effective_to) for r in full.collect()} == want
        assert history.count() <= 3
        again = T.merge_versions(full.select("k", "effective_from", "content"), frame(versions), ["k"], "effective_from", "content")
        assert again.where("is_current").count() == 2
    corrected = T.merge_versions(frame(versions), frame([("a", D(2026, 3, 1), "1")]), ["k"], "effective_from", "content")
    assert corrected.where("k = 'a'").count() == 2


def test_fill(spark):
    rows = [("x", D(2026, 1, 1), 1), ("x", D(2026, 1, 5), 2), ("y", D(2026, 1, 3), 7)]
    got = {(r.k, r.day.day): r.v for r in T.fill_daily(spark.createDataFrame(rows, "k string, day date, v int"), "k", "day", "v").collect()}
    assert [got[("x", d)] for d in range(1, 6)] == [1, 1, 1, 1, 2] and [got[("y", d)] for d in range(1, 6)] == [None, None, 7, 7, 7]
    assert T.fill_daily(spark.createDataFrame([], "k string, day date, v int"), "k", "day", "v").count() == 0


def test_store(spark):
    tables = S.TableStore(spark, fresh_path(spark, "store"))
    frame = lambda rows: spark.createDataFrame(rows, "k string, content string, n int, day date")
    order = [F.col("n").desc()]
    tables.upsert("t", frame([("a", "1", 1, D(2026, 1, 1)), ("a", "2", 2, D(2026, 1, 1)), ("b", "1", 1, D(2026, 2, 1))]), ["k"], "content", order)
    before = tables.path("t")
    tables.upsert("t", frame([("b", "5", 9, D(2026, 2, 1)), ("c", "1", 1, D(2026, 2, 2)), ("a", "2", 7, D(2026, 1, 1))]), ["k"], "content", order)
    assert {(r.k, r.content, r.n) for r in tables.read("t").collect()} == {("a", "2", 2), ("b", "5", 9), ("c", "1", 1)} and tables.path("t") != before
    scope = spark.createDataFrame([(D(2026, 2, 1),), (D(2026, 2, 2),)], "day date")
    tables.overwrite_days("t", frame([("z", "1", 1, D(2026, 2, 2))]), "day", scope, ["day"])
    assert {r.k for r in tables.read("t").collect()} == {"a", "z"}  # the first day's rows are gone, not stale
    tables.append("log", frame([("a", "1", 1, None)]))
    tables.append("log", frame([("b", "1", 1, None)]))
    assert tables.read("log").count() == 2
    S.close_period(tables, "2026-02", "me", F.lit("2026-03-01").cast("timestamp"))
    S.close_period(tables, "2026-02", "you", F.lit("2026-03-02").cast("timestamp"))
    control = tables.read("recon_period_control")
    assert control.count() == 1 and S.is_closed(control, "2026-02") and not S.is_closed(control, "2026-01")
    try:
        tables.overwrite_days("t", frame([]), "day", scope, ["day"], control)
        raise AssertionError("a closed month was rewritten")
    except S.ClosedPeriod as e:
        assert "2026-02" in str(e)
    tables.upsert_versions("v", frame([("a", "1", 1, D(2026, 1, 1))]), ["k"], "day", "content")
    tables.upsert_versions("v", frame([("a", "2", 1, D(2026, 2, 1))]), ["k"], "day", "content")
    assert tables.read("v").count() == 2 and tables.read("v").where("is_current").count() == 1
