import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators.late_events import DeltaLog, LateEvents, apply_deltas
from ledgerloom.plans.store import TableStore
from ledgerloom.storage import fresh_path

SCHEMA = "event string, op string, day date, arrival date, amount decimal(18,4), version string, total int"


def data(n=800, seed=3):
    rng, out = random.Random(seed), []
    for k in range(n):
        day = dt.date(2025, 10, 1) + dt.timedelta(days=rng.randrange(12))
        arrival = None if rng.random() < 0.02 else day + dt.timedelta(days=rng.choice([-1, 0, 0, 1, 1, 2, 3, 7, 8, 20]))
        out.append((f"e{k}", rng.choice(["a", "b"]), None if rng.random() < 0.02 else day, arrival, None if rng.random() < 0.05 else Decimal(rng.randrange(1000)), "x", 1))
    return out


def make(spark, rows):
    return LateEvents(spark.createDataFrame(rows, SCHEMA), ["op"], "day", "arrival", "amount")


def plain(rows, upto):
    out = {}
    for _, op, day, arrival, amount, *_ in rows:
        if day is None or arrival is None or (arrival - day).days > 7 or arrival > upto:
            continue
        n, t = out.get((op, day), (0, None))
        out[(op, day)] = (n + 1, t if amount is None else (t or 0) + amount)
    return out


def test_every_version_adds_up(spark):
    rows = data()
    late = make(spark, rows)
    for upto in (dt.date(2025, 10, 3), dt.date(2025, 10, 9), dt.date(2026, 1, 1)):
        got = {(r.op, r.day): (r.rows_count, r.total) for r in late.as_of(F.lit(upto)).collect()}
        want = plain(rows, upto)
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert {k: v[1] or 0 for k, v in got.items()} == {k: v[1] or 0 for k, v in want.items()}


def test_corrections_come_in_pairs_and_downstream_agrees(spark):
    late = make(spark, data())
    log = late.changelog().cache()
    kinds = {(r["kind"], r["sign"]): r["count"] for r in log.groupBy("kind", "sign").count().collect()}
    assert kinds[("correction", -1)] == kinds[("correction", 1)] and ("rejected", 0) in kinds
    totals = {r.op: r.rows_count for r in apply_deltas(log.where("sign != 0"), ["op"]).collect()}
    want = {}
    for (op, _), (n, _) in plain(data(), dt.date(2030, 1, 1)).items():
        want[op] = want.get(op, 0) + n
    assert totals == want


def test_late_events_are_found(spark):
    rows = data()
    got = {(r.event, r.lateness) for r in make(spark, rows).corrected_by().collect()}
    want = set()
    for e, _, day, arrival, *_ in rows:
        if day and arrival and (arrival - day).days >= 2:
            want.add((e, "too_late" if (arrival - day).days > 7 else "late"))
    assert got == want


def test_empty(spark):
    late = make(spark, [])
    assert late.changelog().count() == 0 and late.corrected_by().count() == 0 and late.as_of().count() == 0


def test_kept_state_equals_recomputation_after_every_batch(spark):
    """Batches of arrivals against the kept log: after each, the aggregates and a downstream total are those of a full run."""
    rows = data(500, 11)
    log = DeltaLog(TableStore(spark, fresh_path(spark, "log")), "d")
    days = sorted({r[3] for r in rows if r[3]})
    cuts = [days[len(days) * k // 4] for k in range(1, 4)] + [dt.date(2100, 1, 1)]
    before = dt.date(1900, 1, 1)
    for n, upto in enumerate(cuts):
        batch = [r for r in rows if r[3] and before < r[3] <= upto]
        assert log.take(make(spark, batch), f"b{n}") and not log.take(make(spark, batch), f"b{n}")
        want = plain(rows, upto)
        got = {(r.op, r.day): (r.rows_count, r.total) for r in log.state(["op", "day"]).collect()}
        assert {k: (v[0], v[1] or 0) for k, v in got.items()} == {k: (v[0], v[1] or 0) for k, v in want.items()}
        totals = {}
        for (op, _), (k, _) in want.items():
            totals[op] = totals.get(op, 0) + k
        assert {r.op: r.rows_count for r in log.state(["op"]).collect()} == totals
        before = upto
    emitted = log.deltas()
    assert emitted.where("sign = -1 AND batch = 'b1'").count() > 0 and emitted.where("kind = 'first' AND sign != 1").count() == 0
    whole = make(spark, rows).changelog().select("op", "day", "version", "lateness", "kind", "sign", "rows_count", F.col("total").cast("decimal(38,4)"))
    kept = emitted.select(whole.columns)
    assert whole.exceptAll(kept).count() == 0 and kept.exceptAll(whole).count() == 0


def test_log_of_nothing(spark):
    log = DeltaLog(TableStore(spark, fresh_path(spark, "log")), "d")
    assert log.take(make(spark, []), "b0") and log.state(["op", "day"]).count() == 0
    assert log.take(make(spark, [("e", "a", dt.date(2025, 1, 1), dt.date(2025, 1, 1), None, "x", 1)]), "b1")
    assert [tuple(r) for r in log.state(["op"]).collect()] == [("a", 1, None)]
