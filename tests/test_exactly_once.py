import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.operators import exactly_once as X
from ledgerloom.operators.exactly_once import IdentifierIndex, Runs, periods, repeated_deliveries
from ledgerloom.storage import fresh_path

SCHEMA = "event string, op string, id string, arrival date, prefix string, verdict int"


def expected(rows):
    best, out = {}, set()
    for e, op, i, day, *_ in sorted(rows, key=lambda r: (r[3] is None, r[3] or dt.date.min, r[0])):
        if op is None or i is None:
            continue
        if (op, i) in best:
            out.add(e)
        else:
            best[(op, i)] = e
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [r[0] for r in repeated_deliveries(df, [F.col("op"), F.col("id")], F.col("event"), F.col("arrival"), **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


def rows(n, seed, hot=0.0):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.03 else dt.date(2025, 10, 1) + dt.timedelta(days=rng.randrange(60))
    out = []
    for k in range(n):
        ident = "HOT" if rng.random() < hot else None if rng.random() < 0.1 else f"T{rng.randrange(n)}"
        out.append((f"e{rng.randrange(10**9):09d}-{k}", rng.choice(["a", "b", None]) if hot == 0 else "a", ident, day(), "clash", 1))
    return out


def test_matches_plain_pass(spark):
    data = rows(4000, 1)
    assert run(spark, data) == expected(data)
    assert run(spark, data, batches=6, merge_every=2) == expected(data)


def test_hot_identifier(spark):
    data = rows(6000, 2, hot=0.4)
    assert run(spark, data) == expected(data)


def test_edges(spark):
    assert run(spark, []) == set()
    assert run(spark, [("e1", "a", None, None, "", 0)]) == set()
    undated = [("e2", "a", "1", None, "", 0), ("e1", "a", "1", None, "", 0), ("e9", "a", "1", dt.date(2025, 1, 1), "", 0)]
    assert run(spark, undated) == {"e1", "e2"}
    only_undated = undated[:2]
    assert run(spark, only_undated) == {"e2"}


def test_incremental_batches_use_the_index(spark):
    index = IdentifierIndex(spark, fresh_path(spark, "test"), 100, merge_every=2)
    seen = []
    for n, ids in enumerate([["A", "B", "A"], ["B", "C"], ["C", "D", "A"], ["E"], ["E", "D"]]):
        df = spark.createDataFrame([(f"{n}-{k}", "o", i, dt.date(2025, 1, 1 + n)) for k, i in enumerate(ids)], "event string, op string, id string, arrival date")
        seen.append({r[0] for r in index.ingest(df, [F.col("op"), F.col("id")], F.col("event"), F.col("arrival")).collect()})
    assert seen == [{"0-2"}, {"1-0"}, {"2-0", "2-2"}, set(), {"4-0", "4-1"}]
    assert len(index.runs) == 2  # merged at the fourth batch


def test_runs_with_equal_high_halves():
    blob = np.array([[1, 1, 1, 5], [2, 4, 9, 0]], dtype=np.int64).tobytes()
    runs = Runs([blob])
    assert runs.contains(np.array([1, 1, 5, 6]), np.array([4, 5, 0, 0])).tolist() == [True, False, True, False]


def test_periods_cover_all_days():
    days = [(None, 3)] + [(dt.date(2025, 1, d), d) for d in range(1, 20)]
    cut = periods(days, 4)
    assert cut[-1][1] is None and cut[0][0] == dt.date(2025, 1, 1) and len(cut) <= 4
    assert periods([], 3) == [] and periods([(None, 2)], 3) == [(None, None)]
    assert X.order_rows(*[np.array([1, 1])] * 3, np.array(["b", "a"]))[0].tolist() == [1, 0]


def batch(spark, n, ids):
    return spark.createDataFrame([(f"{n}-{k}", "o", i, dt.date(2025, 1, 1 + n)) for k, i in enumerate(ids)], "event string, op string, id string, arrival date")


def take(index, df, name=None):
    return sorted(r[0] for r in index.ingest(df, [F.col("op"), F.col("id")], F.col("event"), F.col("arrival"), name).collect())


def test_reopened_index_knows_its_history(spark):
    path = fresh_path(spark, "kept")
    first = IdentifierIndex(spark, path, merge_every=3)
    assert take(first, batch(spark, 0, ["A", "B"]), "m0") == [] and take(first, batch(spark, 1, ["B", "C", "C"]), "m1") == ["1-0", "1-2"]
    again = IdentifierIndex(spark, path, merge_every=3)
    assert take(again, batch(spark, 2, ["A", "D"]), "m2") == ["2-0"]
    assert sorted(r[0] for r in again.copies().collect()) == ["1-0", "1-2", "2-0"] and again.manifests[-1]["merged"]


def test_batch_delivered_again_gets_its_first_verdicts(spark):
    path = fresh_path(spark, "retried")
    index = IdentifierIndex(spark, path)
    assert take(index, batch(spark, 0, ["A", "B", "A"]), "m0") == ["0-2"]
    for again in (index, IdentifierIndex(spark, path)):
        assert take(again, batch(spark, 0, ["A", "B", "A"]), "m0") == ["0-2"] and len(again.manifests) == 1
    assert take(index, batch(spark, 1, ["B"]), "m1") == ["1-0"]


def test_lost_batch_is_done_anew(spark, monkeypatch):
    path = fresh_path(spark, "lost")
    with monkeypatch.context() as m:
        m.setattr(X, "create_text", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        try:
            take(IdentifierIndex(spark, path), batch(spark, 0, ["A", "B"]), "m0")
        except RuntimeError:
            pass
    index = IdentifierIndex(spark, path)
    assert index.manifests == [] and take(index, batch(spark, 0, ["A", "B"]), "m0") == []


def test_two_writers_of_one_number(spark):
    path = fresh_path(spark, "raced")
    a, b = IdentifierIndex(spark, path), IdentifierIndex(spark, path)
    take(a, batch(spark, 0, ["A"]), "m0")
    try:
        take(b, batch(spark, 1, ["A"]), "m1")
        raise AssertionError("the second writer must not win")
    except FileExistsError:
        pass
    assert take(IdentifierIndex(spark, path), batch(spark, 1, ["A"]), "m1") == ["1-0"]


def test_prefixes_split_as_identifiers_accumulate(spark, monkeypatch):
    monkeypatch.setattr(X, "PREFIX_ROWS", 20)
    index = IdentifierIndex(spark, fresh_path(spark, "grown"), merge_every=10)
    seen, counts = set(), []
    for n in range(4):
        ids = [f"T{(k * 37 + n * 211) % 900}" for k in range(250)]
        want = []
        for k, i in enumerate(ids):
            if i in seen:
                want.append(f"{n}-{k}")
            seen.add(i)
        assert take(index, batch(spark, n, ids), f"m{n}") == sorted(want)
        counts.append(index.manifests[-1]["prefixes"])
    assert counts[0] == 8 and counts[-1] >= 32 and sum(m["novel"] for m in index.manifests) == len(seen)
