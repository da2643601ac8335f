import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators import asof
from ledgerloom.operators.asof import Versions, current_states, valid_at

E, V = "row string, entity string, day date, said string, value string", "entity string, start date, stop date, p1 int, p2 int, value string, day int"
D = lambda n: None if n is None else dt.date(2025, 1, 1) + dt.timedelta(days=n)


def plain(events, versions):
    out = {}
    for row, entity, day, *_ in events:
        ok = [v for v in versions if None not in (entity, day, v[0], v[1], v[5]) and v[0] == entity and v[1] <= day and (v[2] is None or v[2] > day)]
        best = min(ok, key=lambda v: (-(v[3] or 0), -(v[4] or 0), v[5]), default=None)
        out[row] = best and best[5]
    return out


def run(spark, events, versions):
    e, v = spark.createDataFrame(events, E), spark.createDataFrame(versions, V)
    got = valid_at(e, "row", F.col("entity"), F.col("day"), Versions(v, F.col("entity"), F.col("start"), F.col("stop"), (F.col("p1"), F.col("p2")), F.col("value")), F.col("said")).collect()
    assert len(got) == len(events)
    assert all(r.carried == dict((x[0], x[3]) for x in events)[r.row_id] for r in got)
    return {r.row_id: r.value for r in got}


def made(n, m, seed, hot=0.0):
    rng = random.Random(seed)
    who = lambda: "hot" if rng.random() < hot else None if rng.random() < 0.03 else f"E{rng.randrange(20)}"
    events = [(f"r{k}", who(), None if rng.random() < 0.02 else D(rng.randrange(100)), f"s{k}", "x") for k in range(n)]
    versions = []
    for k in range(m):
        start = None if rng.random() < 0.03 else rng.randrange(-20, 100)
        stop = None if start is None or rng.random() < 0.4 else start + rng.randrange(-2, 40)
        versions += [(who(), D(start), D(stop), rng.randrange(6), rng.choice([None, 1, 2]), f"v{k}", 1)] * rng.choice([1, 1, 2])
    return events, versions


def test_matches_plain_search(spark):
    events, versions = made(1500, 150, 1)
    assert run(spark, events, versions) == plain(events, versions)


def test_hot_entity_is_split(spark, monkeypatch):
    monkeypatch.setattr(asof, "BUCKET_ROWS", 100)
    events, versions = made(1500, 150, 2, hot=0.4)
    assert run(spark, events, versions) == plain(events, versions)
    monkeypatch.setattr(asof, "BROADCAST_HOT", 0)
    assert run(spark, events, versions) == plain(events, versions)


def test_empty_sides(spark):
    events, versions = made(20, 10, 3)
    assert run(spark, events, []) == {e[0]: None for e in events}
    assert run(spark, [], versions) == {}


def test_states_of_nested_intervals():
    import numpy as np

    a = lambda *x: np.array(x)
    states = current_states(a("e", "e"), a(0, 5), a(100, 10), a(0, 5), a(0, 0), a("wide", "inner"))
    assert sorted(states, key=lambda s: s[1]) == [("e", 0, "wide"), ("e", 5, "inner"), ("e", 10, "wide"), ("e", 100, None)]
