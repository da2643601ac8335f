"""Differences of two copies, against a plain comparison in Python."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.xxh import xxhash64
from ledgerloom.operators import copies
from ledgerloom.operators.copies import CELLS, Side, copy_differences, peel

SCHEMA = "op string, id string, amount decimal(18,4), kind string, day int, event string, k long, bucket int"


def side(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return Side(df, {"op": F.col("op"), "id": F.col("id")}, {"amount": F.col("amount"), "kind": F.col("kind")}, [F.col("day"), F.col("event")])


def expected(a, b):
    def pick(rows):
        out = {}
        for r in sorted(rows, key=lambda r: (r[4], r[5])):
            if r[0] is not None and r[1] is not None:
                out.setdefault((r[0], r[1]), (r[2], r[3]))
        return out

    x, y, out = pick(a), pick(b), set()
    for key in x.keys() | y.keys():
        if key not in y:
            out.add((*key, "not right"))
        elif key not in x:
            out.add((*key, "not left"))
        else:
            out |= {(*key, f) for f, u, v in zip(("amount", "kind"), x[key], y[key]) if u != v}
    return out


def run(spark, a, b):
    got = copy_differences(side(spark, a), side(spark, b), "not left", "not right").collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def rows(n, seed, drop=0.05, change=0.05):
    rng, a, b = random.Random(seed), [], []
    for k in range(n):
        amount = None if rng.random() < 0.02 else Decimal(rng.randrange(10**6)) / 100
        row = [f"op{k % 3}", f"T{k}", amount, rng.choice(["x", "y", None]), rng.randrange(9), f"e{k}", k, 1]
        other = list(row)
        if rng.random() < change:
            field = rng.choice([2, 3])
            other[field] = None if rng.random() < 0.3 else Decimal(1) if field == 2 else "changed"
        if rng.random() > drop:
            a += [tuple(row)] * rng.choice([1, 1, 1, 3])
        if rng.random() > drop:
            b += [tuple(other)] * rng.choice([1, 1, 2])
    return a, b


def test_matches_plain_comparison(spark):
    a, b = rows(3000, 1)
    assert run(spark, a, b) == expected(a, b)


def test_everything_differs_falls_back_to_whole_buckets(spark, monkeypatch):
    a, b = rows(2500, 2, drop=0.0, change=1.0)
    monkeypatch.setattr(copies, "BUCKET_KEYS", 2500)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        a = a + [("op9", f"Z{k}", None, "x", 1, f"z{k}", k, 1) for k in range(4000)]
        assert run(spark, a, b) == expected(a, b)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_shuffled_fetch(spark, monkeypatch):
    monkeypatch.setattr(copies, "BROADCAST_KEYS", 0)
    a, b = rows(800, 3)
    assert run(spark, a, b) == expected(a, b)


@pytest.mark.parametrize("a,b", [([], []), ([("o", "1", None, None, 1, "e", 1, 1)], []), ([], [("o", "1", None, None, 1, "e", 1, 1)])])
def test_empty_sides(spark, a, b):
    assert run(spark, a, b) == expected(a, b)


def test_null_keys_nulls_and_hot_key(spark):
    a = [(None, "1", Decimal(1), "x", 1, "a", 1, 1), ("o", None, Decimal(1), "x", 1, "b", 1, 1), ("o", "2", None, "x", 1, "c", 1, 1)]
    a += [("o", "hot", Decimal(k), "x", 9 - k % 9, f"h{k:05d}", 1, 1) for k in range(3000)]
    b = [("o", "2", Decimal(0), "x", 1, "c", 1, 1), ("o", "hot", Decimal(8), "x", 1, "z", 1, 1)]
    assert run(spark, a, b) == expected(a, b)


def test_peeling_reveals_exactly_the_difference():
    rng = np.random.default_rng(5)
    k, h = rng.integers(-(2**62), 2**62, 1500), rng.integers(-(2**62), 2**62, 1500)
    c = xxhash64(k, h, np.full(1500, copies._CHECK))
    s = rng.choice([-1, 1], 1500)
    cells = np.concatenate([np.mod(xxhash64(k, h, np.full(1500, j)), CELLS) + j * CELLS for j in range(3)])
    found, done = peel(cells, np.tile(s, 3), np.tile(k, 3), np.tile(h, 3), np.tile(c, 3))
    assert done and set(found) == set(k)


def test_hash_equals_sparks(spark):
    df = spark.range(200).select((F.col("id") * 7919 * 104729).alias("a"), (-F.col("id") * 31).alias("b"))
    got = df.select("a", "b", F.xxhash64("a", "b").alias("h")).toPandas()
    assert (xxhash64(got.a.to_numpy(), got.b.to_numpy()) == got.h).all()
