"""Differences between two copies of a dataset, by invertible Bloom lookup tables.

Each side reduces its rows to one *element* per key: a hash of the key and a hash of the whole row. Elements are
added to a lookup table per hash bucket: three cells each, a cell holding a signed count and the XOR of key hashes,
row hashes and check hashes. The tables of the two sides are subtracted (equal rows vanish), and what is left is
peeled bucket by bucket, which reveals the key hashes of rows that one side lacks or that differ. Only the rows of
those keys are then fetched from both sides and compared field by field on their real keys.

Defined results:
* repeated rows of one side count once: of several rows with a key, the one with the smallest ``order`` stands for it
  (ties in the order: the smallest values);
* a row with a NULL in its key identifies nothing and is left out;
* NULL differs from every value and equals NULL;
* a hash collision cannot hide a difference between keys: revealed hashes are only used to fetch, the comparison is on
  the key columns; two row versions are taken as equal only if their 64-bit row hashes (which include the key) agree;
* a bucket too full to be peeled loses nothing: all its rows are fetched and compared;
* an empty side reports every key of the other as missing; two empty sides give an empty result.

Scale: rows are reduced to one per key with map-side aggregation (a hot key costs a task one row), buckets follow the
row count, cells are aggregated map-side, and each peeled group has the fixed size of one table. The revealed keys are
broadcast only below ``BROADCAST_KEYS``; above it the fetch is a shuffled semi-join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import null_safe_hash
from ledgerloom.functions.xxh import xxhash64
from ledgerloom.storage import materialize

#: Keys of one side that a bucket should hold on average, and cells of each of its three subtables.
BUCKET_KEYS, CELLS = 16_384, 2_048
#: About 110 bytes a key in Spark's hash table: at most 22 MB are broadcast, more keys are fetched by a shuffled join.
BROADCAST_KEYS = 200_000
_CHECK = 0x5EED


@dataclass(frozen=True)
class Side:
    """One copy: its rows, the key, the compared fields (by common name) and what orders repeated rows of a key."""

    rows: DataFrame
    key: dict[str, Column]
    fields: dict[str, Column]
    order: list[Column]


def _keyed(side: Side) -> DataFrame:
    """Rows with an identity, under names of our own (the source's other columns may clash with them)."""
    key = [c.alias(f"k_{n}") for n, c in side.key.items()]
    fields = [c.alias(f"v_{n}") for n, c in side.fields.items()]
    order = [c.alias(f"o_{i}") for i, c in enumerate(side.order)]
    rows = side.rows.select(*key, *fields, *order)
    return rows.dropna(subset=[f"k_{n}" for n in side.key])


def _representatives(rows: DataFrame, side: Side) -> DataFrame:
    """One row per key."""
    names, values = [f"k_{n}" for n in side.key], [f"v_{n}" for n in side.fields]
    order = [c for c in rows.columns if c.startswith("o_")]
    best = F.min(F.struct(*order, *values)).alias("best")
    return rows.groupBy(*names).agg(best).select(*names, *[F.col(f"best.{v}").alias(v) for v in values])


def _elements(side: Side, buckets: int, sign: int) -> DataFrame:
    one = _representatives(_keyed(side), side)
    names = [F.col(f"k_{n}") for n in side.key]
    fields = [F.col(f"v_{n}") for n in side.fields]
    # The bucket is a function of the hash by which the aggregation above has partitioned its rows; with a multiple of
    # the shuffle partitions as their number, a bucket's cells are all aggregated where they arise.
    one = one.select(
        F.pmod(F.hash(*names), F.lit(buckets)).alias("bucket"),
        F.xxhash64(*names).alias("k"),
        null_safe_hash(F.lit("row"), *names, *fields).alias("h"),
    )
    places = [F.pmod(F.xxhash64("k", "h", F.lit(j).cast("long")), F.lit(CELLS)) + F.lit(j * CELLS) for j in range(3)]
    return one.select(
        "bucket", "k", "h", F.xxhash64("k", "h", F.lit(_CHECK).cast("long")).alias("c"), F.lit(sign).alias("s"),
        F.explode(F.array(*[p.cast("int") for p in places])).alias("cell"),
    )


def _table(elements: DataFrame) -> DataFrame:
    """The lookup tables of one side: signed counts and XORs by bucket and cell."""
    return elements.groupBy("bucket", "cell").agg(
        F.sum("s").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.bit_xor("c").alias("c")
    )


def peel(cell: np.ndarray, n: np.ndarray, k: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, bool]:
    """The key hashes that a subtracted table reveals, and whether nothing is left over.

    All pure cells of a round are peeled at once; an element found in several cells counts once.
    """
    N, K, H, C = (np.zeros(3 * CELLS, dtype=np.int64) for _ in range(4))
    np.add.at(N, cell, n)
    for into, of in ((K, k), (H, h), (C, c)):
        np.bitwise_xor.at(into, cell, of)
    found: list[np.ndarray] = []
    for _ in range(6 * CELLS):
        at = np.flatnonzero(np.abs(N) == 1)
        if len(at):
            pure = xxhash64(K[at], H[at], np.full(len(at), _CHECK, dtype=np.int64)) == C[at]
            at = at[pure]
        if not len(at):
            break
        _, one = np.unique(np.stack([K[at], H[at]]), axis=1, return_index=True)
        at = at[one]
        pk, ph, pc, pn = K[at], H[at], C[at], N[at]
        found.append(pk)
        for j in range(3):
            place = np.mod(xxhash64(pk, ph, np.full(len(pk), j, dtype=np.int64)), CELLS) + j * CELLS
            np.subtract.at(N, place, pn)
            for into, of in ((K, pk), (H, ph), (C, pc)):
                np.bitwise_xor.at(into, place, of)
    done = not (N.any() or K.any() or H.any() or C.any())
    return (np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)), done


def _peel_bucket(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
    keys, done = peel(*(cells[x].to_numpy(np.int64) for x in ("cell", "n", "k", "h", "c")))
    if not done:
        return pd.DataFrame({"bucket": np.array([key[0]], np.int32), "k": np.zeros(1, np.int64), "whole": [True]})
    return pd.DataFrame({"bucket": np.full(len(keys), key[0], np.int32), "k": keys, "whole": np.zeros(len(keys), bool)})


def _pairwise(both: DataFrame, names: list[str], fields: list[str], labels: tuple[str, str]) -> DataFrame:
    a, b = F.col("a.x").isNotNull(), F.col("b.x").isNotNull()
    said = [F.when(~b, F.lit(labels[1])), F.when(~a, F.lit(labels[0]))]
    said += [F.when(a & b & ~F.col(f"a.v_{f}").eqNullSafe(F.col(f"b.v_{f}")), F.lit(f)) for f in fields]
    out = both.select(*[f"k_{n}" for n in names], F.explode(F.array_compact(F.array(*said))).alias("difference"))
    return out.toDF(*names, "difference")


def copy_differences(left: Side, right: Side, missing_left: str, missing_right: str) -> DataFrame:
    """One row per key that a side lacks and per field of a common key that differs: key columns and ``difference``."""
    spark = left.rows.sparkSession
    names, fields = list(left.key), list(left.fields)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(left.rows.count(), right.rows.count())
    buckets = partitions * max(1, -(-rows // (BUCKET_KEYS * partitions)))
    tables = _table(_elements(left, buckets, 1)).unionByName(_table(_elements(right, buckets, -1)))
    subtracted = tables.groupBy("bucket", "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.bit_xor("c").alias("c")
    )
    left_over = subtracted.where("n != 0 OR k != 0 OR h != 0 OR c != 0")
    peeled = left_over.groupBy("bucket").applyInPandas(_peel_bucket, "bucket int, k long, whole boolean")
    peeled = materialize(peeled, "peeled")
    revealed = peeled.where("NOT whole").select("bucket", "k").distinct()
    full = peeled.where("whole").select("bucket").distinct()
    few, full_buckets = revealed.count() <= BROADCAST_KEYS, full.count()

    def fetch(side: Side) -> DataFrame:
        rows = _keyed(side)
        key = [F.col(f"k_{n}") for n in side.key]
        rows = rows.withColumn("bucket", F.pmod(F.hash(*key), F.lit(buckets))).withColumn("k", F.xxhash64(*key))
        wanted = rows.join(F.broadcast(revealed) if few else revealed, ["bucket", "k"], "left_semi")
        if full_buckets:
            wanted = wanted.unionByName(rows.join(F.broadcast(full) if full_buckets <= BROADCAST_KEYS else full, "bucket", "left_semi"))
        return _representatives(wanted, side).withColumn("x", F.lit(True))

    on = [f"k_{n}" for n in names]
    a, b = fetch(left).alias("a"), fetch(right).alias("b")
    return _pairwise(a.join(b, on, "full_outer"), names, fields, (missing_left, missing_right))
