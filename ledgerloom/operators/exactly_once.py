"""Messages delivered more than once: an identifier index of sorted arrays by hash prefix.

The index is a set of immutable *runs*. A run holds, per hash prefix, the sorted 128-bit hashes of identifiers seen
in one batch. A batch is processed prefix by prefix: its rows are deduplicated locally, the survivors are looked up
by binary search in the runs of that prefix, and the novel ones become a new run. After every ``merge_every`` batches
the runs of each prefix are merged into one. Runs and verdicts are parquet tables in the shared folder, so a lost
executor costs a re-read.

The index persists: a batch is in it once its manifest, a small file of its own, has been created. Opening an index at a
path reads the manifests that are there; a batch delivered again under its id gets the verdicts it got the first time,
and a batch that was lost half-way left no manifest and is done anew. Prefixes double as identifiers accumulate, when
runs are merged, so that a prefix stays bounded over the life of the index.

Defined results:
* the copy kept is that of the smallest (arrival, row id); a NULL arrival comes after every date;
* rows whose identifier is NULL identify nothing: none of them is a copy;
* repeated rows with the same row id and arrival count as one row (all or none of them are dropped, the tie leaves one);
* an empty table gives an empty result; columns other than the named ones are never read, whatever their names.

Scale: a hot identifier is cut down inside each Arrow batch before any shuffle (its copies then travel under a
salted prefix), prefixes hold a bounded number of rows since their number follows the row count, and nothing is
collected but the histogram of arrival days and the number of identifiers of a batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.storage import create_text, fresh_path, list_texts

#: Rows of a batch that one prefix should hold on average.
PREFIX_ROWS = 40_000
_SALTS = 64
_FAR_DAY = 2_900_000

_MARKED = "row_id string, arrival int, hi long, lo long, prefix int, verdict int"
_OUT = "verdict int, row_id string, prefix int, ids binary, novel long"
_OUT_ARROW = pa.schema([("verdict", pa.int32()), ("row_id", pa.string()), ("prefix", pa.int32()), ("ids", pa.binary()), ("novel", pa.int64())])
#: Bits of the identifier's hash that Spark's partitioner, which hashes the prefix itself, has no part in.
_SHIFT = 24
NOVEL, COPY, RUN = 0, 1, 2


def order_rows(hi: np.ndarray, lo: np.ndarray, arrival: np.ndarray, row_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by identifier, arrival and row id; and which of the rows so ordered open a new identifier."""
    order = np.lexsort((row_id, arrival, lo, hi))
    h, l = hi[order], lo[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    return order, first


class Runs:
    """The sorted identifier arrays of one prefix."""

    def __init__(self, blobs: list[bytes]):
        self.arrays = [np.frombuffer(b, dtype=np.int64).reshape(2, -1) for b in blobs]

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Binary search in every run; equal high halves are told apart by the low halves."""
        seen = np.zeros(len(hi), dtype=bool)
        for run_hi, run_lo in self.arrays:
            left, right = np.searchsorted(run_hi, hi, "left"), np.searchsorted(run_hi, hi, "right")
            one = right - left == 1
            seen[one] |= run_lo[left[one]] == lo[one]
            for k in np.flatnonzero(right - left > 1):
                seen[k] |= bool((run_lo[left[k] : right[k]] == lo[k]).any())
        return seen

    def merged(self, prefix: int, prefixes: int) -> bytes:
        """One run of the identifiers that belong to the prefix: runs of fewer prefixes hold others' too."""
        if not self.arrays:
            return b""
        both = np.concatenate(self.arrays, axis=1)
        both = both[:, (both[0].view(np.uint64) >> np.uint64(_SHIFT)) % np.uint64(prefixes) == prefix]
        return both[:, np.lexsort((both[1], both[0]))].tobytes()


def _text(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype="U") if len(column) else np.array([], dtype="U1")


def _mark_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each Arrow batch: the first row of an identifier goes to its prefix, the others to salted ones."""
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo = batch["hi"].to_numpy(), batch["lo"].to_numpy()
        order, first = order_rows(hi, lo, batch["arrival"].to_numpy(), _text(batch["row_id"]))
        verdict = np.full(len(order), COPY, dtype=np.int32)
        verdict[order[first]] = NOVEL
        salted = (-1 - np.arange(len(order)) % _SALTS).astype(np.int32)
        prefix = np.where(verdict == NOVEL, batch["prefix"].to_numpy(), salted).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch["row_id"], batch["arrival"], batch["hi"], batch["lo"], pa.array(prefix), pa.array(verdict)],
            names=["row_id", "arrival", "hi", "lo", "prefix", "verdict"],
        )


def _probe(merge: bool, prefixes: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def probe(batch: pa.Table, index: pa.Table) -> pa.Table:
        runs = Runs([b for b in index["ids"].to_pylist() if b])
        verdicts, ids, blobs, counts = [], [], [], []
        prefix = (batch["prefix"] if batch.num_rows else index["prefix"])[0].as_py()
        novel = np.zeros((2, 0), dtype=np.int64)
        if batch.num_rows:
            if prefix < 0:
                verdict = np.full(batch.num_rows, COPY, dtype=np.int32)
            else:
                hi, lo = batch["hi"].to_numpy(), batch["lo"].to_numpy()
                order, first = order_rows(hi, lo, batch["arrival"].to_numpy(), _text(batch["row_id"].combine_chunks()))
                first &= ~runs.contains(hi[order], lo[order])
                verdict = np.full(len(order), COPY, dtype=np.int32)
                verdict[order[first]] = NOVEL
                novel = np.stack([hi[order[first]], lo[order[first]]])
            copies = pa.array(np.flatnonzero(verdict == COPY))
            verdicts, ids = [COPY] * len(copies), batch["row_id"].take(copies).to_pylist()
            blobs, counts = [None] * len(copies), [None] * len(copies)
        fresh = novel.shape[1]
        if merge and fresh:
            runs.arrays.append(novel)
        run = runs.merged(prefix, prefixes) if merge and prefix >= 0 else novel.tobytes()
        if run:
            verdicts, ids, blobs, counts = [*verdicts, RUN], [*ids, None], [*blobs, run], [*counts, fresh]
        return pa.table([verdicts, ids, [prefix] * len(verdicts), blobs, counts], schema=_OUT_ARROW)

    return probe


@dataclass
class IdentifierIndex:
    """The persistent index. ``ingest`` takes batches in order of arrival and returns the row ids that are copies.

    An index belongs to one stream of messages. ``expected_rows`` only sets the number of prefixes to begin with.
    """

    spark: SparkSession
    path: str
    expected_rows: int = 0
    merge_every: int = 4
    manifests: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.manifests = sorted((json.loads(t) for t in list_texts(self.spark, f"{self.path}/manifests")), key=lambda m: m["number"])

    @property
    def prefixes(self) -> int:
        """A power of two, so that a prefix splits into two when it doubles."""
        rows = max(self.expected_rows, sum(m["novel"] for m in self.manifests))
        wanted = 1 << max(3, (-(-rows // PREFIX_ROWS) - 1).bit_length())
        return max([wanted, *(m["prefixes"] for m in self.manifests)])

    @property
    def runs(self) -> list[dict]:
        """The manifests whose runs make up the index: the last merge and what came after it."""
        last = max((k for k, m in enumerate(self.manifests) if m["merged"]), default=0)
        return self.manifests[last:]

    def ingest(self, batch: DataFrame, key: list[Column], row_id: Column, arrival: Column, batch_id: str | None = None) -> DataFrame:
        """Row ids of the batch that are copies. ``batch_id`` names the batch: under the id of an earlier one nothing is
        added and the earlier verdicts are returned. Without an id every call is a batch of its own."""
        known = next((m for m in self.manifests if batch_id is not None and m["id"] == batch_id), None)
        if known:
            return self._read([known], COPY).select("row_id")
        number, prefixes = len(self.manifests) + 1, self.prefixes
        hi = F.xxhash64(*key)
        rows = batch.select(
            row_id.cast("string").alias("row_id"),
            F.coalesce(F.unix_date(arrival), F.lit(_FAR_DAY)).alias("arrival"),
            hi.alias("hi"),
            F.xxhash64(*reversed(key), F.lit("second half")).alias("lo"),
            F.pmod(F.shiftrightunsigned(hi, _SHIFT), F.lit(prefixes)).cast("int").alias("prefix"),
        )
        marked = rows.mapInArrow(_mark_local, _MARKED)
        # Runs that were written with fewer prefixes are offered to all that theirs have split into, and merged at once.
        merge = number % self.merge_every == 0 or any(m["prefixes"] < prefixes for m in self.runs)
        index = self._read([], RUN)
        for m in self.runs:
            step = m["prefixes"]
            split = F.explode(F.sequence(F.col("prefix"), F.col("prefix") + F.lit(prefixes - step), F.lit(step)))
            index = index.unionByName(self._read([m], RUN).withColumn("prefix", split) if step < prefixes else self._read([m], RUN))
        out = f"batch-{number:06d}-{uuid.uuid4().hex[:8]}"
        found = marked.groupBy("prefix").cogroup(index.select("prefix", "ids").groupBy("prefix")).applyInArrow(_probe(merge, prefixes), _OUT)
        found.write.partitionBy("verdict").parquet(f"{self.path}/{out}")
        manifest = {"number": number, "id": batch_id if batch_id is not None else f"unnamed-{number}", "out": out, "merged": merge, "prefixes": prefixes}
        manifest["novel"] = self._read([manifest], RUN).agg(F.sum("novel")).first()[0] or 0
        # Whoever else has written this number in the meantime was first: creating the file again raises.
        create_text(self.spark, f"{self.path}/manifests/{number:06d}.json", json.dumps(manifest))
        self.manifests.append(manifest)
        return self._read([manifest], COPY).select("row_id")

    def copies(self) -> DataFrame:
        """All row ids found to be copies so far."""
        return self._read(self.manifests, COPY).select("row_id")

    def _read(self, manifests: list[dict], verdict: int) -> DataFrame:
        schema = "row_id string, prefix int, ids binary, novel long, verdict int"
        tables = [self.spark.read.schema(schema).parquet(f"{self.path}/{m['out']}").where(F.col("verdict") == verdict) for m in manifests]
        return reduce(DataFrame.union, tables) if tables else self.spark.createDataFrame([], schema)


def repeated_deliveries(
    df: DataFrame, key: list[Column], row_id: Column, arrival: Column, batches: int = 3, merge_every: int = 2
) -> DataFrame:
    """Row ids to drop so that one row of each message is left, by replaying ``df`` through an ``IdentifierIndex``.

    ``key``: the columns of a message's identity; a row with a NULL among them has no identity. The replay cuts the
    arrival days into ``batches`` periods of about equal row counts; only that histogram of days is collected.
    """
    spark = df.sparkSession
    known = reduce(lambda a, b: a & b, [k.isNotNull() for k in key])
    rows = df.where(known)
    days = rows.groupBy(arrival.alias("day")).count().orderBy(F.col("day").asc_nulls_last()).collect()
    index = IdentifierIndex(spark, fresh_path(spark, "ids"), sum(d["count"] for d in days), merge_every)
    for low, high in periods([(d["day"], d["count"]) for d in days], batches):
        inside = arrival >= F.lit(low) if low is not None else arrival.isNull()
        if low is not None and high is not None:
            inside = inside & (arrival <= F.lit(high))
        elif low is not None:
            inside = inside | arrival.isNull()
        index.ingest(rows.where(inside), key, row_id, arrival)
    return index.copies()


def periods(days: list[tuple], batches: int) -> list[tuple]:
    """Closed ranges of days of about equal counts; the last is open and takes the rows without a day."""
    total, out, held, low = sum(n for _, n in days), [], 0, None
    dated = [(d, n) for d, n in days if d is not None]
    if not dated:
        return [(None, None)] if days else []
    for k, (day, n) in enumerate(dated):
        low = day if low is None else low
        held += n
        if k == len(dated) - 1:
            out.append((low, None))
        elif held * batches >= total and len(out) < batches - 1:
            out.append((low, day))
            held, low = 0, None
    return out
