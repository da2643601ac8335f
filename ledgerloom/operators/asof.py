"""Attributes as known at event time: an as-of join per bucket of entities, by an embedded DuckDB.

Versions of an entity hold from the day they are both effective and known, until they end. They are first turned into
*current states*: for each day on which the best valid version changes, the version that is best from then on (or
none). "Best" is the greatest priority among those valid; equal priorities are resolved here, before any event is seen,
by the smallest value. Then each event takes the last state on or before its date: DuckDB's ``ASOF LEFT JOIN``, run
once for each bucket, over all entities of the bucket.

Defined results: an event with a NULL entity or date, or with no valid version, gets NULL (such events are spread
over all buckets); a version with a NULL start
or entity never holds; one that ends on or before its start never holds; repeated versions are one; events are neither
lost nor repeated, whatever repeats on either side; empty sides are allowed.

Scale: entities are hashed to buckets whose number follows the rows, so a task joins a bounded number of events. Events
of a hot entity (more than ``BUCKET_ROWS``) are salted over several buckets, to each of which that entity's
versions are copied; the list of hot entities, at most rows / ``BUCKET_ROWS``, is broadcast only if it is short.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.storage import materialize

#: Events that a bucket should hold on average; an entity with more is split.
BUCKET_ROWS = 40_000
#: Hot entities that are broadcast at most, a few megabytes.
BROADCAST_HOT = 50_000


@dataclass(frozen=True)
class Versions:
    """Versions: entity, when they become valid (a date), when they end (a date or NULL), priority, value.

    ``priority``: two orderable integer columns (the later one breaks ties of the first)."""

    rows: DataFrame
    entity: Column
    start: Column
    end: Column
    priority: tuple[Column, Column]
    value: Column


def current_states(entity, start, end, first, second, value) -> list[tuple[str, int, str | None]]:
    """(entity, day, value): from that day on, value is the best valid version (None: none is valid).

    A sweep over each entity's starts with a heap of the versions that hold; ends are met lazily. O(n log n)."""
    order = np.lexsort((start, entity))
    out: list[tuple[str, int, str | None]] = []
    k, n = 0, len(order)
    while k < n:
        e, heap = entity[order[k]], []
        states: list[tuple[str, int, str | None]] = []

        def advance(day, heap=heap, states=states, e=e):
            """Drop versions that end on or before ``day``, at the days they end."""
            while heap and heap[0][3] <= day:
                ended = heapq.heappop(heap)[3]
                while heap and heap[0][3] <= ended:
                    heapq.heappop(heap)
                states.append((e, ended, heap[0][2] if heap else None))

        while k < n and entity[order[k]] == e:
            day = start[order[k]]
            advance(day)
            while k < n and entity[order[k]] == e and start[order[k]] == day:
                i = order[k]
                if end[i] > day:
                    heapq.heappush(heap, (-first[i], -second[i], value[i], end[i]))
                k += 1
            if heap:
                states.append((e, day, heap[0][2]))
        advance(_NEVER - 1)
        last: dict[int, str | None] = {}
        for _, day, v in states:
            last[day] = v
        out += [(e, day, v) for day, v in last.items()]
    return out


_NEVER = 2_932_896  # 9999-12-31 in days


def _join_bucket(events: pd.DataFrame, versions: pd.DataFrame) -> pd.DataFrame:
    import duckdb

    if not len(events):
        return pd.DataFrame({"row_id": [], "carried": [], "value": []}).astype("object")
    e = events[["row_id", "entity", "day", "carried"]]
    arrays = [versions[c].to_numpy() for c in ("entity", "start", "end", "p1", "p2", "value")]
    states = pd.DataFrame(current_states(*arrays) if len(versions) else [], columns=["entity", "day", "value"])
    states = states.astype({"entity": "object", "day": "int64", "value": "object"})
    with duckdb.connect(config={"threads": 1, "memory_limit": "400MB"}) as db:
        db.register("e", e)
        db.register("s", states)
        return db.execute(
            "SELECT e.row_id, CAST(e.carried AS VARCHAR) AS carried, CAST(s.value AS VARCHAR) AS value FROM e "
            "ASOF LEFT JOIN s ON CAST(e.entity AS VARCHAR) = CAST(s.entity AS VARCHAR) AND e.day >= s.day"
        ).df()


def valid_at(events: DataFrame, row_id: str, entity: Column, day: Column, versions: Versions, carried: Column | None = None) -> DataFrame:
    """row_id, carried, value: for every event the value valid on its day (NULL: none), and what it carries along."""
    carried = F.lit(None) if carried is None else carried
    e = events.select(
        F.col(row_id).cast("string").alias("row_id"), entity.alias("entity"), F.unix_date(day).alias("day"), carried.cast("string").alias("carried")
    )
    total = e.count()
    buckets = max(8, -(-total // BUCKET_ROWS))
    hot = e.where("entity IS NOT NULL").groupBy("entity").count().where(F.col("count") > BUCKET_ROWS)
    hot = materialize(hot.select("entity", F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("parts")), "hot")
    if hot.count() <= BROADCAST_HOT:  # else a shuffled join, whose skew adaptive execution splits
        hot = F.broadcast(hot)
    bucket = F.pmod(F.xxhash64("entity", "salt"), F.lit(buckets)).cast("int").alias("bucket")

    e = e.join(hot, "entity", "left")
    spread = F.when(F.col("entity").isNull(), F.lit(buckets)).otherwise(F.coalesce(F.col("parts"), F.lit(1)))
    e = e.withColumn("salt", F.pmod(F.xxhash64("row_id"), spread).cast("int"))
    e = e.select(bucket, "row_id", "entity", "day", "carried")

    v = versions.rows.select(
        versions.entity.alias("entity"), F.unix_date(versions.start).cast("long").alias("start"),
        F.coalesce(F.unix_date(versions.end), F.lit(_NEVER)).cast("long").alias("end"),
        versions.priority[0].cast("long").alias("p1"), versions.priority[1].cast("long").alias("p2"), versions.value.cast("string").alias("value"),
    ).dropna(subset=["entity", "start", "value"]).fillna(0, ["p1", "p2"]).distinct()
    v = v.join(hot, "entity", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
    v = v.select(bucket, "entity", "start", "end", "p1", "p2", "value")
    return e.groupBy("bucket").cogroup(v.groupBy("bucket")).applyInPandas(_join_bucket, "row_id string, carried string, value string")
