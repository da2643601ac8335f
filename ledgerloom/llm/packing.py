"""Filling containers of fixed capacity, by Karmarkar-Karp multiway differencing.

Items are hashed to groups of about ``GROUP_CAPACITIES`` containers' worth of tokens. In a group of k containers, every
item starts as a partial partition of its own (one container holds it, the others nothing). The two partial partitions
with the largest imbalance are merged, fullest against emptiest, until one is left: its containers are nearly equal. If
the fullest exceeds the capacity, its items and another container's are divided anew (``level``): differencing leaves
containers so nearly equal that little has to move wherever there is room at all. If that does not do, differencing is
repeated on slightly changed sizes; then the number of containers rises by one.

Defined results: an item longer than the capacity, and only such a one, is split into full containers and a rest; an
item without size (NULL, 0 or negative) takes no room and has no container; equal and repeated items are placed
independently, each of them once; an empty table gives an empty result.

Scale: groups follow the total size, each group is bounded, hot sources or threads do not matter since items are hashed
by row. What a group leaves unused is less than one container, 1 / ``GROUP_CAPACITIES`` of it.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.storage import materialize

CAPACITY = 2_048
#: Containers that a group should fill.
GROUP_CAPACITIES = 256


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container numbers; the first container with enough room is found in a tree of free rooms."""
    n = len(sizes)
    width = 1 << max(0, (n - 1).bit_length())
    room = np.full(2 * width, capacity, dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        at = 1
        while at < width:
            at = 2 * at if room[2 * at] >= sizes[i] else 2 * at + 1
        out[i] = at - width
        room[at] -= sizes[i]
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return out


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp over k containers: container numbers of nearly equal sums.

    A partial partition is a vector of k sums in ascending order, less its smallest, with the slots that the sums stand
    for. Merges are recorded as joins of slots and resolved at the end, so that no item lists are copied.
    """
    n = len(sizes)
    if k == 1:
        return np.zeros(n, dtype=np.int64)
    parent: list[int] = []  # of slots, a union forest

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # A partition holds its non-empty part only: sums and slots, ascending; the other k - len are empty containers.
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for i in range(n):
        parent.append(i)
        heap.append((-int(sizes[i]), i, np.array([sizes[i]], dtype=np.int64), np.array([i], dtype=np.int64)))
    heapq.heapify(heap)
    label = n
    while len(heap) > 1:
        _, _, s1, t1 = heapq.heappop(heap)
        _, _, s2, t2 = heapq.heappop(heap)
        over = len(s1) + len(s2) - k  # so many containers take a part of both: fullest of one, emptiest of the other
        if over <= 0:
            sums, slots = np.concatenate([s1, s2]), np.concatenate([t1, t2])
        else:
            # Of k containers, s1 fills its last len(s1) in ascending order, s2 the first len(s2) in descending order.
            a, b = s1[:over], s2[::-1][len(s2) - over :]
            ta, tb = t1[:over], t2[::-1][len(t2) - over :]
            for x, y in zip(ta.tolist(), tb.tolist()):
                parent[find(y)] = find(x)
            sums = np.concatenate([a + b, s1[over:], s2[over:]])
            slots = np.concatenate([ta, t1[over:], t2[over:]])
        order = np.argsort(sums, kind="stable")
        sums, slots = sums[order], slots[order]
        if len(sums) == k and sums[0]:
            sums = sums - sums[0]
        spread = int(sums[-1])
        heapq.heappush(heap, (-spread, label, sums, slots))
        label += 1
    roots = {find(int(s)): j for j, s in enumerate(heap[0][3])} if heap else {}
    return np.array([roots[find(i)] for i in range(n)], dtype=np.int64)


def _closest(sizes: list[int], most: int) -> tuple[int, list[int]]:
    """The greatest sum of some of the sizes that is not above ``most``, and which they are."""
    reach = [1]  # bit s of the k-th: the first k sizes can give s
    cut = (1 << (most + 1)) - 1
    for x in sizes:
        reach.append((reach[-1] | (reach[-1] << x)) & cut)
    best = left = reach[-1].bit_length() - 1
    chosen = []
    for k in range(len(sizes), 0, -1):
        if not (reach[k - 1] >> left) & 1:
            chosen.append(k - 1)
            left -= sizes[k - 1]
    return best, chosen


def level(sizes: np.ndarray, container: np.ndarray, k: int, capacity: int) -> bool:
    """Divide items anew, in place, until no container exceeds the capacity; False if that does not help any more.

    The fullest container is paired with each other one, those with most room first: their items are split so that the
    other is filled as far as it can be. The first pair that rids the fullest of its excess is taken, else the best one."""
    sums = np.bincount(container, weights=sizes, minlength=k).astype(np.int64)
    while (over := int(sums.max()) - capacity) > 0:
        full = int(np.argmax(sums))
        mine = np.flatnonzero(container == full)
        best = (0, None)
        for other in np.argsort(sums, kind="stable")[: k - 1]:
            if sums[other] + best[0] >= capacity:
                break  # no more room than was gained already
            items = np.concatenate([np.flatnonzero(container == other), mine])
            filled, chosen = _closest(sizes[items].tolist(), capacity)
            gain = filled - int(sums[other])
            if gain > best[0]:
                best = gain, (int(other), items, chosen)
            if gain >= over:
                break
        if best[1] is None:
            return False
        gain, (other, items, chosen) = best
        container[items] = full
        container[items[chosen]] = other
        sums[full] -= gain
        sums[other] += gain
    return True


#: Differencings of slightly changed sizes that are tried before another container is added.
RESTARTS = 6


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container numbers for items of at most the capacity each."""
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    # No two items of more than half a container share one.
    k = max(1, -(-int(sizes.sum()) // capacity), int((2 * sizes > capacity).sum()))
    while True:
        rng = np.random.default_rng(k)
        for again in range(RESTARTS + 1):
            changed = sizes if not again else np.maximum(1, np.rint(sizes * (1 + 0.03 * again / RESTARTS * rng.standard_normal(len(sizes))))).astype(np.int64)
            found = differencing(changed, k)
            if level(sizes, found, k, capacity):
                return found
        k += 1


def _pack_group(capacity: int):
    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["row", "part"], kind="stable")
        return items.assign(container=pack(items["size"].to_numpy(np.int64), capacity))

    return run


def fill_containers(df: DataFrame, row_id: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """row id, part, first_token, n_tokens, container (a string, NULL if the item takes no room) of every piece.

    Rows are numbered once, before they are written: ids may repeat or be NULL."""
    kind = df.schema[row_id].dataType.simpleString()
    given = df.select(F.monotonically_increasing_id().alias("row"), F.col(row_id).alias("item"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("total"))
    items = materialize(given, "sizes")
    whole = items.agg(F.sum("total")).first()[0] or 0
    groups = max(1, -(-whole // (capacity * GROUP_CAPACITIES)))
    parts = F.ceil(F.col("total") / capacity).cast("int")
    pieces = items.where("total > 0").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    pieces = pieces.withColumn("size", F.least(F.lit(capacity), F.col("total") - F.col("part") * F.lit(capacity)).cast("long"))
    full = pieces.where(F.col("size") == capacity).withColumn("container", F.concat_ws("-", F.lit("full"), "row", "part"))
    loose = pieces.where(F.col("size") < capacity).withColumn("group", F.pmod(F.xxhash64("row", "part"), F.lit(groups)).cast("int"))
    packed = loose.groupBy("group").applyInPandas(_pack_group(capacity), f"row long, item {kind}, total long, part int, size long, group int, container long")
    packed = packed.withColumn("container", F.concat_ws("-", F.lit("mixed"), "group", "container"))
    empty = items.where("total = 0").select("item", F.lit(0).alias("part"), F.lit(0).cast("long").alias("size"), F.lit(None).cast("string").alias("container"))
    columns = ["item", "part", "size", "container"]
    every = full.select(*columns).unionByName(packed.select(*columns)).unionByName(empty)
    first = (F.col("part") * F.lit(capacity)).cast("long")
    return every.select(F.col("item").alias(row_id), "part", first.alias("first_token"), F.col("size").alias("n_tokens"), "container")
