"""Effective-dated data: daily fill, version intervals, merges of versions, as-of joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)


def fill_daily(quotes: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """One row per key and day from the first day of any key to the last, each with the latest value on or before it.

    Days before a key's first value are NULL. ``quotes``: at most one row per key and day."""
    span = quotes.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(day))
    grid = quotes.select(key).distinct().crossJoin(F.broadcast(days))
    upto = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(quotes.select(key, day, value), [key, day], "left").withColumn(value, F.last(value, ignorenulls=True).over(upto))


def intervals(versions: DataFrame, keys: list[str], start: str) -> DataFrame:
    """Adds effective_to (the next version's start, exclusive) and is_current. One version per key and start is expected."""
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return versions.withColumn("effective_to", F.coalesce(following, F.lit(OPEN_END))).withColumn("is_current", F.col("effective_to") == F.lit(OPEN_END))


def merge_versions(history: DataFrame, incoming: DataFrame, keys: list[str], start: str, content: str) -> DataFrame:
    """The whole history after ``incoming``: both sides hold keys, start, payload and a content hash (no intervals).

    Of several versions with one key and start the incoming one stands; a version that only repeats its predecessor's
    content is dropped; the intervals are then derived anew, so that any number of versions may arrive at once, in any
    order, any number of times."""
    both = history.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    last = Window.partitionBy(*keys, start).orderBy(F.col("__new").desc(), F.col(content))
    one = both.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank", "__new")
    before = F.lag(content).over(Window.partitionBy(*keys).orderBy(start))
    changed = one.withColumn("__before", before).where(~F.col(content).eqNullSafe(F.col("__before"))).drop("__before")
    return intervals(changed, keys, start)


def join_valid(facts: DataFrame, versions: DataFrame, keys: list[str], day: str, columns: list[str], small: bool = False) -> DataFrame:
    """Left join of each fact to the version whose [effective_from, effective_to) holds its day. Equi keys keep it a
    hash or merge join with a residual range condition. ``small``: the caller has proven the versions' size bounded."""
    v = versions.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("effective_from").alias("__from"), F.col("effective_to").alias("__to"), *columns)
    on: Column = (F.col(day) >= F.col("__from")) & (F.col(day) < F.col("__to"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    joined = facts.join(F.broadcast(v) if small else v, on, "left")
    return joined.drop("__from", "__to", *[f"__{k}" for k in keys])


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (give a total order). Planned as a group-limited window: rows beyond the
    first are dropped before the shuffle."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__rank", first).where("__rank = 1").drop("__rank")


def merge_latest(target: DataFrame, source: DataFrame, keys: list[str], content: str, order: list[Column], correction: str | None = None) -> DataFrame:
    """The target after an upsert: per key the newest source row where its content differs, else the target's row.
    ``correction``: a column that becomes true in rows that replaced one, false in rows that are new."""
    new = latest(source, keys, order)
    same = target.select(*keys, F.col(content).alias("__had"), F.lit(True).alias("__known"))
    changed = new.join(same, keys, "left").where(F.col("__known").isNull() | ~F.col(content).eqNullSafe(F.col("__had")))
    if correction is not None:
        changed = changed.withColumn(correction, F.col("__known").isNotNull())
    changed = changed.drop("__had", "__known")
    kept = target.join(changed.select(*keys), keys, "left_anti")
    return kept.unionByName(changed.select(*target.columns))
