"""Late and out-of-order events: per-period aggregates corrected by retractions, with a cut-off for lateness.

An aggregate is kept per key and event date. Every arrival day is a version of it. A version that changes an
aggregate published before emits two deltas: the old value with sign -1 and the new value with sign +1. Adding up the
deltas of all versions up to some day, with their signs, gives the aggregate as known on that day, so anything
downstream (totals, marts) is corrected by applying the same signed rows. Events beyond the cut-off change nothing;
they are emitted as rejected versions, which can be counted and looked up but carry no delta.

Defined results:
* lateness is arrival minus event date in days; ``on_time`` below ``late_from``, ``late`` up to ``cutoff``, else
  ``too_late``; early arrivals (negative) are on time;
* an event without event date or arrival cannot be placed: lateness NULL, it enters no aggregate;
* NULL measures count as events and add nothing to a sum; a sum over NULLs only is NULL;
* ties and repeated rows are separate events (drop repeated deliveries first); an empty table gives empty results.

``DeltaLog`` keeps the state: a table of all deltas, partitioned by event date. A batch of arrivals reads the state of the
event dates it touches, emits and appends the deltas against it, under the batch's id; delivered again it adds nothing.

Which events are late is decided once, where events are routed to corrections or rejections (``routed``); the deltas are
made of the routed events, and the list of late events is that routing itself, without a detour through the aggregates.

Scale: deltas are built from counts and sums aggregated map-side by (key, event date, arrival), so a hot key never
moves its events. The window over versions sees at most ``cutoff`` + the early days rows of one aggregate. A batch reads
the log of no other event dates than its own, which the cut-off keeps few.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from ledgerloom.plans.store import TableStore

ON_TIME, LATE, TOO_LATE = "on_time", "late", "too_late"


def lateness(event_date: Column, arrival: Column, late_from: int = 2, cutoff: int = 7) -> Column:
    days = F.date_diff(arrival, event_date)
    return F.when(days > cutoff, F.lit(TOO_LATE)).when(days >= late_from, F.lit(LATE)).when(days < late_from, F.lit(ON_TIME))


@dataclass(frozen=True)
class LateEvents:
    """Events (any columns) with the names of what places them. ``measure`` is summed."""

    events: DataFrame
    keys: list[str]
    event_date: str
    arrival: str
    measure: str
    late_from: int = 2
    cutoff: int = 7

    def _lateness(self) -> Column:
        return lateness(F.col(self.event_date), F.col(self.arrival), self.late_from, self.cutoff)

    def routed(self) -> DataFrame:
        """The events with their ``lateness`` (a column of that name gives way); those that cannot be placed are left out."""
        return self.events.withColumn("lateness", self._lateness()).where("lateness IS NOT NULL")

    def versions(self) -> DataFrame:
        """What each arrival day brings to each aggregate: count and sum, by lateness."""
        return self.routed().groupBy(*self.keys, self.event_date, self.arrival, "lateness").agg(
            F.count(F.lit(1)).alias("n"), F.sum(self.measure).alias("total")
        )

    def changelog(self, state: DataFrame | None = None) -> DataFrame:
        """The signed deltas: key, event date, version (arrival day), sign, rows_count, total, kind.

        ``kind`` is 'first' for an aggregate's first value, 'correction' for the pairs that retract and replace it,
        'rejected' (sign 0) for what came after the cut-off. ``state``: the aggregates that were published before these
        events (key, event date, rows_count, total), against which the first versions are corrections.
        """
        group = [*self.keys, self.event_date]
        versions = self.versions()
        rows = versions.where(F.col("lateness") != TOO_LATE).withColumn("__turn", F.lit(1))
        if state is not None:
            # What was published before comes before all versions.
            known = state.select(*group, F.lit(None).cast("date").alias(self.arrival), F.lit(None).cast("string").alias("lateness"), F.col("rows_count").alias("n"), "total", F.lit(0).alias("__turn"))
            rows = rows.unionByName(known)
        order = Window.partitionBy(*group).orderBy("__turn", self.arrival)
        kept = rows.select(
            *group, self.arrival, "lateness", "__turn",
            F.sum("n").over(order).alias("new_n"), F.sum("total").over(order).alias("new_total"),
        )
        kept = kept.withColumn("old_n", F.lag("new_n").over(order)).withColumn("old_total", F.lag("new_total").over(order)).where("__turn = 1")
        kind = F.when(F.col("old_n").isNull(), F.lit("first")).otherwise(F.lit("correction"))

        def delta(sign: int, n: str, total: str) -> Column:
            return F.struct(F.lit(sign).alias("sign"), F.col(n).alias("rows_count"), F.col(total).alias("total"))

        pair = F.array(delta(-1, "old_n", "old_total"), delta(1, "new_n", "new_total"))
        signed = kept.withColumn("kind", kind).withColumn("d", F.explode(F.filter(pair, lambda d: d["rows_count"].isNotNull())))
        signed = signed.select(*group, F.col(self.arrival).alias("version"), "lateness", "kind", "d.*")
        late = versions.where(F.col("lateness") == TOO_LATE).select(
            *group, F.col(self.arrival).alias("version"), "lateness", F.lit("rejected").alias("kind"),
            F.lit(0).alias("sign"), F.col("n").alias("rows_count"), F.col("total"),
        )
        return signed.unionByName(late)

    def as_of(self, day: Column | None = None) -> DataFrame:
        """The aggregates after the versions up to ``day`` (all, if None), by adding up the signed deltas."""
        deltas = self.changelog().where("sign != 0")
        if day is not None:
            deltas = deltas.where(F.col("version") <= day)
        return apply_deltas(deltas, [*self.keys, self.event_date])

    def corrected_by(self) -> DataFrame:
        """The events which a published value had to be corrected for, or could not be: those routed as late or too late,
        with all their columns."""
        return self.routed().where(F.col("lateness") != ON_TIME)


def apply_deltas(deltas: DataFrame, group: list[str]) -> DataFrame:
    """Downstream state: signed sums of a changelog's deltas, at any coarser or equal grouping."""
    return deltas.groupBy(*group).agg(
        F.sum(F.col("sign") * F.col("rows_count")).alias("rows_count"), F.sum(F.col("sign") * F.col("total")).alias("total")
    )


@dataclass(frozen=True)
class DeltaLog:
    """The kept state of per-period aggregates: a table of signed deltas in a store (``plans.store.TableStore``)."""

    store: TableStore
    name: str

    def take(self, late: LateEvents, batch: str) -> bool:
        """Emit and keep the deltas of a batch of arrivals. False if the batch is in the log already, which then stays as it is."""
        if self.store.has_batch(self.name, batch):
            return False
        group, state = [*late.keys, late.event_date], None
        if self.store.exists(self.name):
            days = [r[0] for r in late.versions().where(F.col("lateness") != TOO_LATE).select(late.event_date).distinct().collect()]  # days, not rows
            state = apply_deltas(self.store.read_days(self.name, late.event_date, days).where("sign != 0"), group)
        deltas = late.changelog(state)
        kinds = {c: t for c, t in deltas.dtypes}
        deltas = deltas.withColumn("total", F.col("total").cast("decimal(38,4)")) if kinds["total"].startswith("decimal") else deltas
        return self.store.append(self.name, deltas.withColumn("batch", F.lit(batch)), [late.event_date], batch)

    def deltas(self) -> DataFrame:
        return self.store.read(self.name)

    def state(self, group: list[str]) -> DataFrame:
        """The aggregates as known now, at the log's grouping or any coarser one."""
        return apply_deltas(self.deltas().where("sign != 0"), group)
