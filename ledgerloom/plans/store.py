"""Parquet tables by name, with the write semantics of the pipeline: upsert, day overwrite, append, period guard."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.temporal import latest, merge_latest, merge_versions
from ledgerloom.storage import create_text, drop_path, materialize, path_exists

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
Values = dict[str, str | None]


class ClosedPeriod(RuntimeError):
    """A write would change a closed month."""


@dataclass
class TableStore:
    """A table is a folder of immutable parquet folders and of numbered manifests. A manifest names the schema, the
    partitioning and the folders that make up the table (of a partitioned table: those of each partition). A write makes new
    folders and then the next manifest, so a reader never sees half a write, no plan overwrites what it reads, a change of
    a day writes that day and nothing else, and of two writers that started from the same state the second one fails.

    Reads are pruned by the manifest itself: folders of other days are not even listed."""

    spark: SparkSession
    root: str

    # ------------------------------------------------------------------------------------------------------- manifests
    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, name: str) -> list[int]:
        p, fs = self._fs(f"{self.root}/{name}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _manifest(self, name: str, number: int) -> dict:
        p, fs = self._fs(f"{self.root}/{name}/manifests/{number:09d}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _current(self, name: str) -> dict | None:
        numbers = self._numbers(name)
        return self._manifest(name, numbers[-1]) if numbers else None

    def _commit(self, name: str, before: dict | None, schema: StructType, partition_by: list[str], parts: list[dict], batch: str | None = None) -> None:
        number = before["number"] + 1 if before else 1
        batches = [*(before or {}).get("batches", []), *([batch] if batch is not None else [])]
        manifest = {"number": number, "schema": schema.json(), "partition_by": partition_by, "parts": parts, "batches": batches}
        create_text(self.spark, f"{self.root}/{name}/manifests/{number:09d}.json", json.dumps(manifest))

    def exists(self, name: str) -> bool:
        return bool(self._numbers(name))

    def path(self, name: str) -> str:
        """The manifest that is the table's present state."""
        return f"{self.root}/{name}/manifests/{self._numbers(name)[-1]:09d}.json"

    def has_batch(self, name: str, batch: str) -> bool:
        current = self._current(name)
        return current is not None and batch in current["batches"]

    # ----------------------------------------------------------------------------------------------------------- reads
    def read(self, name: str, wanted: Callable[[Values], bool] | None = None) -> DataFrame:
        """The table, or the partitions of it whose values are ``wanted``."""
        current = self._current(name)
        if current is None:
            raise FileNotFoundError(f"no table {name} under {self.root}")
        schema = StructType.fromJson(json.loads(current["schema"]))
        dirs = [p["dir"] for p in current["parts"] if wanted is None or wanted(p["values"])]
        if not dirs:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{name}/data"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{d}" for d in dirs]).select(*schema.names)

    def read_days(self, name: str, day: str, days: list[dt.date]) -> DataFrame:
        """The rows of some days; of a table partitioned by day only their folders."""
        current, texts = self._current(name), {str(d) for d in days}
        if current and day in current["partition_by"]:
            return self.read(name, lambda v: v[day] in texts)
        return self.read(name).where(F.col(day).isin(*days))

    def days(self, name: str, day: str) -> list[dt.date]:
        """The days that a table holds, from its manifest if it is partitioned by day."""
        current = self._current(name)
        if current and day in current["partition_by"]:
            return sorted({dt.date.fromisoformat(p["values"][day]) for p in current["parts"] if p["values"][day]})
        return sorted(r[0] for r in self.read(name).select(day).where(F.col(day).isNotNull()).distinct().collect())

    # ---------------------------------------------------------------------------------------------------------- writes
    def _write(self, name: str, df: DataFrame, partition_by: list[str]) -> list[dict]:
        """Data folders of ``df``. Rows are brought together by partition, large partitions in several tasks."""
        version, base = f"v={uuid.uuid4().hex}", f"{self.root}/{name}/data"
        if not partition_by:
            df.write.mode("errorifexists").parquet(f"{base}/{version}")
            return [{"dir": version, "values": {}}]
        df.hint("rebalance", *partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{base}/{version}")
        folder, fs = self._fs(f"{base}/{version}")
        parts = []
        for status in fs.globStatus(self._fs(f"{base}/{version}{'/*=*' * len(partition_by)}")[0]) or []:
            tail = str(status.getPath().toString()).rsplit("/", len(partition_by))[1:]
            pairs = [(k, unquote(v)) for k, _, v in (t.partition("=") for t in tail)]
            parts.append({"dir": "/".join([version, *tail]), "values": {k: None if v == _NO_VALUE else v for k, v in pairs}})
        return parts

    def replace(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """All rows anew; partitioned as before unless told otherwise."""
        before = self._current(name)
        by = partition_by if partition_by is not None else (before or {}).get("partition_by", [])
        self._commit(name, before, df.schema, by, self._write(name, df, by))

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None, batch: str | None = None) -> bool:
        """Add rows. ``batch`` names what is added: a second time it adds nothing. Whether rows were added."""
        before = self._current(name)
        if before and batch is not None and batch in before["batches"]:
            return False
        by = before["partition_by"] if before else partition_by or []
        self._commit(name, before, df.schema, by, [*(before["parts"] if before else []), *self._write(name, df, by)], batch)
        return True

    def _replace_partitions(self, name: str, before: dict, df: DataFrame, gone: Callable[[Values], bool], batch: str | None = None) -> None:
        kept = [p for p in before["parts"] if not gone(p["values"])]
        self._commit(name, before, df.schema, before["partition_by"], [*kept, *self._write(name, df, before["partition_by"])], batch)

    def upsert(
        self, name: str, df: DataFrame, keys: list[str], content: str, order: list[Column], partition_by: list[str] | None = None,
        correction: str | None = None, batch: str | None = None,
    ) -> bool:
        """Newest source row per key; update where the content differs; insert where absent. ``correction`` names a column
        that says whether a row replaced an earlier one. Of a partitioned table the partitions of the new rows and of the
        rows they replace are written, no others; those are found by a scan of the keys alone. The source is computed once."""
        before = self._current(name)
        if before and batch is not None and batch in before["batches"]:
            return False
        new = materialize(latest(df, keys, order), "upsert")
        if correction is not None and correction not in new.columns:
            new = new.withColumn(correction, F.lit(False))
        if before is None:
            self.append(name, merge_latest(new.limit(0), new, keys, content, order, correction), partition_by, batch)
            return True
        by = before["partition_by"]
        if not by:
            self._commit(name, before, new.schema, by, self._write(name, merge_latest(self._widened(name, new), new, keys, content, order, correction), by), batch)
            return True
        moved = self.read(name).select(*keys, *[c for c in by if c not in keys]).join(new.select(*keys), keys, "left_semi")
        seen = moved.select(*by).union(new.select(*by)).distinct()
        touched = {tuple(r) for r in seen.select(*[F.col(c).cast("string") for c in by]).collect()}  # partitions, not rows
        inside = lambda v: tuple(v[c] for c in by) in touched
        merged = merge_latest(self._widened(name, new, inside), new, keys, content, order, correction)
        self._replace_partitions(name, before, merged, inside, batch)
        return True

    def _widened(self, name: str, like: DataFrame, wanted: Callable[[Values], bool] | None = None) -> DataFrame:
        """The table with the columns of ``like``; those it lacks are NULL."""
        old = self.read(name, wanted)
        return old.select(*[F.col(f.name) if f.name in old.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])

    def upsert_versions(self, name: str, df: DataFrame, keys: list[str], start: str, content: str) -> None:
        old = self.read(name).drop("effective_to", "is_current") if self.exists(name) else df.limit(0)
        self.replace(name, merge_versions(old, df, keys, start, content))

    def overwrite_days(self, name: str, df: DataFrame, day: str, scope: DataFrame, partition_by: list[str], periods: DataFrame | None = None) -> None:
        """Replace the rows of the days (and other columns) in ``scope`` by ``df``'s; a scope without new rows is emptied,
        never left as it was. With ``periods`` given, a closed month in the scope raises before anything is computed. Only the
        partitions in the scope are written, provided that its columns are those of the partitioning."""
        if periods is not None:
            assert_open(scope, day, periods)
        before, columns = self._current(name), scope.columns
        if before is not None and before["partition_by"] == partition_by and set(columns) <= set(partition_by):
            gone = {tuple(r) for r in scope.distinct().select(*[F.col(c).cast("string") for c in columns]).collect()}  # days, not rows
            self._replace_partitions(name, before, df, lambda v: tuple(v[c] for c in columns) in gone)
            return
        if before is not None:
            kept = self._widened(name, df).join(scope.distinct(), columns, "left_anti")
            df = kept.select(*df.columns).unionByName(df)
        self.replace(name, df, partition_by)

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Delete all but the last ``keep`` states and what belongs to none of them; the number of folders deleted. No
        writer may be at work, and readers of older states lose them."""
        numbers = self._numbers(name)
        used = {p["dir"].split("/")[0] for n in numbers[-keep:] for p in self._manifest(name, n)["parts"]}
        live = {p["dir"] for n in numbers[-keep:] for p in self._manifest(name, n)["parts"]}
        gone, old = 0, set()
        base = f"{self.root}/{name}/data"
        for n in numbers[:-keep]:
            for part in self._manifest(name, n)["parts"]:
                old.add(part["dir"].split("/")[0])
                if part["dir"] not in live and path_exists(self.spark, f"{base}/{part['dir']}"):
                    drop_path(self.spark, f"{base}/{part['dir']}")
                    gone += 1
            drop_path(self.spark, f"{self.root}/{name}/manifests/{n:09d}.json")
        folder, fs = self._fs(base)
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            if status.getPath().getName() not in used:
                fs.delete(status.getPath(), True)
                gone += status.getPath().getName() not in old  # written by a run that did not get to its manifest
        return gone


def export_csv(df: DataFrame, path: str) -> None:
    """For people and spreadsheets; the tables themselves are parquet."""
    df.write.mode("overwrite").option("header", True).csv(path)


def closed_months(periods: DataFrame) -> DataFrame:
    return periods.where("status = 'closed'").select("period_month").distinct()


def is_closed(periods: DataFrame, month: str) -> bool:
    return not closed_months(periods).where(F.col("period_month") == month).isEmpty()


def assert_open(scope: DataFrame, day: str, periods: DataFrame) -> None:
    """Raise if a day of the scope lies in a closed month. Only months are collected."""
    months = scope.select(F.date_format(day, "yyyy-MM").alias("period_month")).distinct()
    hit = [r[0] for r in months.join(closed_months(periods), "period_month", "left_semi").orderBy("period_month").limit(12).collect()]
    if hit:
        raise ClosedPeriod(f"closed: {', '.join(hit)}")


def close_period(store: TableStore, month: str, who: str, at: Column) -> None:
    """Close a month; closing it again only renews who and when."""
    row = store.spark.createDataFrame([(month, "closed", who)], "period_month string, status string, closed_by string").withColumn("closed_at", at)
    row = row.withColumn("content", F.concat_ws("||", "status", "closed_by", F.col("closed_at").cast("string")))
    store.upsert("recon_period_control", row, ["period_month"], "content", [F.col("closed_at").desc()])
