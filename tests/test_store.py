"""Partition writes behind manifests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.matching import Rules, load_rules
from ledgerloom.plans.store import TableStore
from ledgerloom.storage import fresh_path

DAY = lambda n: dt.date(2026, 1, n)
SCHEMA = "k string, content string, n int, day date"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def folders(tables, name):
    return {p["values"]["day"]: p["dir"] for p in tables._current(name)["parts"]}


def test_a_day_reads_and_writes_its_own_partition(spark):
    tables = TableStore(spark, fresh_path(spark, "store"))
    tables.replace("t", frame(spark, [("a", "1", 1, DAY(1)), ("b", "1", 1, DAY(2)), ("c", "1", 1, DAY(3)), ("z", "1", 1, None)]), ["day"])
    before = folders(tables, "t")
    scope = spark.createDataFrame([(DAY(2),)], "day date")
    tables.overwrite_days("t", frame(spark, [("x", "2", 2, DAY(2))]), "day", scope, ["day"])
    after = folders(tables, "t")
    assert {d for d in after if after[d] != before[d]} == {"2026-01-02"} and set(after) == set(before)
    one = tables.read_days("t", "day", [DAY(2)])
    assert [r.k for r in one.collect()] == ["x"] and all("day=2026-01-02" in f for f in one.inputFiles())
    assert tables.read("t").where("day IS NULL").first().k == "z" and tables.days("t", "day") == [DAY(1), DAY(2), DAY(3)]
    tables.overwrite_days("t", frame(spark, []), "day", scope, ["day"])
    assert {r.k for r in tables.read("t").collect()} == {"a", "c", "z"} and tables.read_days("t", "day", [DAY(2)]).count() == 0


def test_upsert_moves_a_row_and_leaves_other_days_alone(spark):
    tables = TableStore(spark, fresh_path(spark, "store"))
    order = [F.col("day").desc()]
    tables.upsert("t", frame(spark, [("a", "1", 1, DAY(1)), ("b", "1", 1, DAY(2)), ("c", "1", 1, DAY(3))]), ["k"], "content", order, ["day"], "fixed", "one")
    before = folders(tables, "t")
    assert not tables.upsert("t", frame(spark, [("a", "9", 9, DAY(1))]), ["k"], "content", order, correction="fixed", batch="one")
    tables.upsert("t", frame(spark, [("b", "2", 5, DAY(4)), ("d", "1", 1, DAY(4)), ("b", "1", 4, DAY(3))]), ["k"], "content", order, correction="fixed")
    assert {(r.k, r.n, r.day, r.fixed) for r in tables.read("t").collect()} == {("a", 1, DAY(1), False), ("b", 5, DAY(4), True), ("c", 1, DAY(3), False), ("d", 1, DAY(4), False)}
    assert folders(tables, "t")["2026-01-01"] == before["2026-01-01"] and folders(tables, "t")["2026-01-03"] == before["2026-01-03"]


def test_empty_tables_batches_and_rivals(spark):
    tables = TableStore(spark, fresh_path(spark, "store"))
    tables.replace("e", frame(spark, []), ["day"])
    assert tables.read("e").count() == 0 and tables.read("e").columns == ["k", "content", "n", "day"] and tables.days("e", "day") == []
    assert tables.append("log", frame(spark, [("a", "1", 1, None)]), batch="b") and not tables.append("log", frame(spark, [("a", "1", 1, None)]), batch="b")
    assert tables.read("log").count() == 1
    held = tables._current("log")
    tables.append("log", frame(spark, [("b", "1", 1, None)]))
    with pytest.raises(FileExistsError):  # a writer that started from the state before
        tables._commit("log", held, held and tables.read("log").schema, [], [])
    with pytest.raises(FileNotFoundError):
        tables.read("nothing")


def test_vacuum_keeps_the_last_states(spark):
    tables = TableStore(spark, fresh_path(spark, "store"))
    for n in range(4):
        tables.replace("t", frame(spark, [("a", str(n), n, DAY(1))]), ["day"])
    frame(spark, [("lost", "1", 1, DAY(1))]).write.parquet(f"{tables.root}/t/data/v=lost")
    assert tables.vacuum("t", keep=2) == 3 and [r.n for r in tables.read("t").collect()] == [3]
    assert tables.vacuum("t", keep=2) == 0


def test_rules_from_a_file():
    assert load_rules("reconciliation:\n  floor: 0.7\n  weights: {amount: 0.3}\n  late_days: 3\n") == Rules(floor="0.7", late_days=3, weights={**Rules().weights, "amount": "0.3"})
    assert load_rules("a: 1\nreconciliation: {}\n") == Rules()
    with pytest.raises(ValueError):
        load_rules("reconciliation:\n  flor: 0.7\n")
