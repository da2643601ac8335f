import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.exactly_once import IdentifierIndex
from ledgerloom.operators.late_events import LateEvents, apply_deltas
from ledgerloom.plans.store import TableStore
from ledgerloom.storage import fresh_path
from ledgerloom.streaming import ingest

SCHEMA = "event string, id string, op string, day date, arrival date, amount double, at timestamp"


def write(spark, path, rows):
    spark.createDataFrame([(e, i, "o", d, a, 1.0, dt.datetime.combine(a, dt.time(1))) for e, i, d, a in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_streams(spark):
    root = fresh_path(spark, "stream")
    src, day = f"{root}/in", lambda n: dt.date(2026, 1, n)
    write(spark, src, [("e1", "A", day(1), day(1)), ("e2", "A", day(1), day(2)), ("e3", "B", day(1), day(1))])
    schema = spark.createDataFrame([], SCHEMA).schema
    tables, dropped = TableStore(spark, f"{root}/store"), []
    index = IdentifierIndex(spark, f"{root}/index", 10)
    make = lambda df: LateEvents(df, ["op"], "day", "arrival", "amount")

    def run():
        read = lambda: ingest.read_files(spark, src, schema)
        ingest.into_store(read().withColumn("content", F.col("event")), tables, "t", ["id"], "content", lambda: [F.col("arrival").desc(), F.col("event")], f"{root}/c1").awaitTermination()
        ingest.copies_by_index(read(), index, lambda: [F.col("op"), F.col("id")], "event", "arrival", lambda df, _: dropped.extend(r[0] for r in df.collect()), f"{root}/c2").awaitTermination()
        ingest.corrections(read(), tables, "deltas", make, f"{root}/c3").awaitTermination()

    run()
    assert {r.event for r in tables.read("t").collect()} == {"e2", "e3"} and dropped == ["e2"]
    write(spark, src, [("e4", "B", day(1), day(3)), ("e5", "C", day(1), day(20)), ("e6", "D", day(2), day(3))])
    run()
    assert {r.event for r in tables.read("t").collect()} == {"e2", "e4", "e5", "e6"} and dropped == ["e2", "e4"]
    totals = {r.day: r.rows_count for r in apply_deltas(tables.read("deltas"), ["day"]).collect()}
    assert totals == {day(1): 4, day(2): 1}
    q = ingest.windowed_totals(ingest.read_files(spark, src, schema), "at", "1 day", "30 days", ["op"], "amount").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").agg(F.sum("rows_count")).first()[0] == 6
    q = ingest.deduplicated(ingest.read_files(spark, src, schema), ["id"], "at", "60 days").writeStream.format("memory").queryName("d").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("d").count() == 4
