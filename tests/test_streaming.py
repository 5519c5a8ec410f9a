"""Streams from a growing folder into stored tables."""

from datetime import date, datetime

import pytest

from tradewind.operators.incremental import Incremental
from tradewind.sources.tables import TimePartition, Warehouse
from tradewind.streaming import sinks
from tradewind.streaming.sinks import replace_batches_stream, totals_stream, upsert_stream

SCHEMA = "id string, at timestamp, value bigint"
DAY = TimePartition("at", "day")


def add(spark, folder, *rows):
    spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def d(n, h=1):
    return datetime(2024, 1, n, h)


def test_upsert_stream(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"gold": "stream_upsert"})
    how = Incremental("merge", ("id",), DAY)
    source, checkpoint = tmp_path / "in", str(tmp_path / "cp")

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        upsert_stream(stream, wh, "gold.t", how, checkpoint, once=True).awaitTermination()
        return {(r.id, r["at"].day, r.value) for r in wh.read("gold.t").collect()}

    # a key twice in the first batch, and in a later one
    add(spark, source, ("a", d(1), 1), ("b", d(2), 2), ("b", d(1), 1), ("b", d(2), 2))
    assert run() == {("a", 1, 1), ("b", 2, 2)} and wh.read("gold.t").count() == 2
    # a new key of an earlier day, a row that moves to another day, versions that come too late
    add(spark, source, ("c", d(1), 3), ("b", d(3), 4), ("b", d(2, 5), 3), ("a", datetime(2023, 12, 31), 0), ("c", None, 9))
    assert run() == {("a", 1, 1), ("c", 1, 3), ("b", 3, 4)}
    assert run() == {("a", 1, 1), ("c", 1, 3), ("b", 3, 4)}
    # an equally old version takes the place of the stored one
    add(spark, source, ("a", d(1), 7))
    assert run() == {("a", 1, 7), ("c", 1, 3), ("b", 3, 4)}


def test_upsert_stream_takes_a_batch_once(spark, tmp_path, monkeypatch):
    """The driver dies after a batch was merged and before the stream knows: it is delivered again, keyless rows and all."""
    wh = Warehouse(spark, str(tmp_path / "wh"), {"gold": "stream_again"})
    how = Incremental("merge", ("id",), DAY)
    work, source, checkpoint = [], tmp_path / "in", str(tmp_path / "cp")
    start = sinks._start
    monkeypatch.setattr(sinks, "_start", lambda stream, todo, *rest: (work.append(todo), start(stream, todo, *rest))[1])
    for number, rows in enumerate([[("a", d(1), 1), (None, d(1), 5)], [("a", d(2), 2), (None, d(2), 6), ("b", d(3), 3)]]):
        add(spark, source, *rows)
        upsert_stream(spark.readStream.schema(SCHEMA).parquet(str(source)), wh, "gold.t", how, checkpoint, once=True).awaitTermination()
        once = sorted(map(str, wh.read("gold.t").collect()))
        work[-1](spark.createDataFrame(rows, SCHEMA), number)
        assert sorted(map(str, wh.read("gold.t").collect())) == once
    assert len(once) == 4
    # a rebuild keeps the number of the last batch
    wh.write_table("gold.t", wh.read("gold.t"), DAY)
    work[-1](spark.createDataFrame(rows, SCHEMA), 1)
    assert sorted(map(str, wh.read("gold.t").collect())) == once


def test_versions_need_an_order(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), {"gold": "stream_order"})
    with pytest.raises(ValueError, match="order"):
        upsert_stream(spark.readStream.format("rate").load(), wh, "gold.t", Incremental("merge", ("id",)), str(tmp_path / "cp"))


def test_latest_versions_of_a_hot_key(spark):
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', string(id % 500)) AS id", "id AS n", "id % 7 AS value")
    got = {r.id: r.n for r in sinks.latest_versions(rows, ["id"], ["n"]).collect()}
    want = {}
    for i in range(30_000):
        want["hot" if i % 3 == 0 else str(i % 500)] = i
    assert got == want


def test_replace_batches_stream(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"gold": "stream_batches"})
    how = Incremental("microbatch", partition=TimePartition("day", "day"))
    source, checkpoint, plans = tmp_path / "in", str(tmp_path / "cp"), []

    def totals(touched):
        rows = spark.read.schema(SCHEMA).parquet(str(source)).where(touched("at"))
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.selectExpr("date_trunc('day', at) AS day", "value").groupBy("day").sum("value").withColumnRenamed("sum(value)", "total")

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(str(source)).selectExpr("date_trunc('day', at) AS day")
        replace_batches_stream(stream, wh, "gold.t", totals, how, checkpoint, once=True).awaitTermination()
        return {(r.day and r.day.day, r.total) for r in wh.read("gold.t").collect()}

    add(spark, source, ("a", d(1), 1), ("b", d(2), 2))
    assert run() == {(1, 1), (2, 2)}
    add(spark, source, ("c", d(1, 5), 10), ("d", d(3), 3), ("e", None, 4))
    assert run() == {(1, 11), (2, 2), (3, 3), (None, 4)}
    assert date(2024, 1, 3) in wh.partition_values("gold.t")
    # the touched days reach the scan as ranges of the time itself
    assert "GreaterThanOrEqual(at,2024-01-01" in plans[0] and "LessThan(at,2024-01-03" in plans[0] and plans[0].count("GreaterThanOrEqual(at") == 1


@pytest.mark.parametrize("watermark", [None, "400 days"])
def test_totals_stream_reads_every_file_once(spark, tmp_path, watermark):
    """Late rows change the totals of their day, from state; the third batch reads its own file alone."""
    wh = Warehouse(spark, str(tmp_path / "wh"), {"gold": f"stream_totals_{bool(watermark)}".lower()})
    source, checkpoint = tmp_path / "in", str(tmp_path / "cp")

    def run():
        query = totals_stream(spark.readStream.schema(SCHEMA).parquet(str(source)), wh, "gold.t", DAY,
                              {"n": "count(*)", "total": "sum(value)"}, checkpoint, {"ids": ["id"]}, "day", watermark, once=True)
        query.awaitTermination()
        return {(r.day and r.day.day, r.n, r.total, r.ids) for r in wh.read("gold.t").collect()}, query.recentProgress

    add(spark, source, ("a", d(1), 1), ("b", d(2), 2), ("a", d(2), 2), ("a", d(2), 2))
    assert run()[0] == {(1, 1, 1, 1), (2, 3, 6, 2)}
    add(spark, source, *[("c", d(3), i) for i in range(50)])
    assert run()[0] == {(1, 1, 1, 1), (2, 3, 6, 2), (3, 50, 1225, 1)}
    files = lambda: {r.day.day: r.file_path for r in wh.read("gold.t").select("day", "_metadata.file_path").collect()}
    before = files()
    add(spark, source, ("b", d(1, 9), 5), ("a", d(1, 9), 5))
    got, progress = run()
    assert got == {(1, 3, 11, 2), (2, 3, 6, 2), (3, 50, 1225, 1)}
    # two rows, read by the count and by the distinct count
    assert sum(p["numInputRows"] for p in progress) in (2, 4)
    after = files()
    assert {n for n in after if after[n] != before[n]} == {1}  # no other day was written again
    if watermark is None:
        add(spark, source, ("z", None, 3))
        assert run()[0] == {(1, 3, 11, 2), (2, 3, 6, 2), (3, 50, 1225, 1), (None, 1, 3, 1)}


def test_batches_side_by_side_are_one_range(spark):
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 3), None]
    rows = spark.createDataFrame([(datetime(2024, 1, 30, 23, 59),), (d(31, 0),), (datetime(2024, 2, 1, 23, 59, 59),), (datetime(2024, 2, 2),), (datetime(2024, 2, 3),), (None,)], "at timestamp")
    condition = sinks.within(DAY, days)("at")
    assert rows.where(condition).count() == 4 and str(condition).count(">=") == 2
    assert rows.where(sinks.within(TimePartition("at", "hour"), ["2024-01-31-00"])("at")).count() == 1
    assert rows.where(sinks.within(TimePartition("at", "month"), [date(2024, 2, 1)])("at")).count() == 3
