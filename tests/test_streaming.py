"""Streams: order across and inside batches, steps without ticks, and late ticks, which fail."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wickworks.sinks import publish
from wickworks.streaming import candles as stream

SCHEMA = "symbol string, part int, offset long, tick_id long, ts timestamp, price double, quantity long, buyer_is_maker boolean"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)



class Feed:
    def __init__(self, spark, tmp_path):
        self.spark, self.at, self.offset = spark, tmp_path, 0

    def add(self, *ticks):
        """Ticks (symbol, id, minutes[, offset]) as one batch, in files whose order isn't that of the source."""
        rows = []
        for t in ticks:
            self.offset += 1
            rows.append((t[0], 0, t[3] if len(t) > 3 else self.offset, t[1], START + timedelta(minutes=t[2]), 100.0 + t[1] % 7, 2, t[1] % 2 == 0))
        self.spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1).write.mode("append").parquet(str(self.at / "in"))

    def read(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(self.at / "in"))

    def guard(self, late_ms=None):
        def then(batch, number):
            batch.write.mode("append").parquet(str(self.at / "out"))

        run = stream.guard(["symbol"], ["part", "offset"], str(self.at / "past"), then, late_ms, block=2)
        q = self.read().writeStream.foreachBatch(run).option("checkpointLocation", str(self.at / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(180)

    def kept(self):
        return sorted(r["tick_id"] for r in self.spark.read.parquet(str(self.at / "out")).collect())


def test_order_over_batches_whatever_order_rows_arrive_in(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(("A", 1, 0), ("A", 2, 5), ("B", 1, 0), ("A", 3, 5))
    feed.add(("A", 4, 6), ("A", 5, 9))
    feed.add(("B", 2, 10))
    feed.guard()
    assert feed.kept() == [1, 1, 2, 2, 3, 4, 5]
    feed.add(("A", 5, 11))
    for _ in range(2):  # also when it's run again
        with pytest.raises(Exception, match="strictly increasing"):
            feed.guard()
    assert feed.kept() == [1, 1, 2, 2, 3, 4, 5]


def test_ids_swapped_inside_a_batch_fail(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(("A", 1, 0), ("A", 3, 1), ("A", 2, 1), ("A", 4, 2))
    with pytest.raises(Exception, match="ids strictly increasing': 1|ids strictly increasing: 1"):
        feed.guard()
    assert not (tmp_path / "out").exists()


def test_falling_times_and_late_ticks_fail(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(("A", 1, 0), ("A", 2, 60))
    feed.add(("B", 1, 55))
    feed.guard(late_ms=600_000)
    feed.add(("B", 2, 49 + 0), ("B", 3, 56))
    with pytest.raises(Exception, match="times not falling"):
        feed.guard()
    other = Feed(spark, tmp_path / "other")
    other.add(("A", 1, 0), ("A", 2, 60))
    other.add(("B", 1, 49))
    with pytest.raises(Exception, match="600000 ms late: 1"):
        other.guard(late_ms=600_000)


@pytest.fixture()
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stream.ROCKS)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def candles(feed, name):
    q = stream.steps(feed.read(), ["symbol"]).writeStream.format("parquet").option("path", str(feed.at / name)).outputMode("append").option("checkpointLocation", str(feed.at / f"cp-{name}")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    return feed.spark.read.parquet(str(feed.at / name))


def test_silent_hours_give_empty_candles_and_late_ticks_fail(spark, tmp_path, rocks):
    feed = Feed(spark, tmp_path)
    feed.add(("A", 1, 10), ("A", 2, 20), ("B", 1, 30))
    feed.add(("A", 3, 30), ("A", 4, 70))
    feed.add(("A", 5, 5 * 60 + 5), ("A", 6, 5 * 60 + 6))  # hours 2 to 4 are silent
    feed.add(("A", 7, 7 * 60 + 30))
    got = candles(feed, "made")
    last = max(r["open_time"] for r in got.collect())
    ticks = spark.read.parquet(str(tmp_path / "in"))
    want = {(r["symbol"], r["open_time"]): r for r in stream.build(ticks, ["symbol"]).collect()}
    seen = {(r["symbol"], r["open_time"]): r for r in got.collect()}
    hours = [START.astimezone().replace(tzinfo=None) + timedelta(hours=h) for h in range(8)]
    assert last == hours[6] and sorted(seen) == [(s, h) for s in "AB" for h in hours[:7]] and got.count() == 14
    for k, r in seen.items():
        if k in want:
            assert all(r[c] == want[k][c] for c in r.asDict())
        else:
            assert (r["open"], r["close"], r["volume"], r["trade_count"], r["taker_buy_base_volume"]) == (None, None, 0.0, 0, 0.0)
    feed.add(("B", 2, 6 * 60 + 59))
    with pytest.raises(Exception, match="late ticks"):
        candles(feed, "made")
