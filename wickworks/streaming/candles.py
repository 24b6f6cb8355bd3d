"""Candles from a live stream of ticks: watermark, tumbling windows, empty steps, and an order and lateness that fail rather than drop."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wickworks.operators import order
from wickworks.operators.validate import ValidationError
from wickworks.sinks.publish import Store


def build(ticks: DataFrame, keys: Sequence[str], step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """OHLCV of ticks (keys, tick_id, ts, price, quantity, buyer_is_maker) by event time. With output mode append a candle comes out
    once, when the watermark has passed its end; steps without ticks give none and late ticks are dropped: steps() is the strict form."""
    same = [*keys, "tick_id"]
    once = ticks.withWatermark("ts", late).dropDuplicatesWithinWatermark(same) if ticks.isStreaming else ticks.dropDuplicates(same)
    return once.groupBy(*keys, F.window("ts", step).alias("step")).agg(
        F.min_by("price", "tick_id").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "tick_id").alias("close"),
        F.sum("quantity").cast("double").alias("volume"), F.count("*").alias("trade_count"),
        F.sum(F.when(~F.col("buyer_is_maker"), F.col("quantity")).otherwise(0)).cast("double").alias("taker_buy_base_volume"),
    ).select(*keys, F.col("step.start").alias("open_time"), F.col("step.end").alias("candle_end_utc"), "open", "high", "low", "close", "volume", "trade_count", "taker_buy_base_volume")


def sessions(ticks: DataFrame, keys: Sequence[str], gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of ticks without a pause of the gap: the streaming counterpart of gap segments."""
    return ticks.withWatermark("ts", late).groupBy(*keys, F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("ticks"), F.min("tick_id").alias("first_id"), F.max("tick_id").alias("last_id")).select(*keys, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "ticks", "first_id", "last_id")


def guard(keys: Sequence[str], source: Sequence[str], folder: str, then: Callable[[DataFrame, int], None], late_ms: int | None = None, block: int = order.BLOCK) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that hands batches of ticks on to `then`, and fails the query where ids don't rise, times fall, or a tick comes
    more than late_ms after the latest of earlier batches.

    source are the columns that tell a tick's place in its source, the last one a whole number (a partition and its offset, a file and
    its line): a batch is checked in that order, whatever order its rows arrive in, by summaries of blocks, so that no task holds a
    key's ticks. What is kept of all earlier batches is one part a key, in folder, by batch, so that a batch that is run again meets
    the same past; the folder must be one that all executors share.
    """
    checks = [order.rising("ids strictly increasing", "tick_id"), order.not_falling("times not falling", "time_ms")]

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        store = Store(spark, folder)
        rows = batch.withColumn("time_ms", F.unix_millis("ts"))
        now = order.parts(rows, keys, source, checks, block=block).withColumn("__batch", F.lit(1))
        past = f"{folder.rstrip('/')}/batch-{number - 1}"
        if store.exists(past):
            now = now.unionByName(spark.read.schema(now.schema).parquet(past))
        merged = order.joined(now, keys, "__batch", checks)
        at = f"{folder.rstrip('/')}/batch-{number}"
        # Breaks are of this batch only: the past's are none, as it passed.
        merged.withColumn("__batch", F.lit(0)).select(*now.columns).write.mode("overwrite").parquet(at)
        found = spark.read.parquet(at)
        counts = {c.name: F.coalesce(F.sum(f"__b{i}"), F.lit(0)) for i, c in enumerate(checks)}
        broken = {k: v for k, v in found.agg(*[v.alias(k) for k, v in counts.items()]).first().asDict().items() if v}
        if late_ms is not None and store.exists(past):
            latest = spark.read.parquet(past).agg(F.max("__l1")).first()[0]
            late = rows.where(F.col("time_ms") < latest - late_ms).count() if latest is not None else 0
            broken |= {f"not over {late_ms} ms late": late} if late else {}
        if broken:
            store.delete(at)
            raise ValidationError(broken)
        then(batch, number)
        if store.exists(f"{folder.rstrip('/')}/batch-{number - 2}"):
            store.delete(f"{folder.rstrip('/')}/batch-{number - 2}")

    return run


#: The state store that steps() needs.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How much longer than `late` Spark's own watermark waits, so that a late tick reaches the check that fails instead of being dropped.
GRACE_MS = 10 * 365 * 86_400_000
_OPEN = "open_id long, open double, high double, low double, close_id long, close double, volume double, trade_count long, taker_buy_base_volume double"
_CANDLE = ("open", "high", "low", "close", "volume", "trade_count", "taker_buy_base_volume")
_FRAME = 10_000


class _Steps(StatefulProcessor):
    """The open steps of a key. A step closes when the watermark passes its end, in order and empty or not; a tick for a closed one is fatal."""

    def __init__(self, keys: Sequence[str], step_ms: int):
        self.keys, self.step_ms = list(keys), step_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "at long", _OPEN)
        self.next = handle.getValueState("next", "at long")

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        first, last = (a if a[0] <= b[0] else b), (a if a[4] > b[4] else b)
        return (first[0], first[1], max(a[2], b[2]), min(a[3], b[3]), last[4], last[5], a[6] + b[6], a[7] + b[7], a[8] + b[8])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() + GRACE_MS
        begin = self.next.get()[0] if self.next.exists() else None
        for ticks in rows:
            step = ticks["ts"].to_numpy("datetime64[ms]").astype("int64") // self.step_ms * self.step_ms
            if len(step) and step.min() + self.step_ms <= closed:
                raise ValueError(f"{key}: late ticks for steps that have closed: {int((step + self.step_ms <= closed).sum())}")
            bought = np.where(ticks["buyer_is_maker"].to_numpy(bool), 0.0, ticks["quantity"].to_numpy(float))
            for at, g in ticks.assign(__step=step, __bought=bought).sort_values("tick_id", kind="stable").groupby("__step"):
                price, ids = g["price"].to_numpy(float), g["tick_id"].to_numpy()
                mine = (int(ids[0]), float(price[0]), float(price.max()), float(price.min()), int(ids[-1]), float(price[-1]), float(g["quantity"].sum()), len(g), float(g["__bought"].sum()))
                self.open.updateValue((int(at),), self._merged(self.open.getValue((int(at),)), mine) if self.open.containsKey((int(at),)) else mine)
            begin = int(step.min()) if begin is None else min(begin, int(step.min()))
        self.next.update((begin,))
        self.handle.registerTimer(begin + self.step_ms - GRACE_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() + GRACE_MS
        at, made = self.next.get()[0], []
        while at + self.step_ms <= closed:
            if self.open.containsKey((at,)):
                v = self.open.getValue((at,))
                made.append((at, v[1], v[2], v[3], v[5], v[6], v[7], v[8]))
                self.open.removeKey((at,))
            else:
                made.append((at, None, None, None, None, 0.0, 0, 0.0))
            at += self.step_ms
            if len(made) == _FRAME:
                yield self._frame(key, made)
                made = []
        if made:
            yield self._frame(key, made)
        self.next.update((at,))
        self.handle.registerTimer(at + self.step_ms - GRACE_MS)

    def _frame(self, key, made: list) -> pd.DataFrame:
        out = pd.DataFrame(made, columns=["at", *_CANDLE])
        times = {"open_time": pd.to_datetime(out["at"], unit="ms", utc=True), "candle_end_utc": pd.to_datetime(out["at"] + self.step_ms, unit="ms", utc=True)}
        prices = {c: out[c].astype("float64") for c in ("open", "high", "low", "close")}
        return pd.DataFrame({**{k: [v] * len(out) for k, v in zip(self.keys, key)}, **times, **prices, **{c: out[c] for c in _CANDLE[4:]}})


def steps(ticks: DataFrame, keys: Sequence[str], step_ms: int = 3_600_000, late_ms: int = 600_000) -> DataFrame:
    """Candles of a stream of ticks like build()'s, with every step from a key's first to the last one closed: a step without ticks has no
    prices and zero sums. A step closes when a tick late_ms after its end has been seen; a tick that comes later still fails the query
    (one over ten years late is dropped by Spark before it can).

    Kept per key: its open steps' running values, so no more than the steps within late_ms. Needs the RocksDB state store. Key columns
    are texts or whole numbers. Ids that come twice are not looked for here: that is guard()'s.
    """
    waiting = ticks.withWatermark("ts", f"{late_ms + GRACE_MS} milliseconds")
    types = dict(ticks.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "open_time timestamp, candle_end_utc timestamp, open double, high double, low double, close double, volume double, trade_count long, taker_buy_base_volume double"])
    return waiting.groupBy(*keys).transformWithStateInPandas(_Steps(keys, step_ms), schema, "Append", "EventTime")
