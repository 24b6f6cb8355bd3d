"""Ticks and candles that the queries derive from the test tables, and the same in SQL."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickworks.operators import candles as cd
from wickworks.sinks.publish import Store
from wickworks.sources.archives import KLINE

HOUR, DAY = 3_600_000, 86_400_000


def ticks(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    """events as ticks: positive values are prices, k of props the quantity, views and errors are sells."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("value > 0")
    return events.select(
        (F.col("event_type") if by_type else F.lit("ALL")).alias("symbol"),
        F.col("event_id").alias("tick_id"),
        cd.epoch_ms(F.col("ts")).alias("time_ms"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("quantity"),
        F.col("event_type").isin("view", "error").alias("buyer_is_maker"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cd.from_ticks(ticks(spark, sf_dir), ["symbol"], HOUR)


def order_ticks(spark: SparkSession, sf_dir: str, by_priority: bool = False) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_totalprice > 0")
    return orders.select(
        (F.col("o_orderpriority") if by_priority else F.lit("ALL")).alias("symbol"),
        F.col("o_orderkey").alias("tick_id"),
        cd.epoch_ms(F.col("o_orderdate")).alias("time_ms"),
        F.col("o_totalprice").alias("price"),
        F.lit(1).cast("long").alias("quantity"),
        (F.col("o_orderstatus") == "F").alias("buyer_is_maker"),
    )


def daily(spark: SparkSession, sf_dir: str, by_priority: bool = False) -> DataFrame:
    return cd.from_ticks(order_ticks(spark, sf_dir, by_priority), ["symbol"], DAY)


def whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of whole days: an hour without ticks is flat at the last close (at first, at the first open) and has no volume."""
    c = hourly(spark, sf_dir)
    span = c.agg((F.min("open_ms") - F.pmod(F.min("open_ms"), F.lit(DAY))).alias("lo"), (F.max("open_ms") - F.pmod(F.max("open_ms"), F.lit(DAY)) + DAY - HOUR).alias("hi"), F.min_by("open", "open_ms").alias("first"))
    hours = span.select("first", F.explode(F.sequence("lo", "hi", F.lit(HOUR).cast("long"))).alias("open_ms"))
    last = F.coalesce(F.last("close", ignorenulls=True).over(Window.orderBy("open_ms")), F.col("first"))
    both = hours.join(c.drop("symbol", "end_ms"), "open_ms", "left").withColumn("__last", last)
    prices = {x: F.coalesce(x, "__last") for x in ("open", "high", "low", "close")}
    sums = {x: F.coalesce(x, F.lit(0)) for x in ("volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")}
    return both.withColumns({**prices, **sums}).select(F.lit("ABC").alias("symbol"), "open_ms", *prices, *sums)


def kline_cells(candles: DataFrame) -> DataFrame:
    """(day, order, cells as text) of candles in the archives' columns."""
    cells = [F.col("open_ms"), "open", "high", "low", "close", "volume", F.col("open_ms") + HOUR - 1, "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", F.lit(0)]
    return candles.select(F.to_date(F.timestamp_seconds(F.col("open_ms") / 1000)).cast("string").alias("day"), F.col("open_ms").alias("order"), F.array(*[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cells]).alias("cells"))


def trade_cells(ticks_: DataFrame) -> DataFrame:
    cells = ["tick_id", "price", "quantity", "tick_id", "tick_id", "time_ms", "buyer_is_maker"]
    return ticks_.select(F.to_date(F.timestamp_seconds(F.col("time_ms") / 1000)).cast("string").alias("day"), F.col("tick_id").alias("order"), F.array(*[F.col(c).cast("string") for c in cells]).alias("cells"))


#: Faults of an archive, by the day's number in the month.
FAULTS = ("sound", "two members", "folder", "link", "name", "empty", "no archive")


def zipped(rows: DataFrame, folder: str, symbol: str, kind: str, header: Sequence[str] = KLINE, faulty: bool = False) -> list[str]:
    """Writes one archive a day, as an exchange's server has them, and returns their paths. A day's lines are put together by the task that
    has the day; the few archives come to the driver to be named. faulty: archives have each of FAULTS in turn."""

    def archive(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        name = f"{symbol}-{kind}-{key[0]}"
        text = "\n".join([",".join(header), *(",".join(c) for c in frame.sort_values("order")["cells"])]) + "\n"
        out = io.BytesIO()
        fault = FAULTS[int(key[0][-2:]) % len(FAULTS)] if faulty else "sound"
        member = zipfile.ZipInfo({"folder": f"{name}.csv/", "name": "other.csv"}.get(fault, f"{name}.csv"))
        member.external_attr = (0o120777 if fault == "link" else 0o100644) << 16
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(member, "" if fault in ("folder", "empty") else text)
            if fault == "two members":
                z.writestr("more.csv", text)
        if fault == "no archive":
            out = io.BytesIO(out.getvalue()[:10])
        return pd.DataFrame({"name": [f"{name}.zip"], "content": [out.getvalue()]})

    store, paths = Store(rows.sparkSession, folder), []
    for r in rows.groupBy("day").applyInPandas(archive, "name string, content binary").sort("name").toLocalIterator():
        with tempfile.NamedTemporaryFile() as f:
            f.write(bytes(r["content"]))
            f.flush()
            store.write_file(f"{folder}/{r['name']}", f.name)
        paths.append(f"{folder}/{r['name']}")
    return paths


EVENT_TICKS = """ticks AS (SELECT {symbol} AS symbol, event_id AS tick_id, epoch_us(ts) // 1000 AS time_ms, value AS price,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS quantity, event_type IN ('view', 'error') AS buyer_is_maker FROM events WHERE value > 0)"""
ORDER_TICKS = """ticks AS (SELECT {symbol} AS symbol, o_orderkey AS tick_id, epoch_us(o_orderdate) // 1000 AS time_ms, o_totalprice AS price,
  CAST(1 AS BIGINT) AS quantity, o_orderstatus = 'F' AS buyer_is_maker FROM orders WHERE o_totalprice > 0)"""


def candles_sql(ticks_sql: str, symbol: str, step: int) -> str:
    """CTEs ticks and candles."""
    return f"""{ticks_sql.format(symbol=symbol)},
candles AS (SELECT symbol, time_ms - time_ms % {step} AS open_ms, time_ms - time_ms % {step} + {step} AS end_ms, arg_min(price, tick_id) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, tick_id) AS close, CAST(sum(quantity) AS DOUBLE) AS volume, CAST(sum(price * quantity) AS DOUBLE) AS quote_volume, count(*) AS trade_count,
  CAST(sum(CASE WHEN NOT buyer_is_maker THEN quantity ELSE 0 END) AS DOUBLE) AS taker_buy_base_volume,
  CAST(sum(CASE WHEN NOT buyer_is_maker THEN price * quantity ELSE 0.0 END) AS DOUBLE) AS taker_buy_quote_volume FROM ticks GROUP BY ALL)"""


def segmented_sql(step: int) -> str:
    """CTEs g, s and c: gaps, segments, and rows with index, previous values and returns. Needs candles. Without a step a series is one segment."""
    gap = f"coalesce(end_ms - lag(end_ms) OVER (PARTITION BY symbol ORDER BY end_ms) <> {step}, false)" if step else "false"
    return f"""g AS (SELECT *, {gap} AS gap FROM candles),
s AS (SELECT *, CAST(sum(CAST(gap AS BIGINT)) OVER (PARTITION BY symbol ORDER BY end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment_id FROM g),
b AS (SELECT *, row_number() OVER o - 1 AS i, lag(close) OVER o AS pc, (high + low + close) / 3 AS tp, lag((high + low + close) / 3) OVER o AS ptp FROM s WINDOW o AS (PARTITION BY symbol, segment_id ORDER BY end_ms)),
c AS (SELECT *, ln(close / pc) AS r, ln(close) AS lc, CASE WHEN pc IS NOT NULL THEN greatest(close - pc, 0) END AS gain, CASE WHEN pc IS NOT NULL THEN greatest(pc - close, 0) END AS loss,
  CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM b)"""


#: CTEs ticks, candles and days: whole_days() in SQL.
WHOLE_DAYS = f"""{candles_sql(EVENT_TICKS, "'ALL'", HOUR)},
span AS (SELECT min(open_ms) - min(open_ms) % {DAY} AS lo, max(open_ms) - max(open_ms) % {DAY} + {DAY - HOUR} AS hi, arg_min(open, open_ms) AS first_ FROM candles),
hours AS (SELECT first_, unnest(generate_series(lo, hi, {HOUR})) AS open_ms FROM span),
filled AS (SELECT h.open_ms, c.* EXCLUDE (symbol, open_ms, end_ms), coalesce(last_value(c.close IGNORE NULLS) OVER (ORDER BY h.open_ms ROWS UNBOUNDED PRECEDING), h.first_) AS last_ FROM hours h LEFT JOIN candles c ON h.open_ms = c.open_ms),
days AS (SELECT 'ABC' AS symbol, open_ms, coalesce(open, last_) AS open, coalesce(high, last_) AS high, coalesce(low, last_) AS low, coalesce(close, last_) AS close, coalesce(volume, 0) AS volume, coalesce(quote_volume, 0) AS quote_volume,
  coalesce(trade_count, 0) AS trade_count, coalesce(taker_buy_base_volume, 0) AS taker_buy_base_volume, coalesce(taker_buy_quote_volume, 0) AS taker_buy_quote_volume FROM filled)"""
#: A time in milliseconds as UTC text.
UTC_TEXT = "strftime(make_timestamp({0} * 1000), '%Y-%m-%dT%H:%M:%S.') || lpad(CAST({0} % 1000 AS VARCHAR), 3, '0') || 'Z'"
