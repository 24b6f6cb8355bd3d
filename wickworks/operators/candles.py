"""Candles: intervals, schemas, layouts, canonical form, and candles made of ticks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MS = 86_400_000
_UNIT_MS = {"s": 1000, "m": 60_000, "h": 3_600_000, "d": DAY_MS, "w": 7 * DAY_MS}
# The intervals that archives have, and the names of the layouts' columns.
ARCHIVE_INTERVALS = ("1m", "3m", "5m", "15m", "30m", "1h", "2h", "4h", "6h", "8h", "12h", "1d")
MARKETS = ("um", "cm", "spot")
SERIES_KEYS = ("exchange", "product", "symbol", "interval", "price_family")
LEGACY_COLUMNS = (*SERIES_KEYS, "open_time_ms", "close_time_ms", "completed_at_ms", "open_raw", "high_raw", "low_raw", "close_raw", "base_volume_raw", "trade_count", "taker_buy_base_volume_raw")

CANDLE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), False) for c in ("market", "symbol", "interval")]
    + [T.StructField(c, T.TimestampType(), False) for c in ("open_time", "close_time", "feature_available_at")]
    + [T.StructField(c, T.DoubleType(), False) for c in ("open", "high", "low", "close", "volume", "quote_volume")]
    + [T.StructField("trade_count", T.LongType(), False)]
    + [T.StructField(c, T.DoubleType(), False) for c in ("taker_buy_base_volume", "taker_buy_quote_volume", "kline_ignore")]
)
EXTRACTOR_COLUMNS = tuple(f.name for f in CANDLE_SCHEMA)
#: Columns of that layout that features don't read; they may be absent.
NOT_READ = {"quote_volume", "taker_buy_quote_volume", "kline_ignore"}


def interval_ms(text: str) -> int:
    """Milliseconds of a fixed interval such as 15m, 1h or 2d; months and zero are refused."""
    found = re.fullmatch(r"([1-9][0-9]*)([smhdw])", text or "")
    if not found:
        raise ValueError(f"not a fixed interval: {text!r}")
    return int(found[1]) * _UNIT_MS[found[2]]


def layout(columns: Sequence[str]) -> str:
    """'legacy' or 'extractor', by which layout's columns are all there; both or neither is an error."""
    have = set(columns)
    legacy, extractor = set(LEGACY_COLUMNS) <= have, set(EXTRACTOR_COLUMNS) - NOT_READ <= have
    if legacy and {"market", "open_time"} & have:
        raise ValueError("the columns of two candle layouts are mixed")
    if legacy or extractor:
        return "legacy" if legacy else "extractor"
    raise ValueError("the columns fit no known candle layout")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return day * DAY_MS + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000 + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("long")


def bucket(ms: Column, step_ms: int) -> Column:
    """Start of the step that a time falls in."""
    return ms - F.pmod(ms, F.lit(step_ms))


def from_ticks(ticks: DataFrame, keys: Sequence[str], step_ms: int, end: bool = True) -> DataFrame:
    """OHLCV candles of ticks (keys, tick_id, time_ms, price, quantity, buyer_is_maker); ids order a bucket's ticks.

    One hash aggregation with partial sums; first and last price by the least and greatest id, which is free of row order.
    """
    start = bucket(F.col("time_ms"), step_ms)
    grouped = ticks.groupBy(*keys, start.alias("open_ms")).agg(
        F.min_by("price", "tick_id").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "tick_id").alias("close"),
        F.sum("quantity").cast("double").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("quote_volume"),
        F.count("*").alias("trade_count"),
        F.sum(F.when(~F.col("buyer_is_maker"), F.col("quantity")).otherwise(0)).cast("double").alias("taker_buy_base_volume"),
        F.sum(F.when(~F.col("buyer_is_maker"), F.col("price") * F.col("quantity")).otherwise(0.0)).alias("taker_buy_quote_volume"),
    )
    return grouped.withColumn("end_ms", F.col("open_ms") + step_ms) if end else grouped


def resample(candles: DataFrame, keys: Sequence[str], step_ms: int) -> DataFrame:
    """Coarser candles of candles (open_ms as their order)."""
    return candles.groupBy(*keys, bucket(F.col("open_ms"), step_ms).alias("open_ms")).agg(
        F.min_by("open", "open_ms").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "open_ms").alias("close"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"), F.sum("taker_buy_base_volume").alias("taker_buy_base_volume"),
    ).withColumn("end_ms", F.col("open_ms") + step_ms)


def from_extractor(candles: DataFrame, exchange: str = "venue") -> DataFrame:
    """Extractor layout to the canonical columns: exchange and price family are constants, times become milliseconds.

    The files don't name their exchange; its name is part of series ids, so give the one that other runs use.
    """
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    return candles.select(
        F.lit(exchange).alias("exchange"), F.col("market").alias("product"), "symbol", "interval", F.lit("trade").alias("price_family"),
        ms("open_time").alias("open_ms"), ms("close_time").alias("close_ms"), ms("feature_available_at").alias("end_ms"),
        "open", "high", "low", "close", "volume", "trade_count", "taker_buy_base_volume",
        (F.unix_micros(F.col("open_time").cast("timestamp")) % 1000 != 0).alias("below_ms"),
    )


def from_legacy(candles: DataFrame) -> DataFrame:
    """Legacy layout, prices as text, to the canonical columns; text that is no number becomes null for the validators to find."""
    number = lambda c: F.expr(f"try_cast(`{c}` AS double)")
    whole = lambda c: F.when(F.col(c).cast("string").rlike("^[0-9]+$"), F.expr(f"try_cast(`{c}` AS bigint)"))
    return candles.select(
        *SERIES_KEYS, whole("open_time_ms").alias("open_ms"), whole("close_time_ms").alias("close_ms"), whole("completed_at_ms").alias("end_ms"),
        number("open_raw").alias("open"), number("high_raw").alias("high"), number("low_raw").alias("low"), number("close_raw").alias("close"),
        number("base_volume_raw").alias("volume"), whole("trade_count").alias("trade_count"), number("taker_buy_base_volume_raw").alias("taker_buy_base_volume"), F.lit(False).alias("below_ms"),
    )


def canonical(candles: DataFrame, exchange: str = "venue") -> DataFrame:
    """Either layout in canonical columns."""
    return from_legacy(candles) if layout(candles.columns) == "legacy" else from_extractor(candles, exchange)


def utc_text(ms: Column) -> Column:
    """ISO-8601 text of epoch milliseconds with a Z, whatever the session's zone."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / DAY_MS).cast("int"))
    rest = F.pmod(ms, F.lit(DAY_MS))
    two = lambda x, n=2: F.lpad(x.cast("long").cast("string"), n, "0")
    return F.concat(day.cast("string"), F.lit("T"), two(F.floor(rest / 3_600_000)), F.lit(":"), two(F.floor(rest / 60_000) % 60), F.lit(":"), two(F.floor(rest / 1000) % 60), F.lit("."), two(rest % 1000, 3), F.lit("Z"))
