"""Ticks by interval against candles: aggregation, join, derived metrics, match flags and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.functions.windows import div0
from wickworks.operators.candles import bucket

RELATIVE, ABSOLUTE = 1e-8, 1e-6
MATCHES = ("base_volume_matches", "quote_volume_matches", "taker_buy_base_volume_matches", "taker_buy_quote_volume_matches", "ohlc_matches")
_SUMS = ("agg_base_volume", "agg_quote_volume", "agg_taker_buy_base_volume", "agg_taker_sell_base_volume", "agg_taker_buy_quote_volume", "agg_taker_sell_quote_volume")


def close(a: Column, b: Column) -> Column:
    """Equal within a relative or an absolute tolerance."""
    return F.abs(a - b) <= F.greatest(RELATIVE * F.greatest(F.abs(a), F.abs(b)), F.lit(ABSOLUTE))


def aggregate(ticks: DataFrame, keys: Sequence[str], step_ms: int) -> DataFrame:
    """Counts, volumes by side and OHLC of each step's ticks, with vwap, buy fraction and imbalance (null without volume)."""
    quote, buy = F.col("price") * F.col("quantity"), ~F.col("buyer_is_maker")
    side = lambda keep, x: F.sum(F.when(keep, x).otherwise(0.0)).cast("double")
    out = ticks.groupBy(*keys, bucket(F.col("time_ms"), step_ms).alias("open_ms")).agg(
        F.count("*").alias("agg_trade_count"),
        F.sum("quantity").cast("double").alias("agg_base_volume"),
        F.sum(quote).alias("agg_quote_volume"),
        side(buy, F.col("quantity")).alias("agg_taker_buy_base_volume"),
        side(~buy, F.col("quantity")).alias("agg_taker_sell_base_volume"),
        side(buy, quote).alias("agg_taker_buy_quote_volume"),
        side(~buy, quote).alias("agg_taker_sell_quote_volume"),
        F.min_by("price", "tick_id").alias("agg_open"),
        F.max("price").alias("agg_high"),
        F.min("price").alias("agg_low"),
        F.max_by("price", "tick_id").alias("agg_close"),
    )
    return derive(out)


def derive(buckets: DataFrame) -> DataFrame:
    base = F.col("agg_base_volume")
    return buckets.withColumns({
        "agg_vwap": div0(F.col("agg_quote_volume"), base),
        "agg_buy_volume_fraction": div0(F.col("agg_taker_buy_base_volume"), base),
        "agg_volume_imbalance": div0(F.col("agg_taker_buy_base_volume") - F.col("agg_taker_sell_base_volume"), base),
    })


def reconcile(candles: DataFrame, buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candles with their steps' ticks (none: counts and sums 0, prices null), differences and match flags."""
    both = candles.join(buckets, [*keys, "open_ms"], "left")
    both = both.withColumns({"agg_trade_count": F.coalesce("agg_trade_count", F.lit(0))} | {c: F.coalesce(c, F.lit(0.0)) for c in _SUMS})
    price = close(F.col("agg_open"), F.col("open")) & close(F.col("agg_high"), F.col("high")) & close(F.col("agg_low"), F.col("low")) & close(F.col("agg_close"), F.col("close"))
    both = both.withColumns({
        "base_volume_difference": F.col("agg_base_volume") - F.col("volume"),
        "quote_volume_difference": F.col("agg_quote_volume") - F.col("quote_volume"),
        "base_volume_matches": close(F.col("agg_base_volume"), F.col("volume")),
        "quote_volume_matches": close(F.col("agg_quote_volume"), F.col("quote_volume")),
        "taker_buy_base_volume_matches": close(F.col("agg_taker_buy_base_volume"), F.col("taker_buy_base_volume")),
        "taker_buy_quote_volume_matches": close(F.col("agg_taker_buy_quote_volume"), F.col("taker_buy_quote_volume")),
        "ohlc_matches": F.when(F.col("agg_trade_count") > 0, price).otherwise((F.col("trade_count") == 0) & (F.col("volume") == 0)),
    })
    every = F.lit(True)
    for c in MATCHES:
        every = every & F.col(c)
    return both.withColumn("all_metrics_match", every)


def report(reconciled: DataFrame) -> DataFrame:
    """One row: rows, ticks, rows without ticks, mismatched rows, and failures by flag."""
    return reconciled.agg(
        F.count("*").alias("rows"),
        F.sum("agg_trade_count").alias("agg_trade_records"),
        F.count_if(F.col("agg_trade_count") == 0).alias("hours_without_agg_trades"),
        F.count_if(~F.col("all_metrics_match")).alias("mismatched_hours"),
        *[F.count_if(~F.col(c)).alias(f"failed_{c}") for c in MATCHES],
    )


def examples(reconciled: DataFrame, keys: Sequence[str] = (), n: int = 20) -> DataFrame:
    """The first n mismatched rows by time: a top-k, so no full sort."""
    failed = F.array_join(F.array_compact(F.array(*[F.when(~F.col(c), F.lit(c)) for c in MATCHES])), ",")
    rows = reconciled.where(~F.col("all_metrics_match")).orderBy("open_ms", *keys).limit(n)
    return rows.select(*keys, "open_ms", failed.alias("failed"), "base_volume_difference", "quote_volume_difference")


def last_tick(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ticks.groupBy(*keys).agg(F.max("tick_id").alias("last_tick_id"), F.max("time_ms").alias("last_time_ms"))
