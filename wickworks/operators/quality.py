"""Data-quality report of a feature frame: one wide aggregation for each series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickworks.functions.catalogue import FAMILIES, NAMES

#: Features that need an input that a source may not have.
OPTIONAL = {"trade_count": ("log1p_trade_count",), "taker_buy_base_volume": FAMILIES["imbalance"]}


def _all_there(names: Sequence[str]):
    ok = F.lit(True)
    for n in names:
        ok = ok & F.col(n).isNotNull()
    return ok


def wide(features: DataFrame, keys: Sequence[str], names: Sequence[str] = NAMES, unavailable: Sequence[str] = ()) -> DataFrame:
    """A row for each series: rows, first and last end, segments if numbered, complete rows, each feature's missing count and whether it is constant."""
    ready, ready_all = _all_there([n for n in names if n not in unavailable]), _all_there(names)
    segments = [F.count_distinct("segment_id").alias("segments")] if "segment_id" in features.columns else []
    return features.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.min("end_ms").alias("first_end_ms"), F.max("end_ms").alias("last_end_ms"), *segments,
        F.count_if(ready).alias("complete_supported"), F.min(F.when(ready, F.col("end_ms"))).alias("first_complete_end_ms"), F.count_if(ready_all).alias("complete_all"),
        *[(F.count("*") - F.count(n)).alias(f"missing_{n}") for n in names], *[F.coalesce(F.min(n) == F.max(n), F.lit(False)).alias(f"constant_{n}") for n in names],
    )


def by_feature(features: DataFrame, keys: Sequence[str], names: Sequence[str] = NAMES) -> DataFrame:
    """(keys, feature, missing, constant), from the wide aggregation."""
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"missing_{n}").alias("missing"), F.col(f"constant_{n}").alias("constant")) for n in names])
    return wide(features, keys, names).select(*keys, F.inline(rows))


def unavailable_inputs(candles: DataFrame) -> list[str]:
    """Features that the candles' optional inputs, absent or null throughout, leave undefined."""
    there = [c for c in OPTIONAL if c in candles.columns]
    counts = candles.agg(*[F.count(c).alias(c) for c in there]).first() if there else {}
    return [f for c, fs in OPTIONAL.items() if c not in there or not counts[c] for f in fs]
