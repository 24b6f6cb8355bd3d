"""Gap segmentation: maximal gap-free runs inside a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickworks.operators import order

POLICIES = ("reset", "rows")


def segment(candles: DataFrame, keys: Sequence[str], step_ms: int, policy: str = "reset", at: str = "end_ms") -> DataFrame:
    """Adds gap (the row doesn't follow its predecessor by one step) and segment_id (numbered from 0 in a series).

    reset starts a segment at each gap; rows keeps one segment a series and still flags the gaps.
    """
    if policy not in POLICIES:
        raise ValueError(f"gap policy must be one of {POLICIES}")
    if step_ms <= 0:
        raise ValueError("the candle step must be positive")
    ordered = Window.partitionBy(*keys).orderBy(at)
    out = candles.withColumn("gap", F.coalesce(F.col(at) - F.lag(at).over(ordered) != step_ms, F.lit(False)))
    number = F.sum(F.col("gap").cast("long")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) if policy == "reset" else F.lit(0).cast("long")
    return out.withColumn("segment_id", number)


def summary(segmented: DataFrame, keys: Sequence[str], at: str = "end_ms") -> DataFrame:
    """Rows, gaps, segments and the longest segment of each series."""
    per = segmented.groupBy(*keys, "segment_id").agg(F.count("*").alias("n"), F.sum(F.col("gap").cast("long")).alias("gaps"))
    return per.groupBy(*keys).agg(F.sum("n").alias("rows"), F.sum("gaps").alias("gap_count"), F.count("*").alias("segments"), F.max("n").alias("longest_segment"))


def gap_counts(candles: DataFrame, keys: Sequence[str], step_ms: int, at: str = "end_ms", block: int = order.BLOCK) -> DataFrame:
    """keys, rows and gap_count, from summaries of blocks of time: no window over a whole series."""
    return order.summaries(candles, keys, [at], [order.steps("gap_count", at, step_ms)], block=step_ms * block)


def runs(candles: DataFrame, keys: Sequence[str], step_ms: int, at: str = "end_ms", block: int = order.BLOCK) -> DataFrame:
    """(keys, segment_id, first, last, rows) of each gap-free run, numbered from 0 in a series.

    Runs are found inside blocks of time first; only those, a block's worth of rows fewer or as many as there are gaps, are put in order over
    a series and joined where one ends a step before the next begins.
    """
    rows = candles.select(*keys, F.col(at).alias("__at"), F.floor(F.col(at) / (step_ms * block)).alias("__block"))
    inside = Window.partitionBy(*keys, "__block").orderBy("__at")
    rows = rows.withColumn("__gap", F.coalesce(F.col("__at") - F.lag("__at").over(inside) != step_ms, F.lit(False)))
    rows = rows.withColumn("__run", F.sum(F.col("__gap").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy(*keys, "__block", "__run").agg(F.min("__at").alias("first"), F.max("__at").alias("last"), F.count("*").alias("rows"))
    series = Window.partitionBy(*keys).orderBy("first")
    parts = parts.withColumn("__gap", F.coalesce(F.col("first") - F.lag("last").over(series) != step_ms, F.lit(False)))
    parts = parts.withColumn("segment_id", F.sum(F.col("__gap").cast("long")).over(series.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy(*keys, "segment_id").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"))


def summary_by_runs(candles: DataFrame, keys: Sequence[str], step_ms: int, at: str = "end_ms", block: int = order.BLOCK) -> DataFrame:
    """summary() without a window over a series' rows."""
    found = runs(candles, keys, step_ms, at, block)
    return found.groupBy(*keys).agg(F.sum("rows").alias("rows"), (F.count("*") - 1).alias("gap_count"), F.count("*").alias("segments"), F.max("rows").alias("longest_segment"))
