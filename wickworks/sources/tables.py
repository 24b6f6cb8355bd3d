"""Candle tables: Parquet datasets of either layout, and generic files with aliased columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators import candles as cd
from wickworks.operators import names, order, validate
from wickworks.sources import times


def read_candles(spark: SparkSession, path: str | Sequence[str], symbols: Sequence[str] = (), exchange: str = "venue") -> DataFrame:
    """Canonical candles of a Parquet file or folder; the symbol filter reaches the scan. Unknown symbols are an error."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(*paths)
    if symbols:
        missing = [r["symbol"] for r in validate.missing_keys(symbols, raw).collect()]
        if missing:
            raise ValueError(f"symbols not in the input: {sorted(missing)}")
        raw = raw.where(F.col("symbol").isin(*symbols))
    return cd.canonical(raw, exchange)


def checked(candles: DataFrame) -> tuple[DataFrame, str]:
    """Canonical candles that passed every rule, and their interval; one series a symbol and one interval a run."""
    keys = list(cd.SERIES_KEYS)
    validate.require(candles, validate.key_rules(keys))
    crowded = [r["symbol"] for r in validate.crowded_symbols(candles, keys).limit(5).collect()]
    if crowded:
        raise ValueError(f"more than one series for {crowded}")
    intervals = [r["interval"] for r in candles.select("interval").distinct().limit(2).collect()]
    if len(intervals) != 1:
        raise ValueError("no candles" if not intervals else f"more than one interval: {intervals}")
    step = cd.interval_ms(intervals[0])
    rules = validate.candle_rules(step) | {"times in whole milliseconds": ~F.col("below_ms"), "optional columns given": F.col("trade_count").isNotNull() & F.col("taker_buy_base_volume").isNotNull()}
    validate.require_none(order.violations(candles, keys, ["end_ms"], [order.rising("times strictly increasing", "end_ms")], rules, step * order.BLOCK))
    return candles, intervals[0]


def read_generic(spark: SparkSession, path: str, timestamp: str | None = None, unit: str | None = None, zone: str | None = None) -> DataFrame:
    """(time_ms, canonical columns) of a Parquet, CSV, TSV, gzip or Excel file. Numeric times need unit; times without zone need one.

    Excel is read on the driver, as one workbook is no large table, and needs openpyxl; any other file is read by Spark, a text file's cells
    as text, so that no type or session's zone is guessed. A file without rows, names that are the same after trimming, case and blanks,
    several instruments, cells that are no numbers, and times that are missing, repeated, ambiguous or don't exist are errors.
    """
    low = path.lower()
    if low.endswith((".xlsx", ".xls")):
        import pandas as pd

        try:
            raw = spark.createDataFrame(pd.read_excel(path))
        except ImportError as e:
            raise RuntimeError("Excel input needs openpyxl") from e
    elif low.endswith(".parquet"):
        raw = spark.read.parquet(path)
    elif not low.endswith((".csv", ".tsv", ".gz")):
        raise ValueError("the file is Parquet, CSV, TSV, gzip or Excel")
    else:
        raw = spark.read.option("header", "true").option("sep", "\t" if ".tsv" in low else ",").csv(path)
    if raw.isEmpty():
        raise ValueError(f"{path}: no rows")
    found = names.resolve(raw.columns)
    for c in (c for c in raw.columns if names.normal_text(c) in names.INSTRUMENTS):
        if raw.select(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))).distinct().limit(2).count() > 1:
            raise ValueError(f"more than one instrument in {c}")
    wanted = names.normal_text(timestamp) if timestamp else None
    stamps = [c for c in raw.columns if names.normal_text(c) == wanted] if wanted else [c for c in raw.columns if names.normal_text(c) in names.TIMES]
    if len(stamps) != 1:
        raise ValueError(f"name the timestamp column; candidates: {stamps}")
    ms, rules = times.parse(raw, stamps[0], unit, zone)
    cells = {f: F.col(f"`{c}`").try_cast("double") for f, c in found.items()}
    for f, c in found.items():
        rules[f"{f} is a number"] = F.col(f"`{c}`").isNull() | cells[f].isNotNull()
    rules |= {f"{f} finite": validate.finite(cells[f]) for f in names.REQUIRED}
    validate.require(raw, rules)
    out = raw.select(ms.alias("time_ms"), *[c.alias(f) for f, c in cells.items()])
    repeated = out.groupBy("time_ms").count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    if repeated:
        raise validate.ValidationError({"times unique": repeated})
    return out


def spaced(candles: DataFrame, step_ms: int, keys: Sequence[str] = (), at: str = "end_ms") -> DataFrame:
    """candles, whose neighbours are a step apart at least; closer ones fail the run. Found from blocks of time, not by a window over all."""
    rows = candles if keys else candles.withColumn("__all", F.lit(0))
    validate.require_none(order.violations(rows, list(keys) or ["__all"], [at], [order.apart("candles a step apart at least", at, step_ms)], block=step_ms * order.BLOCK))
    return candles


def ends(candles: DataFrame, step_ms: int, role: str, offset_ms: int = 0) -> DataFrame:
    """end_ms of rows whose time_ms is a candle's start, or its end less an offset below the step."""
    if role not in ("start", "end") or not 0 <= offset_ms < step_ms or role == "start" and offset_ms:
        raise ValueError("role is start or end; an offset belongs to an end and is shorter than the step")
    return candles.withColumn("end_ms", F.col("time_ms") + (step_ms if role == "start" else offset_ms))
