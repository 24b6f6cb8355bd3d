"""Archive manifests: which files a range needs, and whether those at hand are whole. fetch.py gets them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def plan(spark: SparkSession, market: str, symbols: Sequence[str], interval: str, start: date, end: date, datasets: Sequence[str] = ("klines",)) -> DataFrame:
    """(symbol, dataset, day, path) of each daily archive from start to end, both in."""
    if end < start:
        raise ValueError("the end is before the start")
    if not set(datasets) <= {"klines", "aggTrades"}:
        raise ValueError("datasets are klines and aggTrades")
    kinds = [(s, d, interval if d == "klines" else "aggTrades") for s in symbols for d in datasets]
    base = spark.createDataFrame(kinds, "symbol string, dataset string, kind string")
    days = base.select("*", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
    name = F.concat_ws("-", "symbol", "kind", F.col("day").cast("string"))
    return days.select("symbol", "dataset", "day", F.concat_ws("/", F.lit(market), "symbol", "kind", F.concat(name, F.lit(".zip"))).alias("path"))


def verify(planned: DataFrame, folder: str) -> DataFrame:
    """Adds status: ok, missing, no checksum or mismatch, by the SHA-256 in each archive's .CHECKSUM file, and bytes."""
    spark = planned.sparkSession
    base = folder.rstrip("/")
    tail = F.regexp_extract("path", r"([^/]+/[^/]+/[^/]+/[^/]+)$", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(base).select(tail.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.CHECKSUM").text(base)
    sums = lines.select(F.regexp_extract("value", r"^([0-9a-fA-F]{64})\s+\*?(\S+)\s*$", 1).alias("expected"), F.regexp_extract("value", r"^([0-9a-fA-F]{64})\s+\*?(\S+)\s*$", 2).alias("name")).where("expected <> ''")
    sums = sums.groupBy("name").agg(F.lower(F.min("expected")).alias("expected"), F.count_distinct("expected").alias("lines"))
    both = planned.join(files, "path", "left").withColumn("name", F.regexp_extract("path", "([^/]+)$", 1)).join(sums, "name", "left")
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("expected").isNull() | (F.col("lines") != 1), "no checksum").when(F.col("sha256") == F.col("expected"), "ok").otherwise("mismatch")
    return both.select("symbol", "dataset", "day", "path", status.alias("status"), "bytes")


def totals(verified: DataFrame) -> DataFrame:
    return verified.groupBy("status").agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def pairing(verified: DataFrame) -> DataFrame:
    """(symbol, day, klines, aggTrades, paired): whether a day's archives of both kinds are at hand, as a combined run needs them."""
    there = lambda d: F.coalesce(F.bool_or((F.col("dataset") == d) & (F.col("status") != "missing")), F.lit(False))
    return verified.groupBy("symbol", "day").agg(there("klines").alias("klines"), there("aggTrades").alias("aggTrades")).withColumn("paired", F.col("klines") & F.col("aggTrades"))
