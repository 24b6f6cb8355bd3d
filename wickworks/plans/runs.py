"""Whole runs: features of a candle dataset, and candles of archives."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.functions.catalogue import NAMES
from wickworks.operators import candles as cd
from wickworks.operators import chunked, features, names, quality, segments, ticks
from wickworks.sinks import publish, scratch
from wickworks.sources import archives, fetch, manifest, tables
from wickworks.sources.config import ExtractConfig, FeatureConfig


def calculate(candles: DataFrame, keys: Sequence[str], step_ms: int, gap_policy: str = "reset", chunk_rows: int = 16_384) -> DataFrame:
    """All 128 features of checked candles (keys, end_ms, OHLCV and optional columns).

    A series longer than a chunk is computed in chunks, with equal results; shorter ones are a task each.
    """
    longest = candles.groupBy(*keys).count().agg(F.max("count").alias("n")).first()["n"] or 0
    if longest > chunk_rows:
        return chunked.compute(candles, keys, step_ms, chunk_rows=chunk_rows, policy=gap_policy)
    return features.compute(segments.segment(candles, keys, step_ms, gap_policy), keys)


def series_reports(computed: DataFrame, candles: DataFrame, keys: Sequence[str], step_ms: int, gap_policy: str) -> list[dict]:
    """A report for each series of (keys, end_ms, features), from one wide aggregation; gaps from summaries of blocks of candles."""
    missing = quality.unavailable_inputs(candles)
    gaps = {tuple(r[k] for k in keys): r["gap_count"] for r in segments.gap_counts(candles, keys, step_ms).collect()}
    out = []
    for r in quality.wide(computed, keys, NAMES, missing).collect():
        iso = lambda ms: None if ms is None else f"{ms}ms"
        mine = gaps[tuple(r[k] for k in keys)]
        out.append({
            **{k: r[k] for k in keys}, "rows": r["rows"], "first_candle_end": iso(r["first_end_ms"]), "last_candle_end": iso(r["last_end_ms"]), "interval_ms": step_ms, "gap_policy": gap_policy,
            "gap_count": mine, "calculation_segments": mine + 1 if gap_policy == "reset" else 1, "feature_count": len(NAMES), "features_supported_by_supplied_inputs": len(NAMES) - len(missing),
            "unavailable_due_to_missing_inputs": missing, "rows_complete_for_supported_features": r["complete_supported"], "first_complete_supported_row": iso(r["first_complete_end_ms"]), "rows_complete_for_all_128": r["complete_all"],
            "missing_values_by_feature": {n: r[f"missing_{n}"] for n in NAMES}, "constant_nonmissing_features": [n for n in NAMES if r[f"constant_{n}"]],
        })
    return out


def calculate_file(
    spark: SparkSession, path: str, interval: str, timestamp_role: str, gap_policy: str = "reset", end_offset_ms: int = 0, timestamp: str | None = None, unit: str | None = None, zone: str | None = None, chunk_rows: int = 16_384
) -> tuple[DataFrame, dict]:
    """(end_ms and the 128 features, report) of one instrument's candles in a file of any layout; the meaning of its times is given, not guessed.

    The features are written once, in the shared folder, and the report is over what was written.
    """
    step, keys = cd.interval_ms(interval), ["series"]
    rows = tables.ends(tables.read_generic(spark, path, timestamp, unit, zone), step, timestamp_role, end_offset_ms)
    rows = tables.spaced(rows.withColumn("series", F.lit(path)), step, keys)
    computed = scratch.table(calculate(rows, keys, step, gap_policy, chunk_rows), "calculated")
    (report,) = series_reports(computed, rows, keys, step, gap_policy)
    notes = ["Features use a completed candle and those before it only.", "Warm-up and undefined values stay missing."]
    notes += ["Windows of observed rows reach across gaps."] * (gap_policy == "rows") + ["Times of day can be constant at this interval."] * (step >= cd.DAY_MS)
    notes += ["No row has all features that the inputs allow."] * (not report["rows_complete_for_supported_features"])
    return computed.drop("series", "segment_id"), report | {"input_timestamp_role": timestamp_role, "end_offset_ms": end_offset_ms, "notes": notes}


def generate_dataset(spark: SparkSession, config: FeatureConfig, shard_ms: int | None = None) -> dict:
    """Checks, computes, reports and publishes; returns the summary. The features are computed once: the report reads the staged files."""
    if publish.Store(spark, config.output).exists(publish.journal_of(config.output)):
        publish.recover(spark, config.output)
    if publish.Store(spark, config.output).exists(config.output):
        raise FileExistsError(f"the output folder must be new: {config.output}")
    candles, interval = tables.checked(tables.read_candles(spark, config.input, config.symbols))
    keys, step = list(cd.SERIES_KEYS), cd.interval_ms(interval)
    computed = calculate(candles, keys, step, config.gap_policy)

    def summary(staged: DataFrame) -> dict:
        # A symbol has one series, so its report is by symbol; the other keys come from the few series.
        reports = series_reports(staged.withColumn("end_ms", F.unix_millis("candle_end_utc")), candles, ["symbol"], step, config.gap_policy)
        series = candles.select(*keys).distinct().withColumn("series_id", names.series_id(*[F.col(k) for k in keys]))
        found = {r["symbol"]: r.asDict() for r in series.collect()}
        reports = [found[r["symbol"]] | r for r in reports]
        return {"input": config.input, "output": config.output, "gap_policy": config.gap_policy, "feature_count": len(NAMES), "series_count": len(reports), "rows": sum(r["rows"] for r in reports), "series": reports}

    publish.features(computed.select(F.timestamp_millis("end_ms").alias("candle_end_utc"), "symbol", *NAMES), config.output, summary, shard_ms)
    return json.loads(publish.Store(spark, config.output).read_text(f"{config.output.rstrip('/')}/summary.json"))


def download(spark: SparkSession, config: ExtractConfig, unpack: bool = False) -> list[dict]:
    """Fetches the archives of every symbol and dataset from base_url into raw_folder; one manifest a symbol, as JSON beside its archives.
    unpack: each archive's CSV beside it."""
    if not config.base_url:
        raise ValueError("a download needs the setting base_url")
    out = []
    for symbol in config.symbols:
        planned = manifest.plan(spark, config.market, [symbol], config.interval, config.start_date, config.end_date, config.datasets)
        at = f"{config.raw_folder}/{config.market}/{symbol}/{symbol}-{config.interval}-{config.start_date}-{config.end_date}.manifest.json"
        done = fetch.fetch(spark, planned, config.base_url, config.raw_folder, at, config.download_workers, config.download_retries + 1)
        for found in done["objects"] if unpack else ():
            archives.unpack(spark, found["path"])
        out.append({"symbol": symbol, "status": done["status"], "archives": done["expected_objects"], "downloaded": done["downloaded"], "skipped": done["skipped"], "manifest": at})
    return out


def run_extractor(spark: SparkSession, config: ExtractConfig, download_only: bool = False, process_only: bool = False, overwrite: bool = False) -> list[dict]:
    """Downloads and processes, or one of the two; processing alone makes no network request."""
    if download_only and process_only:
        raise ValueError("download_only and process_only exclude each other")
    done = [] if process_only else download(spark, config)
    return done if download_only else extract(spark, config, overwrite)


def extract(spark: SparkSession, config: ExtractConfig, overwrite: bool = False) -> list[dict]:
    """Candles, or hourly candles with trades, of local archives; one file and one report a symbol."""
    out, mode = [], "overwrite" if overwrite else "error"
    for symbol in config.symbols:
        both = "aggTrades" in config.datasets
        root = f"{config.raw_folder}/{config.market}/{symbol}"
        paths = archives.daily_paths(f"{root}/{config.interval}", symbol, config.interval, config.start_date, config.end_date)
        kind = "combined" if both else "klines"
        target = f"{config.preprocessed_folder}/{config.market}/{symbol}/{config.interval}/{symbol}-{config.interval}-{config.start_date}-{config.end_date}-{kind}.{config.output_format}"
        store = publish.Store(spark, root)
        absent = [p for p in paths if not store.exists(p)]
        report = {"market": config.market, "symbol": symbol, "interval": config.interval, "start_date": str(config.start_date), "end_date": str(config.end_date), "output": target}
        if both:
            trades = archives.daily_paths(f"{root}/aggTrades", symbol, "aggTrades", config.start_date, config.end_date)
            absent += [p for p in trades if not store.exists(p)]
        if absent:
            raise FileNotFoundError(f"{len(absent)} daily archives are missing; first {absent[0]}")
        if both:
            rows = archives.combined(spark, paths, trades, config.market, symbol)
            found = ticks.report(rows).first().asDict()
            examples = [r.asDict() for r in ticks.examples(rows).collect()]
            report |= found | {"status": "mismatches" if found["mismatched_hours"] else "passed", "mismatch_examples": examples, "tolerance": {"relative": ticks.RELATIVE, "absolute": ticks.ABSOLUTE}}
            flat = rows.select(*[c for c in rows.columns if not c.startswith("raw_") and c not in ("file", "line", "day_ms")])
            publish.text_csv(flat.select(*[cd.utc_text(F.col(c)).alias(n) for n, c in (("open_time", "open_ms"), ("close_time", "close_ms"), ("feature_available_at", "end_ms"))], *[c for c in flat.columns if c not in ("open_ms", "close_ms", "end_ms")]), target, ["open_time"], mode, report)
        else:
            checked = archives.klines(archives.read(spark, paths, archives.KLINE, "aliases"), config.market, symbol, config.interval)
            span = checked.agg(F.count("*").alias("rows"), F.min("open_ms").alias("first_open_ms"), F.max("open_ms").alias("last_open_ms")).first().asDict()
            per_file = checked.groupBy(F.regexp_extract("file", "([^/]+)$", 1).alias("file")).agg(F.count("*").alias("rows"))
            report |= {"sources": [r.asDict() for r in archives.sources(spark, paths).join(per_file, "file").sort("file").collect()]}
            report |= span | {"status": "passed", "expected_rows": len(paths) * cd.DAY_MS // cd.interval_ms(config.interval)}
            if config.output_format == "parquet":
                publish.candles_parquet(archives.candles_of(checked), target, mode, report)
            else:
                publish.text_csv(archives.candles_text(checked), target, ["open_time"], mode, report)
        out.append(report)
    return out
