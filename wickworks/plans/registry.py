"""Registered queries over the operators, and their DuckDB equivalents on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickworks.functions import smoothing
from wickworks.functions.catalogue import FAMILIES, NAMES
from wickworks.functions.windows import finite
from wickworks.operators import candles as cd
from wickworks.operators import chunked, features, names, order, quality, segments, ticks, validate
from wickworks.plans import feature_sql as fs
from wickworks.plans import fixtures as fx
from wickworks.plans import runs
from wickworks.sinks import legacy, publish, scratch
from wickworks.sources import archives, manifest, tables, times
from wickworks.sources.config import ExtractConfig
from wickworks.streaming import candles as stream

KEYS = ["symbol"]
_EVENTS = fx.candles_sql(fx.EVENT_TICKS, "'ALL'", fx.HOUR)
_BY_TYPE = fx.candles_sql(fx.EVENT_TICKS, "event_type", fx.HOUR)
_ORDERS = fx.candles_sql(fx.ORDER_TICKS, "'ALL'", fx.DAY)
_BY_PRIORITY = fx.candles_sql(fx.ORDER_TICKS, "o_orderpriority", fx.DAY)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        _QUERIES[name or f.__name__] = f
        if sql:
            _ORACLE[name or f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def r6(x, digits: int = 6):
    """Rounded, with minus zero as zero."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x, digits) + 0.0


# Ticks, candles, reconciliation ----------------------------------------------------------------------------------------------

_TICK_AGG = """buckets AS (SELECT symbol, time_ms - time_ms % {step} AS open_ms, count(*) AS agg_trade_count, CAST(sum(quantity) AS DOUBLE) AS agg_base_volume, CAST(sum(price * quantity) AS DOUBLE) AS agg_quote_volume,
  CAST(sum(CASE WHEN NOT buyer_is_maker THEN quantity ELSE 0 END) AS DOUBLE) AS agg_taker_buy_base_volume, CAST(sum(CASE WHEN buyer_is_maker THEN quantity ELSE 0 END) AS DOUBLE) AS agg_taker_sell_base_volume,
  CAST(sum(CASE WHEN NOT buyer_is_maker THEN price * quantity ELSE 0.0 END) AS DOUBLE) AS agg_taker_buy_quote_volume, CAST(sum(CASE WHEN buyer_is_maker THEN price * quantity ELSE 0.0 END) AS DOUBLE) AS agg_taker_sell_quote_volume,
  arg_min(price, tick_id) AS agg_open, max(price) AS agg_high, min(price) AS agg_low, arg_max(price, tick_id) AS agg_close FROM ticks GROUP BY ALL)"""
_AGG_NUMBERS = ("agg_base_volume", "agg_quote_volume", "agg_taker_buy_base_volume", "agg_taker_sell_base_volume", "agg_taker_buy_quote_volume", "agg_taker_sell_quote_volume", "agg_open", "agg_high", "agg_low", "agg_close")


@query(f"""WITH {fx.EVENT_TICKS.format(symbol="event_type")}, {_TICK_AGG.format(step=fx.HOUR)}
SELECT symbol, open_ms, agg_trade_count, {", ".join(f"round({c}, 4) AS {c}" for c in _AGG_NUMBERS)}, round(agg_quote_volume / nullif(agg_base_volume, 0), 9) + 0.0 AS agg_vwap,
  round(agg_taker_buy_base_volume / nullif(agg_base_volume, 0), 9) + 0.0 AS agg_buy_volume_fraction, round((agg_taker_buy_base_volume - agg_taker_sell_base_volume) / nullif(agg_base_volume, 0), 9) + 0.0 AS agg_volume_imbalance FROM buckets""")
def tick_hourly_agg(spark, sf_dir):
    out = ticks.aggregate(fx.ticks(spark, sf_dir, by_type=True), KEYS, fx.HOUR)
    return out.select("symbol", "open_ms", "agg_trade_count", *[F.round(c, 4).alias(c) for c in _AGG_NUMBERS], *[r6(c, 9).alias(c) for c in ("agg_vwap", "agg_buy_volume_fraction", "agg_volume_imbalance")])


def _perturbed(spark, sf_dir):
    """Hourly candles against their own ticks, with volume and close changed in every seventh hour, so that some rows fail."""
    odd = F.pmod(F.floor(F.col("open_ms") / fx.HOUR), F.lit(7)) == 0
    c = fx.hourly(spark, sf_dir).withColumns({"volume": F.when(odd, F.col("volume") * 1.01).otherwise(F.col("volume")), "close": F.when(odd, F.col("close") + 1).otherwise(F.col("close"))})
    return ticks.reconcile(c, ticks.aggregate(fx.ticks(spark, sf_dir), KEYS, fx.HOUR), KEYS)


_ISCLOSE = "abs({a} - {b}) <= greatest(1e-8 * greatest(abs({a}), abs({b})), 1e-6)"
_RECONCILE = f"""WITH {_EVENTS}, {_TICK_AGG.format(step=fx.HOUR)},
changed AS (SELECT * REPLACE (CASE WHEN (open_ms // {fx.HOUR}) % 7 = 0 THEN volume * 1.01 ELSE volume END AS volume, CASE WHEN (open_ms // {fx.HOUR}) % 7 = 0 THEN close + 1 ELSE close END AS close) FROM candles),
joined AS (SELECT c.*, b.* EXCLUDE (symbol, open_ms) FROM changed c LEFT JOIN buckets b ON c.symbol = b.symbol AND c.open_ms = b.open_ms),
flags AS (SELECT symbol, open_ms, agg_trade_count, agg_base_volume - volume AS base_volume_difference, agg_quote_volume - quote_volume AS quote_volume_difference, {_ISCLOSE.format(a="agg_base_volume", b="volume")} AS base_volume_matches,
  {_ISCLOSE.format(a="agg_quote_volume", b="quote_volume")} AS quote_volume_matches, {_ISCLOSE.format(a="agg_taker_buy_base_volume", b="taker_buy_base_volume")} AS taker_buy_base_volume_matches,
  {_ISCLOSE.format(a="agg_taker_buy_quote_volume", b="taker_buy_quote_volume")} AS taker_buy_quote_volume_matches,
  {" AND ".join(_ISCLOSE.format(a=f"agg_{k}", b=k) for k in ("open", "high", "low", "close"))} AS ohlc_matches FROM joined),
final AS (SELECT *, {" AND ".join(ticks.MATCHES)} AS all_metrics_match FROM flags)"""


@query(f"{_RECONCILE} SELECT symbol, open_ms, agg_trade_count, round(base_volume_difference, 4) + 0.0 AS base_volume_difference, round(quote_volume_difference, 4) + 0.0 AS quote_volume_difference, {', '.join(ticks.MATCHES)}, all_metrics_match FROM final")
def tick_candle_reconcile(spark, sf_dir):
    return _perturbed(spark, sf_dir).select("symbol", "open_ms", "agg_trade_count", r6("base_volume_difference", 4).alias("base_volume_difference"), r6("quote_volume_difference", 4).alias("quote_volume_difference"), *ticks.MATCHES, "all_metrics_match")


@query(f"""{_RECONCILE} SELECT count(*) AS rows, CAST(sum(agg_trade_count) AS BIGINT) AS agg_trade_records, count(*) FILTER (agg_trade_count = 0) AS hours_without_agg_trades, count(*) FILTER (NOT all_metrics_match) AS mismatched_hours,
{", ".join(f"count(*) FILTER (NOT {c}) AS failed_{c}" for c in ticks.MATCHES)} FROM final""")
def mismatch_report(spark, sf_dir):
    return ticks.report(_perturbed(spark, sf_dir))


@query(f"""{_RECONCILE} SELECT symbol, open_ms, array_to_string(list_filter([{", ".join(f"CASE WHEN NOT {c} THEN '{c}' END" for c in ticks.MATCHES)}], lambda x: x IS NOT NULL), ',') AS failed,
round(base_volume_difference, 4) + 0.0 AS base_volume_difference, round(quote_volume_difference, 4) + 0.0 AS quote_volume_difference FROM final WHERE NOT all_metrics_match ORDER BY open_ms, symbol LIMIT 20""")
def mismatch_examples_top20(spark, sf_dir):
    return ticks.examples(_perturbed(spark, sf_dir), KEYS).withColumns({c: r6(c, 4) for c in ("base_volume_difference", "quote_volume_difference")})


_OHLCV = "symbol, open_ms, end_ms, open, high, low, close, round(volume, 4) AS volume, trade_count, round(taker_buy_base_volume, 4) AS taker_buy_base_volume"


def _ohlcv(c):
    return c.select("symbol", "open_ms", "end_ms", "open", "high", "low", "close", F.round("volume", 4).alias("volume"), "trade_count", F.round("taker_buy_base_volume", 4).alias("taker_buy_base_volume"))


for _label, _step in (("15m", 900_000), ("1h", fx.HOUR)):
    query(f"WITH {fx.candles_sql(fx.EVENT_TICKS, 'event_type', _step)} SELECT {_OHLCV} FROM candles", f"interval_resample_{_label}")(
        lambda spark, sf_dir, _step=_step: _ohlcv(cd.resample(cd.from_ticks(fx.ticks(spark, sf_dir, by_type=True), KEYS, 300_000), KEYS, _step))
    )
query(f"WITH {_BY_PRIORITY} SELECT {_OHLCV} FROM candles", "interval_resample_1d")(lambda spark, sf_dir: _ohlcv(fx.daily(spark, sf_dir, by_priority=True)))


@query(f"WITH {fx.EVENT_TICKS.format(symbol='event_type')} SELECT symbol, max(tick_id) AS last_tick_id, max(time_ms) AS last_time_ms FROM ticks GROUP BY symbol")
def last_tick(spark, sf_dir):
    return ticks.last_tick(fx.ticks(spark, sf_dir, by_type=True), KEYS)


# Segments and checks ---------------------------------------------------------------------------------------------------------


@query(f"WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)} SELECT symbol, end_ms, gap, segment_id FROM s")
def candle_gap_segments(spark, sf_dir):
    return segments.segment(fx.daily(spark, sf_dir, True), KEYS, fx.DAY).select("symbol", "end_ms", "gap", "segment_id")


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)}, p AS (SELECT symbol, segment_id, count(*) AS n, CAST(sum(CAST(gap AS BIGINT)) AS BIGINT) AS gaps FROM s GROUP BY ALL)
SELECT symbol, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(gaps) AS BIGINT) AS gap_count, count(*) AS segments, max(n) AS longest_segment FROM p GROUP BY symbol""")
def segment_summary(spark, sf_dir):
    return segments.summary(segments.segment(fx.daily(spark, sf_dir, True), KEYS, fx.DAY), KEYS)


@query(f"""WITH {_BY_PRIORITY}, span AS (SELECT symbol, min(open_ms) AS lo, max(open_ms) AS hi FROM candles GROUP BY symbol), expected AS (SELECT symbol, unnest(generate_series(lo, hi, {fx.DAY})) AS open_ms FROM span)
SELECT e.symbol, e.open_ms FROM expected e ANTI JOIN candles c ON e.symbol = c.symbol AND e.open_ms = c.open_ms""")
def missing_candles_antijoin(spark, sf_dir):
    return validate.missing_times(fx.daily(spark, sf_dir, True), KEYS, fx.DAY)


@query("SELECT symbol, time_ms, n FROM (SELECT o_orderpriority AS symbol, epoch_us(o_orderdate) // 1000 AS time_ms, count(*) AS n FROM orders WHERE o_totalprice > 0 GROUP BY ALL) WHERE n > 1")
def duplicate_keys(spark, sf_dir):
    return validate.duplicates(fx.order_ticks(spark, sf_dir, True), ["symbol", "time_ms"])


def _broken(spark, sf_dir):
    """Hourly candles of which some break each rule, by hour."""
    hour = F.floor(F.col("open_ms") / fx.HOUR)
    at = lambda k: F.pmod(hour, F.lit(11)) == k
    c = fx.hourly(spark, sf_dir).withColumn("close_ms", F.when(at(1), F.col("end_ms")).otherwise(F.col("end_ms") - 1))
    return c.withColumns({"low": F.when(at(2), F.col("high") + 1).otherwise(F.col("low")), "volume": F.when(at(3), -1.0).otherwise(F.col("volume")), "taker_buy_base_volume": F.when(at(4), F.col("volume") + 1).otherwise(F.col("taker_buy_base_volume")), "open": F.when(at(5), 0.0).otherwise(F.col("open"))})


_BROKEN = f"""WITH {_EVENTS}, broken AS (SELECT symbol, open_ms, end_ms, CASE WHEN h = 1 THEN end_ms ELSE end_ms - 1 END AS close_ms, CASE WHEN h = 5 THEN 0.0 ELSE open END AS open, high, CASE WHEN h = 2 THEN high + 1 ELSE low END AS low, close,
  CASE WHEN h = 3 THEN -1.0 ELSE volume END AS volume, CASE WHEN h = 4 THEN volume + 1 ELSE taker_buy_base_volume END AS taker_buy_base_volume, trade_count FROM (SELECT *, (open_ms // {fx.HOUR}) % 11 AS h FROM candles))"""
_RULES = {
    "open time on its boundary": f"open_ms % {fx.HOUR} = 0",
    "close time one millisecond before the end": f"close_ms = open_ms + {fx.HOUR} - 1",
    "availability at the end": f"end_ms = open_ms + {fx.HOUR}",
    "prices finite and positive": "least(open, high, low, close) > 0",
    "volume finite and not negative": "volume >= 0",
    "low <= open, close <= high": "low <= least(open, close) AND greatest(open, close) <= high",
    "trade count whole and not negative": "trade_count >= 0",
    "taker buy volume within the volume": "taker_buy_base_volume >= 0 AND taker_buy_base_volume <= volume",
}


@query(_BROKEN + " UNION ALL ".join(f" SELECT '{name}' AS rule, count(*) FILTER (NOT ({ok})) AS violations FROM broken" for name, ok in _RULES.items()))
def candle_rule_violations(spark, sf_dir):
    return validate.violations(_broken(spark, sf_dir), validate.candle_rules(fx.HOUR))


@query(f"{_BROKEN} SELECT symbol, open_ms, open, high, low, close FROM broken WHERE NOT (low <= least(open, close) AND greatest(open, close) <= high)")
def ohlc_violations(spark, sf_dir):
    return _broken(spark, sf_dir).where(~validate.ohlc_consistent()).select("symbol", "open_ms", "open", "high", "low", "close")


@query("""WITH t AS (SELECT event_type AS symbol, event_id, epoch_us(ts) // 1000 AS time_ms, (event_id * 7919) % 1009 AS shuffled FROM events),
o AS (SELECT *, lag(time_ms) OVER (PARTITION BY symbol ORDER BY shuffled, event_id) AS before_ FROM t)
SELECT symbol, count(*) FILTER (NOT (before_ IS NULL OR time_ms > before_)) AS violations FROM o GROUP BY symbol""")
def order_violations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("symbol"), "event_id", cd.epoch_ms(F.col("ts")).alias("time_ms"), ((F.col("event_id") * 7919) % 1009).alias("shuffled"))
    checks = [order.rising("violations", "time_ms")]
    return order.summaries(rows, KEYS, ["shuffled", "event_id"], checks).select("symbol", "violations")


@query(f"WITH {_BY_TYPE} SELECT DISTINCT symbol FROM candles")
def series_keys_distinct(spark, sf_dir):
    return validate.series(cd.from_ticks(fx.ticks(spark, sf_dir, True), KEYS, fx.HOUR), KEYS)


@query("SELECT symbol, count(*) AS series FROM (SELECT DISTINCT o_orderpriority AS symbol, o_orderstatus AS market FROM orders) GROUP BY symbol HAVING count(*) > 1")
def single_series_check(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderstatus").alias("market"))
    return validate.crowded_symbols(orders, ["symbol", "market"])


@query("SELECT * FROM (VALUES ('click'), ('nothing'), ('purchase')) r(symbol) WHERE symbol NOT IN (SELECT event_type FROM events)")
def requested_symbols_antijoin(spark, sf_dir):
    return validate.missing_keys(["click", "nothing", "purchase"], spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("event_type", "symbol"))


@query("""WITH t AS (SELECT trim(x) AS x FROM (SELECT p_name AS x FROM part UNION ALL SELECT CAST(p_retailprice AS VARCHAR) FROM part UNION ALL SELECT CAST(p_partkey AS VARCHAR) FROM part))
SELECT count(*) FILTER (regexp_matches(x, '^[0-9]+$') AND TRY_CAST(x AS BIGINT) IS NOT NULL) AS integers, count(*) FILTER (regexp_matches(x, '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$') AND TRY_CAST(x AS DOUBLE) >= 0) AS numbers, count(*) AS rows FROM t""")
def numeric_text_checks(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    t = part.select(F.trim("p_name").alias("x")).union(part.select(F.col("p_retailprice").cast("string"))).union(part.select(F.col("p_partkey").cast("string")))
    return t.agg(F.count_if(validate.is_integer(F.col("x"))).alias("integers"), F.count_if(validate.is_number(F.col("x"))).alias("numbers"), F.count("*").alias("rows"))


# Features --------------------------------------------------------------------------------------------------------------------


def _family(family: str):
    return lambda spark, sf_dir: _rounded(features.compute(segments.segment(fx.hourly(spark, sf_dir), KEYS, fx.HOUR), KEYS, FAMILIES[family]), FAMILIES[family])


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.select("symbol", "segment_id", "end_ms", *[r6(c).alias(c) for c in cols])


for _name in FAMILIES:
    query(fs.family_sql(_name, _EVENTS, fx.HOUR), f"feature_{_name}")(_family(_name))


def _daily_features(names_):
    return lambda spark, sf_dir: _rounded(features.compute(segments.segment(fx.daily(spark, sf_dir, True), KEYS, fx.DAY), KEYS, names_), names_)


for _name in ("ema_distance", "rsi", "obv", "relative_volume", "stochastic"):
    query(fs.family_sql(_name, _BY_PRIORITY, fx.DAY), f"feature_{_name}_daily_reset")(_daily_features(FAMILIES[_name]))


def _chunked(family: str):
    return lambda spark, sf_dir: _rounded(chunked.compute(fx.daily(spark, sf_dir), KEYS, fx.DAY, FAMILIES[family], chunk_rows=512), FAMILIES[family])


for _name in ("ema_distance", "macd", "relative_volume"):
    query(fs.family_sql(_name, _ORDERS, fx.DAY), f"feature_{_name}_daily_chunked")(_chunked(_name))


def _full(spark, sf_dir) -> DataFrame:
    return features.compute(segments.segment(fx.hourly(spark, sf_dir), KEYS, fx.HOUR), KEYS)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of hourly candles, with the end as a timestamp and the symbol: 130 columns."""
    return _full(spark, sf_dir).select(F.timestamp_millis("end_ms").alias("candle_end_utc"), "symbol", *NAMES)


@query(fs.every_family_sql(_EVENTS, fx.HOUR, "make_timestamp(end_ms * 1000) AS candle_end_utc, symbol"))
def features_full_130(spark, sf_dir):
    """The flagship's frame with rounded values."""
    end = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(end_ms AS DECIMAL(18,3)) / 1000)")
    return _full(spark, sf_dir).select(end.alias("candle_end_utc"), "symbol", *[r6(c).alias(c) for c in NAMES])


@query(fs.every_family_sql(_ORDERS, fx.DAY))
def features_full_daily_chunked(spark, sf_dir):
    """All features of a history with gaps, computed in chunks as long series are."""
    return _rounded(runs.calculate(fx.daily(spark, sf_dir), KEYS, fx.DAY, chunk_rows=512), NAMES)


@query(fs.every_family_sql(_BY_PRIORITY, fx.DAY))
def features_full_daily_reset(spark, sf_dir):
    """All features of several series with many gaps."""
    return _rounded(runs.calculate(fx.daily(spark, sf_dir, True), KEYS, fx.DAY), NAMES)


@query(fs.every_family_sql(_ORDERS, 0))
def features_full_daily_rows_chunked(spark, sf_dir):
    """All features over observed rows, whatever the gaps between them, in chunks of rows."""
    return _rounded(runs.calculate(fx.daily(spark, sf_dir), KEYS, fx.DAY, "rows", chunk_rows=512), NAMES)


for _name in ("rsi", "macd"):
    query(fs.family_sql(_name, _BY_PRIORITY, 0), f"feature_{_name}_daily_rows_chunked")(
        lambda spark, sf_dir, _name=_name: _rounded(chunked.compute(fx.daily(spark, sf_dir, True), KEYS, fx.DAY, FAMILIES[_name], 256, "rows"), FAMILIES[_name])
    )

_SCANS = (smoothing.ema("ema_9", "x", 9), smoothing.rma("rma_14", "x", 14), smoothing.ema("volume_ema_5", "y", 5))
_HOLES = {"x": "(end_ms // 86400000) % 41 IN (0, 1)", "y": "(end_ms // 86400000) % 7 = 3"}


def _run_sql(k: str, x: str, period: int, alpha: float) -> str:
    """CTEs that end in {k}_e: (symbol, i, e), a recursion over each run of values of x."""
    return f"""{k}_f AS (SELECT symbol, i, {x} AS v, {x} IS NOT NULL AND lag({x}) OVER (PARTITION BY symbol ORDER BY i) IS NULL AS starts FROM h),
{k}_r AS (SELECT symbol, i, v, sum(CAST(starts AS INT)) OVER (PARTITION BY symbol ORDER BY i) AS run FROM {k}_f),
{k}_p AS (SELECT *, row_number() OVER (PARTITION BY symbol, run ORDER BY i) - 1 AS at_ FROM {k}_r WHERE v IS NOT NULL),
{k}_e AS (SELECT symbol, run, {period - 1} AS at_, avg(v) AS e FROM {k}_p WHERE at_ < {period} GROUP BY symbol, run HAVING count(*) = {period}
  UNION ALL SELECT p.symbol, p.run, p.at_, {alpha!r} * p.v + {1 - alpha!r} * e.e FROM {k}_e e JOIN {k}_p p ON p.symbol = e.symbol AND p.run = e.run AND p.at_ = e.at_ + 1),
{k}_o AS (SELECT p.symbol, p.i, e.e FROM {k}_p p JOIN {k}_e e ON p.symbol = e.symbol AND p.run = e.run AND p.at_ = e.at_)"""


def _runs_sql(base: str) -> str:
    parts = ", ".join(_run_sql(s.out, s.x, s.period, s.alpha) for s in _SCANS)
    out = ", ".join(f"round({s.out}_o.e, 6) + 0.0 AS {s.out}" for s in _SCANS)
    joins = " ".join(f"LEFT JOIN {s.out}_o ON {s.out}_o.symbol = h.symbol AND {s.out}_o.i = h.i" for s in _SCANS)
    return f"""WITH RECURSIVE {base}, h AS (SELECT symbol, end_ms, row_number() OVER (PARTITION BY symbol ORDER BY end_ms) AS i, CASE WHEN NOT {_HOLES["x"]} THEN close END AS x, CASE WHEN NOT {_HOLES["y"]} THEN volume END AS y FROM candles), {parts}
SELECT h.symbol, h.end_ms, {out} FROM h {joins}"""


def _with_holes(candles: DataFrame) -> DataFrame:
    """Values that are missing or not numbers on some days."""
    day = F.floor(F.col("end_ms") / fx.DAY)
    return candles.withColumns({"x": F.when(F.pmod(day, F.lit(41)) > 1, F.col("close")).when(F.pmod(day, F.lit(41)) == 1, F.lit(float("nan"))), "y": F.when(F.pmod(day, F.lit(7)) != 3, F.col("volume"))})


@query(_runs_sql(_BY_PRIORITY))
def smoothing_reseeded(spark, sf_dir):
    """Recursions that start anew, with a seed of their own, after each missing value."""
    df = segments.segment(_with_holes(fx.daily(spark, sf_dir, True)), KEYS, fx.DAY, "rows").withColumn("row", F.row_number().over(Window.partitionBy("symbol").orderBy("end_ms")) - 1)
    return smoothing.smooth_runs(df, _SCANS, KEYS, "row", "end_ms").select("symbol", "end_ms", *[r6(s.out).alias(s.out) for s in _SCANS])


@query(_runs_sql(_ORDERS))
def smoothing_reseeded_chunked(spark, sf_dir):
    """The same in chunks of rows, over which runs go on."""
    return chunked.smoothed(_with_holes(fx.daily(spark, sf_dir)), _SCANS, KEYS, fx.DAY, 256, "rows").select("symbol", "end_ms", *[r6(s.out).alias(s.out) for s in _SCANS])


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)} SELECT symbol, count(*) AS rows, CAST(sum(CAST(gap AS BIGINT)) AS BIGINT) AS gap_count FROM s GROUP BY symbol""")
def gap_counts(spark, sf_dir):
    """Gaps of each series from summaries of blocks of time."""
    return segments.gap_counts(fx.daily(spark, sf_dir, True), KEYS, fx.DAY, block=100)


_REPORTED = (*FAMILIES["log_return"], *FAMILIES["sma_distance"], *FAMILIES["relative_volume"], *FAMILIES["candle_shape"])
_REPORT_COLS = {**fs.columns("log_return"), **fs.columns("sma_distance"), **fs.columns("relative_volume"), **fs.columns("candle_shape")}


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)}, f AS (SELECT symbol, segment_id, end_ms, {", ".join(f"{e} AS {n}" for n, e in _REPORT_COLS.items())} FROM c)
""" + " UNION ALL ".join(f"SELECT symbol, '{n}' AS feature, count(*) - count({n}) AS missing, coalesce(min({n}) = max({n}), false) AS constant FROM f GROUP BY symbol" for n in _REPORTED))
def feature_quality_report(spark, sf_dir):
    return quality.by_feature(features.compute(segments.segment(fx.daily(spark, sf_dir, True), KEYS, fx.DAY), KEYS, _REPORTED), KEYS, _REPORTED)


_READY = " AND ".join(f"{n} IS NOT NULL" for n in _REPORTED)


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)}, f AS (SELECT symbol, segment_id, end_ms, {", ".join(f"{e} AS {n}" for n, e in _REPORT_COLS.items())} FROM c)
SELECT symbol, count(*) AS rows, min(end_ms) AS first_end_ms, max(end_ms) AS last_end_ms, count(DISTINCT segment_id) AS segments, count(*) FILTER ({_READY}) AS complete_all, min(end_ms) FILTER ({_READY}) AS first_complete_end_ms FROM f GROUP BY symbol""")
def feature_run_report(spark, sf_dir):
    out = quality.wide(features.compute(segments.segment(fx.daily(spark, sf_dir, True), KEYS, fx.DAY), KEYS, _REPORTED), KEYS, _REPORTED)
    return out.select("symbol", "rows", "first_end_ms", "last_end_ms", "segments", "complete_all", "first_complete_end_ms")


# Files: written from the test tables and read again ----------------------------------------------------------------------------

_TIME = fx.UTC_TEXT.format
_DAY_NAME = "strftime(make_timestamp(open_ms * 1000), '%Y-%m-%d')"


@query(f"""WITH {fx.WHOLE_DAYS} SELECT 'ABC-1h-' || {_DAY_NAME} || '.zip' AS file, 'um' AS market, symbol, '1h' AS "interval", {_TIME("open_ms")} AS open_time, {_TIME(f"(open_ms + {fx.HOUR - 1})")} AS close_time,
  {_TIME(f"(open_ms + {fx.HOUR})")} AS feature_available_at, open, high, low, close, round(volume, 4) AS volume, round(quote_volume, 4) AS quote_volume, trade_count, round(taker_buy_base_volume, 4) AS taker_buy_base_volume,
  round(taker_buy_quote_volume, 4) AS taker_buy_quote_volume, 0.0::DOUBLE AS kline_ignore FROM days""")
def archive_klines(spark, sf_dir):
    """Daily candle archives, with a header of other names, read, checked and typed."""
    header = ["Open Time", "open", "HIGH", "low", "close", "volume", "close_time", "quote_asset_volume", "number of trades", "taker_buy_base_volume", "Taker Buy Quote Asset Volume", "ignore"]
    paths = fx.zipped(fx.kline_cells(fx.whole_days(spark, sf_dir)), scratch.folder(spark, "klines"), "ABC", "1h", header)
    out = archives.klines(archives.read(spark, paths, archives.KLINE, "aliases"), "um", "ABC", "1h")
    times = {n: cd.utc_text(F.col(c)) for n, c in (("open_time", "open_ms"), ("close_time", "close_ms"), ("feature_available_at", "end_ms"))}
    sums = {c: F.round(c, 4) for c in ("volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume")}
    return out.withColumns({**times, **sums, "file": F.regexp_extract("file", "([^/]+)$", 1)}).select("file", *cd.EXTRACTOR_COLUMNS)


@query(f"""WITH {fx.WHOLE_DAYS}, {_TICK_AGG.format(step=fx.HOUR)}, joined AS (SELECT d.*, b.* EXCLUDE (symbol, open_ms) FROM days d LEFT JOIN buckets b ON d.open_ms = b.open_ms)
SELECT symbol, open_ms, open, close, round(volume, 4) AS volume, coalesce(agg_trade_count, 0) AS agg_trade_count, round(coalesce(agg_base_volume, 0), 4) AS agg_base_volume, round(coalesce(agg_quote_volume, 0), 4) AS agg_quote_volume,
  CASE WHEN agg_trade_count > 0 THEN true END AS ohlc_matches, true AS all_metrics_match FROM joined""")
def archive_candles_and_trades(spark, sf_dir):
    """Daily archives of candles and of trades, read, checked and reconciled: every hour agrees."""
    at = scratch.folder(spark, "combined")
    candles = fx.zipped(fx.kline_cells(fx.whole_days(spark, sf_dir)), f"{at}/1h", "ABC", "1h")
    trades = fx.zipped(fx.trade_cells(fx.ticks(spark, sf_dir)), f"{at}/aggTrades", "ABC", "aggTrades", archives.TRADES)
    out = archives.combined(spark, candles, trades, "um", "ABC")
    some = F.when(F.col("agg_trade_count") > 0, F.col("ohlc_matches"))
    return out.select("symbol", "open_ms", "open", "close", F.round("volume", 4).alias("volume"), "agg_trade_count", *[F.round(c, 4).alias(c) for c in ("agg_base_volume", "agg_quote_volume")], some.alias("ohlc_matches"), "all_metrics_match")


@query(f"""WITH {fx.WHOLE_DAYS} SELECT {_DAY_NAME} AS date, 'ABC' AS coin, '1h' AS "interval", substr({_TIME("open_ms")}, 12) AS open_time, substr({_TIME(f"(open_ms + {fx.HOUR - 1})")}, 12) AS close_time, open, high, low, close, round(volume, 4) AS volume,
  trade_count AS count, {_DAY_NAME}[1:4] AS year, row_number() OVER (PARTITION BY {_DAY_NAME}[1:4] ORDER BY open_ms) AS place,
  'date,coin,interval,{",".join(archives.KLINE)}' AS daily_header, 'date,coin,interval,{",".join(archives.KLINE)}' AS yearly_header FROM days""")
def archive_daily_and_yearly_files(spark, sf_dir):
    """Daily archives to daily CSV files, and these to yearly files, whose lines are in the order of days and times."""
    at = scratch.folder(spark, "legacy")
    fx.zipped(fx.kline_cells(fx.whole_days(spark, sf_dir)), f"{at}/raw", "ABC", "1h")
    legacy.daily_csv(spark, f"{at}/raw", f"{at}/daily")
    legacy.merge_csv(spark, f"{at}/daily", f"{at}/yearly")
    legacy.merge_parquet(spark, f"{at}/daily", f"{at}/parquet")
    texts = spark.read.option("header", "true").csv(f"{at}/yearly")
    place = F.row_number().over(Window.partitionBy("year").orderBy("__at")).cast("long")
    lines = texts.select("date", "coin", "interval", "open_time", F.substring(F.col("_metadata.file_name"), -8, 4).alias("year"), F.monotonically_increasing_id().alias("__at")).withColumn("place", place).drop("__at")
    typed = spark.read.parquet(f"{at}/parquet").withColumn("date", F.col("date").cast("string"))
    year = F.col("file_year")
    whole = {k: legacy.headers(spark, f"{at}/{k}").select(year.alias("year"), F.col("header").alias(f"{k}_header")).distinct() if k == "daily" else spark.read.text(f"{at}/{k}").where(F.startswith("value", F.lit("date,"))).select(F.col("value").alias(f"{k}_header"), F.substring(F.col("_metadata.file_name"), -8, 4).alias("year")) for k in ("daily", "yearly")}
    both = lines.join(typed.drop("coin", "interval"), ["date", "open_time"]).join(whole["daily"], "year").join(whole["yearly"], "year")
    return both.select("date", "coin", "interval", "open_time", "close_time", "open", "high", "low", "close", F.round("volume", 4).alias("volume"), "count", "year", "place", "daily_header", "yearly_header")


def _extractor(candles: DataFrame) -> DataFrame:
    """Candles by symbol in the extractor's columns."""
    named = candles.withColumns({"market": F.lit("um"), "interval": F.lit("1h"), "open_time": F.timestamp_millis("open_ms"), "close_time": F.timestamp_millis(F.col("end_ms") - 1), "feature_available_at": F.timestamp_millis("end_ms"), "kline_ignore": F.lit(0.0)})
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in cd.CANDLE_SCHEMA])


@query(f"""WITH {_BY_TYPE} SELECT substr(sha256('["venue", "um", "' || symbol || '", "1h", "trade"]'), 1, 24) AS series_id, symbol, open_ms, end_ms - 1 AS close_ms, end_ms, open, high, low, close, round(volume, 4) AS volume, trade_count,
  round(taker_buy_base_volume, 4) AS taker_buy_base_volume FROM candles WHERE symbol IN ('click', 'error', 'purchase')""")
def candle_files(spark, sf_dir):
    """Candle files of several symbols, published, then read with a symbol filter, checked and made canonical."""
    at = scratch.folder(spark, "candles")
    made = _extractor(cd.from_ticks(fx.ticks(spark, sf_dir, True), KEYS, fx.HOUR))
    for symbol in ("click", "error", "purchase", "view"):
        publish.candles_parquet(made.where(F.col("symbol") == symbol), f"{at}/um/{symbol}/{symbol}-1h.parquet", report={"symbol": symbol})
    found, _ = tables.checked(tables.read_candles(spark, at, ["click", "error", "purchase"]))
    return found.select(names.series_id(*[F.col(k) for k in cd.SERIES_KEYS]).alias("series_id"), "symbol", "open_ms", "close_ms", "end_ms", "open", "high", "low", "close", F.round("volume", 4).alias("volume"), "trade_count", F.round("taker_buy_base_volume", 4).alias("taker_buy_base_volume"))


@query(f"""WITH {_EVENTS} SELECT {_TIME("open_ms")} AS open_time, open, high, low, close, volume, row_number() OVER (ORDER BY open_ms) AS place FROM candles""")
def candle_csv_file(spark, sf_dir):
    """One CSV file of candles with ISO times, in the order of times."""
    at = scratch.folder(spark, "csv")
    c = fx.hourly(spark, sf_dir)
    publish.text_csv(c.select(cd.utc_text(F.col("open_ms")).alias("open_time"), "open", "high", "low", "close", "volume"), f"{at}/candles.csv", ["open_time"])
    lines = spark.read.schema("open_time string, open double, high double, low double, close double, volume double").option("header", "true").csv(f"{at}/candles.csv").withColumn("__at", F.monotonically_increasing_id())
    return lines.withColumn("place", F.row_number().over(Window.orderBy("__at")).cast("long")).drop("__at")


@query(f"""WITH {_EVENTS} SELECT open_ms AS time_ms, end_ms, open, high, low, close, volume, CAST(trade_count AS DOUBLE) AS trade_count, taker_buy_base_volume FROM candles""")
def generic_candle_file(spark, sf_dir):
    """A CSV of candles under other names, with its times in milliseconds at the candles' starts."""
    at = scratch.folder(spark, "generic")
    c = fx.hourly(spark, sf_dir).select(F.col("open_ms").alias("Open Time"), F.col("open").alias(" Open"), F.col("high").alias("HIGH"), "low", "close", F.col("volume").alias("Base-Asset Volume"), F.col("trade_count").alias("number of trades"), F.col("taker_buy_base_volume").alias("taker buy base-volume"), F.lit("ABC").alias("ticker"))
    publish.text_csv(c, f"{at}/generic.csv", ["Open Time"])
    out = tables.ends(tables.read_generic(spark, f"{at}/generic.csv", unit="ms"), fx.HOUR, "start")
    return out.select("time_ms", "end_ms", "open", "high", "low", "close", "volume", "trade_count", "taker_buy_base_volume")


@query(f"""WITH {_EVENTS} SELECT kind, open_ms AS time_ms, open, close FROM candles, (VALUES ('ns'), ('us'), ('s'), ('offset'), ('utc')) k(kind)
UNION ALL SELECT 'new york', epoch_ms(timezone('America/New_York', make_timestamp(open_ms * 1000))), open, close FROM candles""")
def generic_times(spark, sf_dir):
    """Candle files whose times are nanoseconds, microseconds, seconds, texts with an offset, and local texts of two zones."""
    at, c = scratch.folder(spark, "times"), fx.hourly(spark, sf_dir)
    local = F.date_format(F.to_timestamp_ntz(F.substring(cd.utc_text(F.col("open_ms")), 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")), "yyyy-MM-dd HH:mm:ss")
    stamps = {
        "ns": (F.col("open_ms") * 1_000_000, "ns", None), "us": (F.col("open_ms") * 1000, "us", None), "s": ((F.col("open_ms") / 1000).cast("long"), "s", None),
        "offset": (F.concat(local, F.lit("+00:00")), None, None), "utc": (local, None, "UTC"), "new york": (local, None, "America/New_York"),
    }
    out = None
    for kind, (stamp, unit, zone) in stamps.items():
        path = f"{at}/{kind.replace(' ', '-')}.csv"
        publish.text_csv(c.select(stamp.alias("Time"), "open", "high", "low", "close", "volume"), path, ["Time"])
        mine = tables.read_generic(spark, path, unit=unit, zone=zone).select(F.lit(kind).alias("kind"), "time_ms", "open", "close")
        out = mine if out is None else out.union(mine)
    return out


@query(f"""WITH {fx.EVENT_TICKS.format(symbol="'ALL'")}, l AS (SELECT DISTINCT time_ms // 900000 * 900000 AS local_ms FROM ticks UNION SELECT unnest(generate_series(1710028800000, 1710060000000, 900000)) UNION SELECT unnest(generate_series(1730592000000, 1730620800000, 900000))),
t AS (SELECT local_ms, [u FOR u IN [local_ms + 14400000, local_ms + 18000000] IF epoch_ms(timezone('America/New_York', make_timestamp(u * 1000) AT TIME ZONE 'UTC')) = local_ms] AS u FROM l)
SELECT local_ms, len(u)::INTEGER AS instants, u[1] AS first_ms FROM t""")
def local_time_instants(spark, sf_dir):
    """How many instants a zone's clocks show as each local quarter of an hour, over a spring and an autumn change too."""
    quarters = fx.ticks(spark, sf_dir).select(cd.bucket(F.col("time_ms"), 900_000).alias("local_ms"))
    for first, last in ((1710028800000, 1710060000000), (1730592000000, 1730620800000)):
        quarters = quarters.union(spark.range(first, last + 1, 900_000).select(F.col("id").alias("local_ms")))
    found = times.instants(F.col("local_ms"), "America/New_York")
    return quarters.distinct().select("local_ms", F.size(found).alias("instants"), F.array_min(found).alias("first_ms"))


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)}, f AS (SELECT symbol, end_ms, {fs.columns("log_return")["log_return_1"]} AS r FROM c),
n AS (SELECT DISTINCT symbol, CASE WHEN regexp_matches(symbol, '^[A-Za-z0-9][A-Za-z0-9_-]{{0,63}}$') THEN symbol ELSE 'symbol-' || sha256(symbol) END || '-features.parquet' AS file FROM f)
SELECT f.symbol, n.file, row_number() OVER (PARTITION BY f.symbol ORDER BY end_ms) AS place, end_ms, round(r, 6) + 0.0 AS log_return_1 FROM f JOIN n ON f.symbol = n.symbol""")
def feature_files(spark, sf_dir):
    """Features published as a file a symbol, under safe names and in the order of times, and read again."""
    at = scratch.folder(spark, "features")
    made = features.compute(segments.segment(fx.daily(spark, sf_dir, True), KEYS, fx.DAY), KEYS, ["log_return_1"])
    publish.features(made.select(F.timestamp_millis("end_ms").alias("candle_end_utc"), "symbol", "log_return_1"), at, {})
    back = spark.read.option("pathGlobFilter", "*.parquet").parquet(at).select("symbol", F.col("_metadata.file_name").alias("file"), F.unix_millis("candle_end_utc").alias("end_ms"), r6("log_return_1").alias("log_return_1"), F.monotonically_increasing_id().alias("__at"))
    return back.withColumn("place", F.row_number().over(Window.partitionBy("symbol").orderBy("__at")).cast("long")).drop("__at")


@query(f"""WITH {fx.WHOLE_DAYS}, d AS (SELECT DISTINCT make_timestamp(open_ms * 1000)::DATE AS day FROM days), p AS (SELECT day, day - (SELECT min(day) FROM d) AS n FROM d UNION ALL SELECT max(day) + 1, max(day) + 1 - min(day) FROM d)
SELECT 'ABC' AS symbol, 'klines' AS dataset, strftime(day, '%Y-%m-%d') AS day, 'um/ABC/1h/ABC-1h-' || strftime(day, '%Y-%m-%d') || '.zip' AS path, CASE WHEN day > (SELECT max(day) FROM d) THEN 'missing' WHEN n % 3 = 1 THEN 'mismatch' WHEN n % 3 = 2 THEN 'no checksum' ELSE 'ok' END AS status FROM p""")
def archive_manifest(spark, sf_dir):
    """A range's plan against the archives at hand: some without checksum, some with another's, one day missing."""
    at = scratch.folder(spark, "manifest")
    paths = fx.zipped(fx.kline_cells(fx.whole_days(spark, sf_dir)), f"{at}/um/ABC/1h", "ABC", "1h")
    store = publish.Store(spark, at)
    sums = {r["file"]: r["sha256"] for r in archives.sources(spark, paths).collect()}
    for i, p in enumerate(paths):
        name = p.rsplit("/", 1)[-1]
        if i % 3 != 2:
            store.write_text(f"{p}.CHECKSUM", f"{sums[name] if i % 3 == 0 else '0' * 64}  {name}\n")
    first, last = (date.fromisoformat(p[-14:-4]) for p in (paths[0], paths[-1]))
    planned = manifest.plan(spark, "um", ["ABC"], "1h", first, last + timedelta(days=1))
    return manifest.verify(planned, at).select("symbol", "dataset", F.col("day").cast("string").alias("day"), "path", "status")


@query(f"""WITH {fx.WHOLE_DAYS}, d AS (SELECT DISTINCT make_timestamp(open_ms * 1000)::DATE AS day FROM days)
SELECT 'ABC-1h-' || strftime(day, '%Y-%m-%d') || '.zip' AS file, CASE day(day) % 7 WHEN 1 THEN '2 members' WHEN 2 THEN 'a folder' WHEN 3 THEN 'a symbolic link' WHEN 4 THEN 'another name' WHEN 5 THEN 'empty' WHEN 6 THEN 'no archive' END AS fault FROM d""")
def archive_faults(spark, sf_dir):
    """Daily archives of which most are faulty, found by the tasks that read them, before anything is unpacked."""
    paths = fx.zipped(fx.kline_cells(fx.whole_days(spark, sf_dir)), scratch.folder(spark, "faulty"), "ABC", "1h", faulty=True)
    return archives.faults(spark, paths)


def _odd(k: int) -> str:
    return f"event_id % 13 = {k}"


_TICK_RULES = {
    "ids strictly increasing": "before_id IS NULL OR tick_id > before_id",
    "times not falling": "before_ms IS NULL OR time_ms >= before_ms",
    "first trade id at most the last": "first_trade_id <= last_trade_id",
    "price finite and positive": "price > 0",
    "quantity finite and not negative": "quantity >= 0",
    "price times quantity finite": "true",
    "maker flag known": "buyer_is_maker IS NOT NULL",
    "time inside its day": f"time_ms BETWEEN day_ms AND day_ms + {fx.DAY - 1}",
}


@query(f"""WITH t AS (SELECT event_type AS symbol, CASE WHEN {_odd(1)} THEN 0 ELSE event_id END AS tick_id, event_id AS line, epoch_us(ts) // 1000 - CASE WHEN {_odd(2)} THEN {10 * fx.DAY} ELSE 0 END AS time_ms, epoch_us(ts) // 1000 // {fx.DAY} * {fx.DAY} AS day_ms,
  CASE WHEN {_odd(3)} THEN event_id + 1 ELSE event_id END AS first_trade_id, event_id AS last_trade_id, CASE WHEN {_odd(4)} THEN -value ELSE value END AS price, CASE WHEN {_odd(5)} THEN -1.0 ELSE 1.0 END AS quantity, CASE WHEN {_odd(6)} THEN NULL ELSE true END AS buyer_is_maker FROM events WHERE value > 0),
o AS (SELECT *, lag(tick_id) OVER w AS before_id, lag(time_ms) OVER w AS before_ms FROM t WINDOW w AS (PARTITION BY symbol ORDER BY line))
""" + " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) FILTER (NOT coalesce({ok}, false)) AS violations FROM o" for name, ok in _TICK_RULES.items()))
def tick_rule_violations(spark, sf_dir):
    """Trades of which some break each rule, in the source's order."""
    at = lambda k: F.expr(_odd(k))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("value > 0")
    ms = cd.epoch_ms(F.col("ts"))
    rows = events.select(
        F.col("event_type").alias("symbol"), F.when(at(1), 0).otherwise(F.col("event_id")).alias("tick_id"), F.col("event_id").alias("line"), (ms - F.when(at(2), 10 * fx.DAY).otherwise(0)).alias("time_ms"), cd.bucket(ms, fx.DAY).alias("day_ms"),
        F.when(at(3), F.col("event_id") + 1).otherwise(F.col("event_id")).alias("first_trade_id"), F.col("event_id").alias("last_trade_id"), F.when(at(4), -F.col("value")).otherwise(F.col("value")).alias("price"), F.when(at(5), -1.0).otherwise(1.0).alias("quantity"), F.when(~at(6), True).alias("buyer_is_maker"),
    )
    return validate.tick_violations(rows, KEYS, ["line"], block=256)


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)} SELECT symbol, segment_id, min(end_ms) AS first, max(end_ms) AS last, count(*) AS rows FROM s GROUP BY symbol, segment_id""")
def segment_runs(spark, sf_dir):
    """Gap-free runs, found in blocks of time and joined."""
    return segments.runs(fx.daily(spark, sf_dir, True), KEYS, fx.DAY, block=60)


@query(f"""WITH {_BY_PRIORITY}, {fx.segmented_sql(fx.DAY)}, p AS (SELECT symbol, segment_id, count(*) AS n FROM s GROUP BY ALL)
SELECT symbol, CAST(sum(n) AS BIGINT) AS rows, count(*) - 1 AS gap_count, count(*) AS segments, max(n) AS longest_segment FROM p GROUP BY symbol""")
def segment_summary_by_runs(spark, sf_dir):
    return segments.summary_by_runs(fx.daily(spark, sf_dir, True), KEYS, fx.DAY, block=60)


@query(f"""WITH {fx.WHOLE_DAYS}, d AS (SELECT DISTINCT open_ms // {fx.DAY} AS day FROM days), t AS (SELECT DISTINCT time_ms // {fx.DAY} AS day FROM ticks WHERE time_ms // {fx.DAY} % 4 <> 1),
p AS (SELECT day, day % 3 <> 1 AS k, day IN (SELECT day FROM t) AS a FROM d)
SELECT 'ABC' AS symbol, strftime(make_timestamp(day * {fx.DAY} * 1000), '%Y-%m-%d') AS day, k AS klines, a AS "aggTrades", k AND a AS paired FROM p""")
def archive_pairing(spark, sf_dir):
    """Days with archives of candles, of trades, of both or of neither."""
    at = scratch.folder(spark, "pairing")
    day = lambda c: F.floor(F.col(c) / fx.DAY)
    whole = fx.whole_days(spark, sf_dir)
    fx.zipped(fx.kline_cells(whole.where(F.pmod(day("open_ms"), F.lit(3)) != 1)), f"{at}/um/ABC/1h", "ABC", "1h")
    fx.zipped(fx.trade_cells(fx.ticks(spark, sf_dir).where(F.pmod(day("time_ms"), F.lit(4)) != 1)), f"{at}/um/ABC/aggTrades", "ABC", "aggTrades", archives.TRADES)
    publish.Store(spark, at).write_text(f"{at}/none.CHECKSUM", "\n")
    lo, hi = whole.agg(F.min(day("open_ms")), F.max(day("open_ms"))).first()
    planned = manifest.plan(spark, "um", ["ABC"], "1h", date(1970, 1, 1) + timedelta(days=lo), date(1970, 1, 1) + timedelta(days=hi), ["klines", "aggTrades"])
    return manifest.pairing(manifest.verify(planned, at)).withColumn("day", F.col("day").cast("string"))


@query("""WITH t AS (SELECT n_nationkey, CASE n_nationkey % 5 WHEN 1 THEN NULL WHEN 2 THEN '  ' ELSE n_name END AS symbol, CASE n_nationkey % 3 WHEN 1 THEN 'other' ELSE 'um' END AS product FROM nation)
SELECT 'symbol not empty' AS rule, count(*) FILTER (symbol IS NULL OR trim(symbol) = '') AS violations FROM t UNION ALL SELECT 'product not empty', 0 UNION ALL SELECT 'known market', count(*) FILTER (product <> 'um') FROM t""")
def key_rule_violations(spark, sf_dir):
    """Series keys of which some are empty or unknown."""
    k = F.col("n_nationkey")
    rows = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.when(k % 5 == 2, "  ").when(k % 5 != 1, F.col("n_name")).alias("symbol"), F.when(k % 3 == 1, "other").otherwise("um").alias("product"))
    return validate.violations(rows, validate.key_rules(["symbol", "product"]))


@query(f"""WITH {_EVENTS} SELECT open_ms + {fx.HOUR} - 1 AS time_ms, end_ms, close FROM candles""")
def generic_end_times(spark, sf_dir):
    """A candle file whose times are a millisecond before the candles' ends, and whose candles are a step apart at least."""
    at = f"{scratch.folder(spark, 'ends')}/a.tsv.csv"
    publish.text_csv(fx.hourly(spark, sf_dir).select((F.col("end_ms") - 1).alias("close time"), "open", "high", "low", "close", "volume"), at, ["close time"])
    back = spark.read.option("header", "true").csv(at)
    tab = at.replace(".tsv.csv", ".tsv")
    back.coalesce(1).write.option("header", "true").option("sep", "\t").csv(tab)
    return tables.spaced(tables.ends(tables.read_generic(spark, tab, unit="ms"), fx.HOUR, "end", 1), fx.HOUR).select("time_ms", "end_ms", "close")


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 0 AND o_totalprice / 100 < 700 THEN round(ln(exp(o_totalprice / 100)), 6) END AS scrubbed FROM orders WHERE NOT o_totalprice / 100 BETWEEN 700 AND 720")
def infinite_values_scrubbed(spark, sf_dir):
    """Values that overflow, and those that are no number, as nulls."""
    x = F.col("o_totalprice") / 100
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").where(~x.between(700, 720))
    return orders.select("o_orderkey", F.round(F.log(finite(F.when(F.col("o_totalprice") > 0, F.exp(x)).otherwise(F.lit(float("nan"))))), 6).alias("scrubbed"))


# Streams and whole runs ------------------------------------------------------------------------------------------------------------


def _fed(spark, sf_dir, at: str) -> tuple[DataFrame, str]:
    """Ticks by type as a stream's files, written one after the other in the order of times; (their batch form, folder)."""
    ms = F.col("time_ms")
    rows = fx.ticks(spark, sf_dir, True).withColumns({"tick_id": ms * 1_000_000 + F.col("tick_id"), "ts": F.timestamp_millis(ms), "part": F.lit(0), "offset": ms * 1_000_000 + F.col("tick_id")}).drop("time_ms")
    lo, hi = rows.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()
    for i in range(3):
        a, b = lo + (hi - lo) * i // 3, lo + (hi - lo) * (i + 1) // 3 + (i == 2)
        rows.where((F.unix_millis("ts") >= a) & (F.unix_millis("ts") < b)).coalesce(1).write.mode("append").parquet(f"{at}/in")
    return spark.read.parquet(f"{at}/in"), f"{at}/in"


def _streamed(spark, at: str, schema, made, state: str | None = None) -> DataFrame:
    """What a streaming query over the files makes, once it has taken them all, a file at a time."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    if state:
        spark.conf.set(setting, state)
    try:
        live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        made(live).trigger(availableNow=True).option("checkpointLocation", f"{at}/checkpoint").start().awaitTermination()
    finally:
        if state and before is not None:
            spark.conf.set(setting, before)
        elif state:
            spark.conf.unset(setting)
    return spark.read.parquet(f"{at}/out")


_STREAM_OUT = "symbol, open_ms, end_ms, open, high, low, close, volume, trade_count, taker_buy_base_volume"


def _stream_rows(df: DataFrame) -> DataFrame:
    return df.select("symbol", F.unix_millis("open_time").alias("open_ms"), F.unix_millis("candle_end_utc").alias("end_ms"), "open", "high", "low", "close", "volume", "trade_count", "taker_buy_base_volume")


_STREAM_TICKS = fx.EVENT_TICKS.format(symbol="event_type").replace("event_id AS tick_id", "epoch_us(ts) // 1000 * 1000000 + event_id AS tick_id")
_STREAM_CANDLES = fx.candles_sql(_STREAM_TICKS.replace("{", "{{").replace("}", "}}"), "", fx.HOUR)


@query(f"WITH {_STREAM_CANDLES} SELECT {_STREAM_OUT} FROM candles WHERE end_ms <= (SELECT max(time_ms) - 600000 FROM ticks)")
def stream_candles(spark, sf_dir):
    """Hourly candles of a stream of ticks, all that have closed."""
    at = scratch.folder(spark, "stream")
    rows, _ = _fed(spark, sf_dir, at)
    return _stream_rows(_streamed(spark, at, rows.schema, lambda live: stream.build(live, KEYS).writeStream.format("parquet").option("path", f"{at}/out").outputMode("append")))


@query(f"""WITH {_STREAM_CANDLES}, closed AS (SELECT (max(time_ms) - 600000) // {fx.HOUR} * {fx.HOUR} AS until FROM ticks), firsts AS (SELECT symbol, min(open_ms) AS first_ FROM candles GROUP BY symbol),
steps AS (SELECT symbol, unnest(generate_series(first_, until - {fx.HOUR}, {fx.HOUR})) AS open_ms FROM firsts, closed)
SELECT s.symbol, s.open_ms, s.open_ms + {fx.HOUR} AS end_ms, open, high, low, close, coalesce(volume, 0) AS volume, coalesce(trade_count, 0) AS trade_count, coalesce(taker_buy_base_volume, 0) AS taker_buy_base_volume
FROM steps s LEFT JOIN candles c ON s.symbol = c.symbol AND s.open_ms = c.open_ms""")
def stream_steps(spark, sf_dir):
    """The same with the hours that had no tick, which state and timers add."""
    at = scratch.folder(spark, "steps")
    rows, _ = _fed(spark, sf_dir, at)
    return _stream_rows(_streamed(spark, at, rows.schema, lambda live: stream.steps(live, KEYS, fx.HOUR).writeStream.format("parquet").option("path", f"{at}/out").outputMode("append"), stream.ROCKS))


@query(f"WITH {_STREAM_TICKS} SELECT symbol, count(*) AS ticks, min(tick_id) AS first_id, max(tick_id) AS last_id, max(time_ms) AS last_ms FROM ticks GROUP BY symbol")
def stream_guarded(spark, sf_dir):
    """Ticks landed by a stream whose order is checked inside and over its batches."""
    at = scratch.folder(spark, "guarded")
    rows, _ = _fed(spark, sf_dir, at)
    guard = stream.guard(KEYS, ["part", "offset"], f"{at}/past", lambda batch, n: batch.write.mode("append").parquet(f"{at}/out"), 600_000)
    landed = _streamed(spark, at, rows.schema, lambda live: live.writeStream.foreachBatch(guard))
    return landed.groupBy("symbol").agg(F.count("*").alias("ticks"), F.min("tick_id").alias("first_id"), F.max("tick_id").alias("last_id"), F.max(F.unix_millis("ts")).alias("last_ms"))


def _extracted(spark, sf_dir, kinds: tuple[str, ...]) -> tuple[str, str]:
    """Runs the extractor over archives made of the tables; (CSV file, report)."""
    at = scratch.folder(spark, "extract")
    days = [date.fromisoformat(p[-14:-4]) for p in fx.zipped(fx.kline_cells(fx.whole_days(spark, sf_dir)), f"{at}/raw/um/ABC/1h", "ABC", "1h")]
    if "aggTrades" in kinds:
        fx.zipped(fx.trade_cells(fx.ticks(spark, sf_dir)), f"{at}/raw/um/ABC/aggTrades", "ABC", "aggTrades", archives.TRADES)
    config = ExtractConfig(("ABC",), "1h", days[0], days[-1], "csv", datasets=kinds, raw_folder=f"{at}/raw", preprocessed_folder=f"{at}/out")
    (report,) = runs.run_extractor(spark, config, process_only=True)
    return report["output"], report["output"].rsplit(".", 1)[0] + ".validation.json"


@query(f"""WITH {fx.WHOLE_DAYS}, {_TICK_AGG.format(step=fx.HOUR)}, joined AS (SELECT d.*, b.* EXCLUDE (symbol, open_ms) FROM days d LEFT JOIN buckets b ON d.open_ms = b.open_ms)
SELECT {_TIME("open_ms")} AS open_time, {_TIME(f"(open_ms + {fx.HOUR - 1})")} AS close_time, open, high, low, close, round(volume, 4) AS volume, coalesce(agg_trade_count, 0) AS agg_trade_count, round(coalesce(agg_base_volume, 0), 4) AS agg_base_volume, true AS all_metrics_match FROM joined""")
def combined_csv_file(spark, sf_dir):
    """A whole run over archives of candles and trades: its CSV, read again."""
    at, _ = _extracted(spark, sf_dir, ("klines", "aggTrades"))
    back = spark.read.option("header", "true").csv(at)
    cells = {"open": "double", "high": "double", "low": "double", "close": "double", "agg_trade_count": "long", "all_metrics_match": "boolean"}
    return back.select("open_time", "close_time", *[F.col(c).cast(t).alias(c) for c, t in cells.items()], *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("volume", "agg_base_volume")])


@query(f"""WITH {fx.WHOLE_DAYS} SELECT 'um' AS market, 'ABC' AS symbol, '1h' AS "interval", 'passed' AS status, count(*) AS rows, count(*) AS expected_rows, min(open_ms) AS first_open_ms, max(open_ms) AS last_open_ms,
count(DISTINCT open_ms // {fx.DAY}) AS sources, 24 AS least_rows, 24 AS most_rows FROM days""")
def candle_range_report(spark, sf_dir):
    """The report that a run publishes beside its file, as JSON, read again."""
    _, at = _extracted(spark, sf_dir, ("klines",))
    rows = F.transform("sources", lambda x: x["rows"])
    return spark.read.option("multiLine", "true").json(at).select("market", "symbol", "interval", "status", "rows", "expected_rows", "first_open_ms", "last_open_ms", F.size("sources").cast("long").alias("sources"), F.array_min(rows).cast("int").alias("least_rows"), F.array_max(rows).cast("int").alias("most_rows"))


@query(f"""WITH {fx.WHOLE_DAYS}, d AS (SELECT DISTINCT make_timestamp(open_ms * 1000)::DATE AS day FROM days), p AS (SELECT (day - (SELECT min(day) FROM d)) % 3 AS n FROM d)
SELECT CASE n WHEN 1 THEN 'mismatch' WHEN 2 THEN 'no checksum' ELSE 'ok' END AS status, count(*) AS files FROM p GROUP BY n UNION ALL SELECT 'missing', 1""")
def manifest_totals(spark, sf_dir):
    """Files of a range by status."""
    return manifest.totals(archive_manifest(spark, sf_dir).withColumn("bytes", F.lit(0).cast("long"))).select("status", "files")


@query(f"""WITH {fx.candles_sql(fx.EVENT_TICKS, "event_type", 900_000)}, l AS (SELECT symbol, end_ms - lag(end_ms) OVER (PARTITION BY symbol ORDER BY end_ms) AS d FROM candles)
SELECT symbol, count(*) AS rows, count(*) FILTER (d < {fx.HOUR}) AS closer FROM l GROUP BY symbol""")
def close_candles(spark, sf_dir):
    """Candles closer to the one before than a step, found from blocks of time."""
    c = cd.from_ticks(fx.ticks(spark, sf_dir, True), KEYS, 900_000)
    return order.summaries(c, KEYS, ["end_ms"], [order.apart("closer", "end_ms", fx.HOUR)], block=50 * fx.HOUR).select("symbol", "rows", "closer")


@query(f"""WITH {_EVENTS} SELECT mode, count(*) AS rows, round(sum(close), 4) AS total, CASE mode WHEN 'error' THEN 1 ELSE 0 END AS refused FROM (SELECT CASE WHEN mode = 'overwrite' THEN close + 1 ELSE close END AS close, mode FROM candles, (VALUES ('ignore'), ('overwrite'), ('error')) m(mode)) GROUP BY mode""")
def publish_modes(spark, sf_dir):
    """A file published twice under each mode: kept, replaced, or refused."""
    at, out = scratch.folder(spark, "modes"), None
    c = fx.hourly(spark, sf_dir).select(F.timestamp_millis("open_ms").alias("open_time"), "close")
    for mode in ("ignore", "overwrite", "error"):
        path, refused = f"{at}/{mode}/a.parquet", 0
        publish.parquet(c, path, ["open_time"])
        try:
            publish.parquet(c.withColumn("close", F.col("close") + 1), path, ["open_time"], mode)
        except FileExistsError:
            refused = 1
        mine = spark.read.parquet(path).agg(F.count("*").alias("rows"), F.round(F.sum("close"), 4).alias("total")).select(F.lit(mode).alias("mode"), "rows", "total", F.lit(refused).alias("refused"))
        out = mine if out is None else out.union(mine)
    return out


@query(f"""WITH {_EVENTS}, {fx.segmented_sql(fx.HOUR)} SELECT end_ms, {", ".join(f"round({fs.columns('log_return')[n]}, 6) + 0.0 AS {n}" for n in FAMILIES["log_return"])}, {", ".join(f"round({fs.columns('sma_distance')[n]}, 6) + 0.0 AS {n}" for n in FAMILIES["sma_distance"])} FROM c""")
def generic_file_features(spark, sf_dir):
    """A candle file of other names, with local times of its candles' ends, to features."""
    at = f"{scratch.folder(spark, 'calculated')}/a.csv"
    c = fx.hourly(spark, sf_dir)
    publish.text_csv(c.select(F.regexp_replace(cd.utc_text(F.col("end_ms")), "[TZ]", " ").alias("Date"), "open", "high", "low", "close", F.col("volume").alias("Base Volume")), at, ["Date"])
    out, _ = runs.calculate_file(spark, at, "1h", "end", zone="UTC")
    return out.select("end_ms", *[r6(n).alias(n) for n in (*FAMILIES["log_return"], *FAMILIES["sma_distance"])])


# Names and text --------------------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT DISTINCT n_name AS symbol FROM nation UNION SELECT DISTINCT lower(n_name) FROM nation WHERE n_nationkey % 3 = 0 UNION SELECT DISTINCT p_name FROM part),
t AS (SELECT symbol, CASE WHEN regexp_matches(symbol, '^[A-Za-z0-9][A-Za-z0-9_-]{0,63}$') THEN symbol ELSE 'symbol-' || sha256(symbol) END AS stem FROM s)
SELECT symbol, stem || CASE WHEN count(*) OVER (PARTITION BY lower(stem)) > 1 THEN '-' || sha256(symbol) ELSE '' END || '-features.parquet' AS file FROM t""")
def symbol_filenames(spark, sf_dir):
    nation, part = spark.read.parquet(f"{sf_dir}/nation.parquet"), spark.read.parquet(f"{sf_dir}/part.parquet")
    return names.file_names(nation.select(F.col("n_name").alias("symbol")).union(nation.where("n_nationkey % 3 = 0").select(F.lower("n_name"))).union(part.select("p_name")))


@query("""SELECT n_nationkey, substr(sha256('["venue", "um", "' || n_name || '", "1h", "trade"]'), 1, 24) AS series_id FROM nation""")
def series_ids(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nation.select("n_nationkey", names.series_id(F.lit("venue"), F.lit("um"), F.col("n_name"), F.lit("1h"), F.lit("trade")).alias("series_id"))


@query("""WITH t AS (SELECT n_nationkey, n_name || chr(9) || '"' || chr(92) || chr(233) || chr(128512) || chr(127) AS name FROM nation)
SELECT n_nationkey, substr(sha256('["um", "' || n_name || '\\t\\"\\\\\\u00e9\\ud83d\\ude00\\u007f"]'), 1, 24) AS series_id FROM t JOIN nation USING (n_nationkey)""")
def series_ids_of_any_text(spark, sf_dir):
    """Symbols with quotes, control characters and characters beyond ASCII and beyond 16 bits."""
    odd = F.concat("n_name", F.lit('\t"\\\u00e9\U0001f600\x7f'))
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", names.series_id(F.lit("um"), odd).alias("series_id"))


@query(r"SELECT p_partkey, lower(regexp_replace(trim('  ' || p_name || '- ' || p_type || ' '), '[\s-]+', '_', 'g')) AS name FROM part")
def name_normalise(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", names.normal(F.concat(F.lit("  "), "p_name", F.lit("- "), "p_type", F.lit(" "))).alias("name"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || 'Z' AS text FROM events""")
def json_text_timestamps(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), cd.utc_text(cd.epoch_ms(F.col("ts"))).alias("text"))
