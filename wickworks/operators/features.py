"""The 128 causal features of a candle series, as one DataFrame plan.

Input: series keys, segment_id, end_ms (exclusive candle end, epoch milliseconds), open, high, low, close, volume, and optionally
trade_count and taker_buy_base_volume. All windows share one partition and order, so the plan has one exchange and one sort for them.
Undefined values are null; windows are full or null.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.functions import catalogue as cat
from wickworks.functions import smoothing
from wickworks.functions.windows import Frames, correlation, div0, finite, mean_deviation, std, trend_product, variance

ROW = "__row"


class Plan:
    """Columns by stage: a stage's window functions may use what earlier stages made."""

    def __init__(self, partition: Sequence[str], names: Iterable[str]):
        self.frames = Frames(partition, "end_ms", ROW)
        self.keys = list(partition)
        self.wanted = set(names)
        self.stages: list[dict[str, Column]] = [{}, {}, {}, {}, {}, {}]
        self.scans: list[smoothing.Scan] = []
        self.signals: list[smoothing.Scan] = []

    def wants(self, *names: str) -> bool:
        return any(n in self.wanted for n in names)

    def put(self, stage: int, name: str, value: Column) -> None:
        self.stages[stage][name] = value


def _price_and_shape(p: Plan) -> None:
    f, close = p.frames, F.col("close")
    for h in cat.RETURNS:
        p.put(2, f"log_return_{h}", F.log(close / f.lag(close, h)))
    before, top, bottom = F.col("__pc"), F.greatest("open", "close"), F.least("open", "close")
    p.put(2, "candle_body", (close - F.col("open")) / before)
    p.put(2, "candle_range", (F.col("high") - F.col("low")) / before)
    p.put(2, "upper_wick", (F.col("high") - top) / before)
    p.put(2, "lower_wick", (bottom - F.col("low")) / before)


def _trend(p: Plan) -> None:
    f, close = p.frames, F.col("close")
    for n in cat.EMA:
        if p.wants(f"ema_distance_{n}"):
            p.scans.append(smoothing.ema(f"__ema_{n}", "close", n))
            p.put(5, f"ema_distance_{n}", close / F.col(f"__ema_{n}") - 1)
    for n in cat.SMA:
        p.put(2, f"sma_distance_{n}", f.from_row(n - 1, close / F.avg(close).over(f.last(n)) - 1))
    for n in cat.SLOPE:
        if p.wants(f"log_slope_{n}", f"log_r2_{n}"):
            values, xx = f"__ln_{n}", n * (n * n - 1) / 12
            p.put(2, values, F.collect_list("__ln").over(f.last(n)))
            p.put(3, f"__xy_{n}", F.when(F.array_max(values) == F.array_min(values), 0.0).otherwise(trend_product(F.col(values), n)))
            p.put(3, f"__yy_{n}", variance(F.col(values)) * n)
            p.put(4, f"log_slope_{n}", f.from_row(n - 1, F.col(f"__xy_{n}") / xx))
            r2 = F.when(F.col(f"__xy_{n}") == 0, 0.0).otherwise(div0(F.pow(f"__xy_{n}", F.lit(2)), xx * F.col(f"__yy_{n}")))
            p.put(4, f"log_r2_{n}", f.from_row(n - 1, F.least(F.greatest(r2, F.lit(0.0)), F.lit(1.0))))


def _momentum(p: Plan) -> None:
    f, close = p.frames, F.col("close")
    for n in cat.RSI:
        if p.wants(f"rsi_{n}"):
            p.scans += [smoothing.rma(f"__gain_{n}", "__gain", n, 1), smoothing.rma(f"__loss_{n}", "__loss", n, 1)]
            total = F.col(f"__gain_{n}") + F.col(f"__loss_{n}")
            p.put(5, f"rsi_{n}", F.when(total == 0, 50.0).otherwise(100 * F.col(f"__gain_{n}") / total))
    for n in cat.STOCH:
        low, span = F.min("low").over(f.last(n)), F.max("high").over(f.last(n)) - F.min("low").over(f.last(n))
        k = F.when(span == 0, 50.0).otherwise(100 * (close - low) / F.nullif(span, F.lit(0.0)))
        p.put(2, f"stoch_k_{n}", f.from_row(n - 1, k))
        p.put(3, f"stoch_d_{n}", f.from_row(n + 1, F.avg(f"stoch_k_{n}").over(f.last(3))))
    for n in cat.CCI:
        if p.wants(f"cci_{n}"):
            p.put(2, f"__tp_{n}", F.collect_list("__tp").over(f.last(n)))
            p.put(2, f"__tpm_{n}", F.avg("__tp").over(f.last(n)))
            deviation = mean_deviation(F.col(f"__tp_{n}"), F.col(f"__tpm_{n}"), n)
            flat = F.array_max(f"__tp_{n}") == F.array_min(f"__tp_{n}")
            p.put(3, f"__mad_{n}", F.when(flat, 0.0).otherwise(deviation))
            p.put(4, f"cci_{n}", f.from_row(n - 1, F.coalesce(div0(F.col("__tp") - F.col(f"__tpm_{n}"), 0.015 * F.col(f"__mad_{n}")), F.lit(0.0))))
    for fast, slow, signal in cat.MACD:
        name = f"{fast}_{slow}_{signal}"
        if p.wants(f"macd_line_{name}", f"macd_hist_{name}"):
            p.scans += [smoothing.ema(f"__fast_{fast}", "close", fast), smoothing.ema(f"__slow_{slow}", "close", slow)]
            p.put(1, f"__macd_{name}", F.col(f"__fast_{fast}") - F.col(f"__slow_{slow}"))
            p.signals.append(smoothing.ema(f"__signal_{name}", f"__macd_{name}", signal, slow - 1))
            p.put(5, f"macd_line_{name}", F.col(f"__macd_{name}") / close)
            p.put(5, f"macd_hist_{name}", (F.col(f"__macd_{name}") - F.col(f"__signal_{name}")) / close)


def _volatility(p: Plan) -> None:
    f, close = p.frames, F.col("close")
    for n in cat.RETURN_VOL:
        p.put(2, f"return_vol_{n}", f.from_row(n, F.stddev_pop("__r").over(f.last(n))))
    for n in cat.ATR:
        if p.wants(f"atr_normalized_{n}"):
            p.scans.append(smoothing.rma(f"__atr_{n}", "__tr", n, 1))
            p.put(5, f"atr_normalized_{n}", F.col(f"__atr_{n}") / close)
    for n in cat.BOLLINGER:
        if p.wants(f"bb_position_{n}", f"bb_width_{n}"):
            p.put(2, f"__c_{n}", F.collect_list("close").over(f.last(n)))
            p.put(2, f"__cm_{n}", F.avg("close").over(f.last(n)))
            p.put(3, f"__cs_{n}", std(F.col(f"__c_{n}")))
            mean, spread = F.col(f"__cm_{n}"), F.col(f"__cs_{n}")
            p.put(4, f"bb_position_{n}", f.from_row(n - 1, F.coalesce(div0(close - (mean - 2 * spread), 4 * spread), F.lit(0.5))))
            p.put(4, f"bb_width_{n}", f.from_row(n - 1, 4 * spread / mean))
    for n in cat.DOWNSIDE:
        p.put(2, f"downside_deviation_{n}", f.from_row(n, F.sqrt(F.avg(F.pow(F.least("__r", F.lit(0.0)), F.lit(2))).over(f.last(n)))))


def _activity(p: Plan) -> None:
    f, volume = p.frames, F.col("volume")
    for n in cat.RELATIVE_VOLUME:
        p.put(2, f"relative_volume_{n}", f.from_row(n, div0(volume, F.avg(volume).over(f.before(n)))))
    for n in cat.VOLUME_Z:
        if p.wants(f"volume_zscore_{n}"):
            p.put(2, f"__v_{n}", F.collect_list("volume").over(f.before(n)))
            p.put(2, f"__vm_{n}", F.avg("volume").over(f.before(n)))
            p.put(3, f"__vs_{n}", std(F.col(f"__v_{n}")))
            p.put(4, f"volume_zscore_{n}", f.from_row(n, div0(volume - F.col(f"__vm_{n}"), F.col(f"__vs_{n}"))))
    for n in cat.OBV:
        p.put(2, f"obv_balance_{n}", f.from_row(n, div0(F.sum("__signed").over(f.last(n)), F.sum(volume).over(f.last(n)))))
    for n in cat.MFI:
        up, down = F.sum("__up").over(f.last(n)), F.sum("__down").over(f.last(n))
        p.put(2, f"mfi_{n}", f.from_row(n, F.coalesce(100 * div0(up, up + down), F.lit(50.0))))
    for n in cat.CMF:
        p.put(2, f"cmf_{n}", f.from_row(n - 1, div0(F.sum("__placed").over(f.last(n)), F.sum(volume).over(f.last(n)))))
    p.put(2, "log1p_volume", F.log1p(volume))
    p.put(2, "log1p_trade_count", F.log1p(F.col("trade_count").cast("double")))


def _distribution(p: Plan) -> None:
    f = p.frames
    for n in cat.MOMENTS:
        flat = F.max("__r").over(f.last(n)) == F.min("__r").over(f.last(n))
        p.put(2, f"return_skew_{n}", f.from_row(n, F.when(~flat, F.skewness("__r").over(f.last(n)))))
        p.put(2, f"return_excess_kurtosis_{n}", f.from_row(n, F.when(~flat, F.kurtosis("__r").over(f.last(n)))))
    n, lags = cat.AUTOCORR
    for k in lags:
        if p.wants(f"return_autocorr_{n}_lag_{k}"):
            p.put(2, f"__r_{k}", f.lag(F.col("__r"), k))
            p.put(3, f"return_autocorr_{n}_lag_{k}", f.from_row(n + k, correlation(F.col("__r"), F.col(f"__r_{k}"), f.last(n))))
    for n in cat.REGIME:
        if p.wants(f"mean_change_{n}", f"log_variance_ratio_{n}"):
            for side, frame in (("a", f.last(n)), ("b", f.earlier(n))):
                p.put(2, f"__m{side}_{n}", F.avg("__r").over(frame))
                flat = F.max("__r").over(frame) == F.min("__r").over(frame)
                p.put(2, f"__v{side}_{n}", F.when(flat, 0.0).otherwise(F.var_pop("__r").over(frame)))
            va, vb = F.col(f"__va_{n}"), F.col(f"__vb_{n}")
            p.put(3, f"mean_change_{n}", f.from_row(2 * n, div0(F.col(f"__ma_{n}") - F.col(f"__mb_{n}"), F.sqrt((va + vb) / 2))))
            p.put(3, f"log_variance_ratio_{n}", f.from_row(2 * n, F.when((va > 0) & (vb > 0), F.log(va / F.nullif(vb, F.lit(0.0))))))


def _flow_and_calendar(p: Plan) -> None:
    f, volume, taker = p.frames, F.col("volume"), F.col("taker_buy_base_volume")
    for n in cat.IMBALANCE:
        total = F.sum(volume).over(f.last(n))
        p.put(2, f"taker_buy_imbalance_{n}", f.from_row(n - 1, F.when(F.count(taker).over(f.last(n)) == n, div0(2 * F.sum(taker).over(f.last(n)) - total, total))))
    for n in cat.VOLUME_CORR:
        p.put(2, f"return_volume_corr_{n}", f.from_row(n, correlation(F.col("__r"), F.log1p("volume"), f.last(n))))
    second = F.pmod(F.col("end_ms"), F.lit(86_400_000)) / 1000
    day = F.pmod(F.floor(F.col("end_ms") / 86_400_000) + 3, F.lit(7)) + second / 86_400
    for name, turn in (("day", second / 86_400), ("week", day / 7)):
        p.put(2, f"time_of_{name}_sin", F.sin(2 * F.pi() * turn))
        p.put(2, f"time_of_{name}_cos", F.cos(2 * F.pi() * turn))


def compute(candles: DataFrame, keys: Sequence[str], names: Sequence[str] = cat.NAMES, reseed: bool = False) -> DataFrame:
    """keys, segment_id, end_ms and the features asked for, in the order asked. reseed: recursions start anew after values that aren't finite."""
    partition = [*keys, "segment_id"]
    ordered = Frames(partition, "end_ms", ROW).ordered
    indexed = candles.withColumn(ROW, F.row_number().over(ordered).cast("long") - 1)
    return compute_over(indexed, keys, partition, names, smoothing.smooth_runs if reseed else smoothing.smooth)


def compute_over(candles: DataFrame, keys: Sequence[str], partition: Sequence[str], names: Sequence[str], smooth, keep: Column | None = None) -> DataFrame:
    """compute() for rows that have their index in the segment in ROW, with windows over the given partition of them.

    smooth(df, scans, partition, row, order) adds the recursive columns; rows where keep is false only serve as history.
    """
    unknown = sorted(set(names) - set(cat.NAMES))
    if unknown:
        raise ValueError(f"unknown features: {unknown}")
    df = candles
    for optional in ("trade_count", "taker_buy_base_volume"):
        if optional not in df.columns:
            df = df.withColumn(optional, F.lit(None).cast("double"))
    p = Plan(partition, names)
    for family in (_price_and_shape, _trend, _momentum, _volatility, _activity, _distribution, _flow_and_calendar):
        family(p)
    f, close, high, low, volume = p.frames, *(F.col(c) for c in ("close", "high", "low", "volume"))
    tp = (high + low + close) / 3
    df = df.withColumns({"__pc": f.lag(close), "__tp": tp, "__ln": F.log(close), "__ptp": f.lag(tp)})
    change, span = close - F.col("__pc"), high - low
    pc = F.col("__pc")
    df = df.withColumns({
        "__r": F.log(close / pc),
        "__gain": F.when(pc.isNotNull(), F.greatest(change, F.lit(0.0))),
        "__loss": F.when(pc.isNotNull(), F.greatest(-change, F.lit(0.0))),
        "__tr": F.when(pc.isNotNull(), F.greatest(span, F.abs(high - pc), F.abs(low - pc))),
        "__signed": F.signum(change) * volume,
        "__up": F.when(F.col("__ptp").isNotNull(), F.when(F.col("__tp") > F.col("__ptp"), F.col("__tp") * volume).otherwise(0.0)),
        "__down": F.when(F.col("__ptp").isNotNull(), F.when(F.col("__tp") < F.col("__ptp"), F.col("__tp") * volume).otherwise(0.0)),
        "__placed": F.coalesce(div0(2 * close - high - low, span), F.lit(0.0)) * volume,
    })
    # Recursions first, while the rows are narrow.
    if p.scans:
        df = smooth(df, p.scans, p.keys, ROW, "end_ms")
    df = df.withColumns(p.stages[1])
    if p.signals:
        df = smooth(df, p.signals, p.keys, ROW, "end_ms")
    public = lambda c: not c.startswith("__")
    for stage in (2, 3, 4):
        df = df.withColumns({k: v for k, v in p.stages[stage].items() if not public(k) or k in p.wanted or k.replace("stoch_k", "stoch_d") in p.wanted})
    df = df.withColumns({k: v for k, v in p.stages[5].items() if k in p.wanted})
    df = df if keep is None else df.where(keep)
    return df.select(*keys, "segment_id", "end_ms", *[finite(F.col(n)).alias(n) for n in names])
