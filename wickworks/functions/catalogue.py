"""The ordered catalogue of the 128 features: names by rule, families, look-backs and first rows."""

from __future__ import annotations

from dataclasses import dataclass

# The periods of each family.
RETURNS = (1, 2, 3, 5, 10, 20, 40, 80)
EMA = (5, 10, 20, 40, 80, 160)
SMA = (10, 20, 50, 100)
SLOPE = (10, 20, 40, 80, 160)
RSI = (5, 7, 14, 21, 28, 42)
STOCH = (7, 14, 21, 28)
CCI = (10, 20, 40, 80)
MACD = ((6, 13, 5), (12, 26, 9), (24, 52, 18))
RETURN_VOL = (5, 10, 20, 40, 80, 160)
ATR = (7, 14, 28, 56)
BOLLINGER = (10, 20, 40, 80)
DOWNSIDE = (20, 80)
RELATIVE_VOLUME = (5, 10, 20, 40, 80, 160)
VOLUME_Z = (20, 40, 80, 160)
OBV = (10, 20, 40, 80)
MFI = (7, 14, 28, 56)
CMF = (10, 20, 40, 80)
MOMENTS = (20, 40, 80, 160)
AUTOCORR = (80, (1, 2, 3, 5))
REGIME = (20, 80)
IMBALANCE = (1, 5, 10, 20, 40)
VOLUME_CORR = (20, 40, 80)


@dataclass(frozen=True)
class Feature:
    name: str
    group: str
    family: str
    first: int  # first row of a segment, from 0, that can have a value


def _all() -> list[Feature]:
    out: list[Feature] = []

    def add(group: str, family: str, *pairs: tuple[str, int]) -> None:
        out.extend(Feature(name, group, family, first) for name, first in pairs)

    shape, trend, momentum, vol = "Price and candle shape", "Trend", "Momentum", "Volatility"
    activity, regime, flow = "Volume and activity", "Distribution and regime changes", "Trade flow and calendar"
    add(shape, "log_return", *((f"log_return_{h}", h) for h in RETURNS))
    add(shape, "candle_shape", *((x, 1) for x in ("candle_body", "candle_range", "upper_wick", "lower_wick")))
    add(trend, "ema_distance", *((f"ema_distance_{n}", n - 1) for n in EMA))
    add(trend, "sma_distance", *((f"sma_distance_{n}", n - 1) for n in SMA))
    add(trend, "log_slope", *((f"log_slope_{n}", n - 1) for n in SLOPE))
    add(trend, "log_r2", *((f"log_r2_{n}", n - 1) for n in SLOPE))
    add(momentum, "rsi", *((f"rsi_{n}", n) for n in RSI))
    add(momentum, "stochastic", *(x for n in STOCH for x in ((f"stoch_k_{n}", n - 1), (f"stoch_d_{n}", n + 1))))
    add(momentum, "cci", *((f"cci_{n}", n - 1) for n in CCI))
    add(momentum, "macd", *(x for f, s, q in MACD for x in ((f"macd_line_{f}_{s}_{q}", s - 1), (f"macd_hist_{f}_{s}_{q}", s + q - 2))))
    add(vol, "return_vol", *((f"return_vol_{n}", n) for n in RETURN_VOL))
    add(vol, "atr", *((f"atr_normalized_{n}", n) for n in ATR))
    add(vol, "bollinger", *(x for n in BOLLINGER for x in ((f"bb_position_{n}", n - 1), (f"bb_width_{n}", n - 1))))
    add(vol, "downside", *((f"downside_deviation_{n}", n) for n in DOWNSIDE))
    add(activity, "relative_volume", *((f"relative_volume_{n}", n) for n in RELATIVE_VOLUME))
    add(activity, "volume_zscore", *((f"volume_zscore_{n}", n) for n in VOLUME_Z))
    add(activity, "obv", *((f"obv_balance_{n}", n) for n in OBV))
    add(activity, "mfi", *((f"mfi_{n}", n) for n in MFI))
    add(activity, "cmf", *((f"cmf_{n}", n - 1) for n in CMF))
    add(activity, "log_activity", ("log1p_volume", 0), ("log1p_trade_count", 0))
    add(regime, "moments", *(x for n in MOMENTS for x in ((f"return_skew_{n}", n), (f"return_excess_kurtosis_{n}", n))))
    add(regime, "autocorr", *((f"return_autocorr_{AUTOCORR[0]}_lag_{k}", AUTOCORR[0] + k) for k in AUTOCORR[1]))
    add(regime, "regime", *(x for n in REGIME for x in ((f"mean_change_{n}", 2 * n), (f"log_variance_ratio_{n}", 2 * n))))
    add(flow, "imbalance", *((f"taker_buy_imbalance_{n}", n - 1) for n in IMBALANCE))
    add(flow, "volume_corr", *((f"return_volume_corr_{n}", n) for n in VOLUME_CORR))
    add(flow, "calendar", *((f"time_of_{x}_{y}", 0) for x in ("day", "week") for y in ("sin", "cos")))
    return out


CATALOGUE: tuple[Feature, ...] = tuple(_all())
NAMES: tuple[str, ...] = tuple(f.name for f in CATALOGUE)
FAMILIES: dict[str, tuple[str, ...]] = {k: tuple(f.name for f in CATALOGUE if f.family == k) for k in dict.fromkeys(f.family for f in CATALOGUE)}
assert len(NAMES) == len(set(NAMES)) == 128
