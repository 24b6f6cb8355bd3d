"""Features against plain NumPy formulas, worked examples, causality, gaps and degenerate windows."""

import numpy as np
import pandas as pd
import pytest

from wickworks.functions import catalogue as cat
from wickworks.functions import smoothing
from wickworks.operators import candles as cd
from wickworks.operators import chunked, features, names, quality, segments, ticks, validate

HOUR = 3_600_000
RTOL, ATOL = 2e-8, 2e-9


def walk(n=420, seed=1, gap_at=None):
    rng = np.random.default_rng(seed)
    c = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    if n > 230:
        c[200:230] = c[200]
    o = np.r_[c[0], c[:-1]]
    h, low = np.maximum(o, c) * (1 + rng.random(n) * 0.01), np.minimum(o, c) * (1 - rng.random(n) * 0.01)
    if n > 230:
        h[205:230] = low[205:230] = c[200]
    v = np.round(rng.random(n) * 10, 2)
    v[300:312] = 0
    end = np.arange(1, n + 1) * HOUR
    if gap_at:
        end[gap_at:] += 2 * HOUR
    return pd.DataFrame({"symbol": "A", "end_ms": end, "open": o, "high": h, "low": low, "close": c, "volume": v, "trade_count": np.arange(n), "taker_buy_base_volume": v * 0.4})


def run(spark, pdf, wanted=cat.NAMES, policy="reset"):
    df = spark.createDataFrame(pdf)
    return features.compute(segments.segment(df, ["symbol"], HOUR, policy), ["symbol"], wanted).toPandas().sort_values("end_ms").reset_index(drop=True)


@pytest.fixture(scope="module")
def full(spark):
    return walk(), run(spark, walk())


def smooth(x, p, a):
    out = np.full(len(x), np.nan)
    k = int(np.flatnonzero(~np.isnan(x))[0])
    if k + p > len(x):
        return out
    e = out[k + p - 1] = x[k : k + p].mean()
    for i in range(k + p, len(x)):
        e = out[i] = a * x[i] + (1 - a) * e
    return out


def same(got, want):
    got = got.to_numpy(float)
    assert np.array_equal(np.isnan(got), np.isnan(want))
    np.testing.assert_allclose(got, want, rtol=RTOL, atol=ATOL, equal_nan=True)


def rolling(f, first, m):
    out = np.full(m, np.nan)
    for i in range(first, m):
        out[i] = f(i)
    return out


def test_catalogue():
    assert len(cat.NAMES) == 128 and cat.NAMES[0] == "log_return_1" and cat.NAMES[-1] == "time_of_week_cos"
    assert cat.NAMES[50] == "macd_line_6_13_5" and cat.NAMES[112] == "mean_change_20"
    assert max(f.first for f in cat.CATALOGUE) == 160


def test_first_rows_and_order(full):
    _, r = full
    assert list(r.columns[3:]) == list(cat.NAMES)
    for f in cat.CATALOGUE:
        assert int(np.flatnonzero(r[f.name].notna())[0]) == f.first, f.name


def test_recursive_families(full):
    pdf, r = full
    C, H, L = (pdf[x].to_numpy() for x in ("close", "high", "low"))
    d = np.r_[np.nan, np.diff(C)]
    for p in cat.EMA:
        same(r[f"ema_distance_{p}"], C / smooth(C, p, 2 / (p + 1)) - 1)
    for p in cat.RSI:
        g, q = smooth(np.where(np.isnan(d), np.nan, np.maximum(d, 0)), p, 1 / p), smooth(np.where(np.isnan(d), np.nan, np.maximum(-d, 0)), p, 1 / p)
        same(r[f"rsi_{p}"], np.where(g + q == 0, 50, 100 * g / (g + q)))
    tr = np.r_[np.nan, np.maximum(np.maximum(H[1:] - L[1:], abs(H[1:] - C[:-1])), abs(L[1:] - C[:-1]))]
    for p in cat.ATR:
        same(r[f"atr_normalized_{p}"], smooth(tr, p, 1 / p) / C)
    for f, s, q in cat.MACD:
        m = smooth(C, f, 2 / (f + 1)) - smooth(C, s, 2 / (s + 1))
        same(r[f"macd_line_{f}_{s}_{q}"], m / C)
        same(r[f"macd_hist_{f}_{s}_{q}"], (m - smooth(m, q, 2 / (q + 1))) / C)


def test_windowed_families(full):
    pdf, r = full
    O, H, L, C, V, B = (pdf[x].to_numpy() for x in ("open", "high", "low", "close", "volume", "taker_buy_base_volume"))
    m, R, P = len(C), np.r_[np.nan, np.log(C[1:] / C[:-1])], (H + L + C) / 3

    def corr(x, y):
        return np.nan if x.max() == x.min() or y.max() == y.min() else np.corrcoef(x, y)[0, 1]

    for n in cat.SMA:
        same(r[f"sma_distance_{n}"], rolling(lambda i, n=n: C[i] / C[i - n + 1 : i + 1].mean() - 1, n - 1, m))
    for n in cat.SLOPE:
        w = lambda i, n=n: np.log(C[i - n + 1 : i + 1])
        flat = lambda y: y.max() == y.min()
        same(r[f"log_slope_{n}"], rolling(lambda i, n=n, w=w: 0 if flat(w(i)) else np.polyfit(np.arange(n), w(i), 1)[0], n - 1, m))
        same(r[f"log_r2_{n}"], rolling(lambda i, n=n, w=w: 0 if flat(w(i)) else np.corrcoef(np.arange(n), w(i))[0, 1] ** 2, n - 1, m))
    for n in cat.CCI:
        def cci(i, n=n):
            w = P[i - n + 1 : i + 1]
            return 0 if w.max() == w.min() else (P[i] - w.mean()) / (0.015 * np.abs(w - w.mean()).mean())
        same(r[f"cci_{n}"], rolling(cci, n - 1, m))
    for n in cat.STOCH:
        def k(i, n=n):
            lo, hi = L[i - n + 1 : i + 1].min(), H[i - n + 1 : i + 1].max()
            return 50 if hi == lo else 100 * (C[i] - lo) / (hi - lo)
        ks = rolling(k, n - 1, m)
        same(r[f"stoch_k_{n}"], ks)
        same(r[f"stoch_d_{n}"], rolling(lambda i, ks=ks: ks[i - 2 : i + 1].mean(), n + 1, m))
    for n in cat.BOLLINGER:
        s = lambda i, n=n: C[i - n + 1 : i + 1].std() if C[i - n + 1 : i + 1].max() > C[i - n + 1 : i + 1].min() else 0.0
        mean = lambda i, n=n: C[i - n + 1 : i + 1].mean()
        same(r[f"bb_width_{n}"], rolling(lambda i: 4 * s(i) / mean(i), n - 1, m))
        same(r[f"bb_position_{n}"], rolling(lambda i: 0.5 if s(i) == 0 else (C[i] - mean(i) + 2 * s(i)) / (4 * s(i)), n - 1, m))
    for n in cat.VOLUME_Z:
        same(r[f"volume_zscore_{n}"], rolling(lambda i, n=n: (V[i] - V[i - n : i].mean()) / V[i - n : i].std(), n, m))
    for n in cat.RELATIVE_VOLUME:
        same(r[f"relative_volume_{n}"], rolling(lambda i, n=n: V[i] / V[i - n : i].mean() if V[i - n : i].sum() else np.nan, n, m))
    for n in cat.MFI:
        def mfi(i, n=n):
            j = np.arange(i - n + 1, i + 1)
            up, down = (P[j] * V[j])[P[j] > P[j - 1]].sum(), (P[j] * V[j])[P[j] < P[j - 1]].sum()
            return 50 if up + down == 0 else 100 * up / (up + down)
        same(r[f"mfi_{n}"], rolling(mfi, n, m))
    for n in cat.OBV:
        def obv(i, n=n):
            j = np.arange(i - n + 1, i + 1)
            return (np.sign(C[j] - C[j - 1]) * V[j]).sum() / V[j].sum() if V[j].sum() else np.nan
        same(r[f"obv_balance_{n}"], rolling(obv, n, m))
    for n in cat.CMF:
        a = np.where(H > L, (2 * C - H - L) / np.where(H > L, H - L, 1), 0)
        same(r[f"cmf_{n}"], rolling(lambda i, n=n: (a * V)[i - n + 1 : i + 1].sum() / V[i - n + 1 : i + 1].sum() if V[i - n + 1 : i + 1].sum() else np.nan, n - 1, m))
    for n in cat.MOMENTS:
        def moment(i, k, n=n):
            w = R[i - n + 1 : i + 1]
            return np.nan if w.max() == w.min() else ((w - w.mean()) ** k).mean() / w.var() ** (k / 2) - (3 if k == 4 else 0)
        same(r[f"return_skew_{n}"], rolling(lambda i: moment(i, 3), n, m))
        same(r[f"return_excess_kurtosis_{n}"], rolling(lambda i: moment(i, 4), n, m))
    for k in cat.AUTOCORR[1]:
        same(r[f"return_autocorr_80_lag_{k}"], rolling(lambda i, k=k: corr(R[i - 79 : i + 1], R[i - 79 - k : i + 1 - k]), 80 + k, m))
    for n in cat.VOLUME_CORR:
        same(r[f"return_volume_corr_{n}"], rolling(lambda i, n=n: corr(R[i - n + 1 : i + 1], np.log1p(V)[i - n + 1 : i + 1]), n, m))
    for n in cat.REGIME:
        a, b = (lambda i, n=n: R[i - n + 1 : i + 1]), (lambda i, n=n: R[i - 2 * n + 1 : i - n + 1])
        var = lambda w: 0.0 if w.max() == w.min() else w.var()
        same(r[f"mean_change_{n}"], rolling(lambda i: (a(i).mean() - b(i).mean()) / np.sqrt((var(a(i)) + var(b(i))) / 2), 2 * n, m))
        same(r[f"log_variance_ratio_{n}"], rolling(lambda i: np.log(var(a(i)) / var(b(i))) if var(a(i)) > 0 and var(b(i)) > 0 else np.nan, 2 * n, m))
    for n in cat.IMBALANCE:
        same(r[f"taker_buy_imbalance_{n}"], rolling(lambda i, n=n: (2 * B[i - n + 1 : i + 1].sum() - V[i - n + 1 : i + 1].sum()) / V[i - n + 1 : i + 1].sum() if V[i - n + 1 : i + 1].sum() else np.nan, n - 1, m))
    for n in cat.RETURN_VOL:
        same(r[f"return_vol_{n}"], rolling(lambda i, n=n: R[i - n + 1 : i + 1].std(), n, m))
    for n in cat.DOWNSIDE:
        same(r[f"downside_deviation_{n}"], rolling(lambda i, n=n: np.sqrt((np.minimum(R[i - n + 1 : i + 1], 0) ** 2).mean()), n, m))


def test_worked_candle(spark):
    rows = [dict(symbol="A", end_ms=HOUR, open=100.0, high=100.0, low=100.0, close=100.0, volume=1.0, trade_count=1, taker_buy_base_volume=0.5), dict(symbol="A", end_ms=2 * HOUR, open=101.0, high=105.0, low=99.0, close=104.0, volume=200.0, trade_count=50, taker_buy_base_volume=140.0)]
    wanted = ("log_return_1", "candle_body", "candle_range", "upper_wick", "lower_wick", "taker_buy_imbalance_1", "log1p_volume", "log1p_trade_count")
    last = run(spark, pd.DataFrame(rows), wanted).iloc[1]
    np.testing.assert_allclose([last[x] for x in wanted], [0.039220713, 0.03, 0.06, 0.01, 0.02, 0.4, 5.303304908, 3.931825633], rtol=1e-7)


def test_calendar(spark):
    monday = 4 * 24 * HOUR  # 1970-01-05
    pdf = walk(4).assign(end_ms=[monday, monday + 6 * HOUR, monday + 12 * HOUR, monday + 18 * HOUR])
    r = run(spark, pdf, cat.FAMILIES["calendar"], "rows")
    np.testing.assert_allclose(r[["time_of_day_sin", "time_of_day_cos"]].to_numpy(), [[0, 1], [1, 0], [0, -1], [-1, 0]], atol=1e-12)
    np.testing.assert_allclose(r[["time_of_week_sin", "time_of_week_cos"]].to_numpy()[0], [0, 1], atol=1e-12)


def test_causal(spark, full):
    pdf, r = full
    changed = pdf.copy()
    changed.loc[300:, ["open", "high", "low", "close", "volume"]] *= 3
    again = run(spark, changed)
    pd.testing.assert_frame_equal(again.iloc[:300], r.iloc[:300])


def test_gap_policies(spark):
    pdf = walk(gap_at=250)
    reset, rows = run(spark, pdf), run(spark, pdf, policy="rows")
    alone = run(spark, pdf.iloc[250:])
    pd.testing.assert_frame_equal(reset.iloc[250:].drop(columns="segment_id").reset_index(drop=True), alone.drop(columns="segment_id"))
    assert reset.segment_id.tolist() == [0] * 250 + [1] * 170 and rows.segment_id.eq(0).all()
    assert rows["log_return_1"].isna().sum() == 1 and reset["log_return_1"].isna().sum() == 2
    with pytest.raises(ValueError):
        run(spark, pdf, policy="other")


def test_constant_price(spark):
    pdf = walk(200).assign(open=5.0, high=5.0, low=5.0, close=5.0)
    last = run(spark, pdf).iloc[-1]
    assert (last["rsi_14"], last["stoch_k_14"], last["cci_20"], last["log_slope_20"], last["log_r2_20"], last["bb_position_20"], last["bb_width_20"], last["mfi_14"]) == (50, 50, 0, 0, 0, 0.5, 0, 50)
    assert all(pd.isna(last[c]) for c in ("return_skew_20", "return_excess_kurtosis_20", "return_autocorr_80_lag_1", "return_volume_corr_20", "log_variance_ratio_20", "mean_change_20"))


def test_no_residue_of_an_expired_spike(spark):
    pdf = walk(120)
    tiny = 1e5 + 1e-5 * np.resize([1.0, -1.0], 120)
    tiny[30] = 2e5
    pdf = pdf.assign(open=tiny, high=tiny + 1e-4, low=tiny - 1e-4, close=tiny, volume=tiny)
    r = run(spark, pdf, ("bb_width_10", "volume_zscore_20"))
    w = tiny[90:100]
    np.testing.assert_allclose(r["bb_width_10"].iloc[99], 4 * (w - w[0]).std() / w.mean(), rtol=1e-6)


def test_missing_optional_inputs(spark):
    pdf = walk(60).drop(columns=["trade_count", "taker_buy_base_volume"])
    r = run(spark, pdf)
    assert r["log1p_trade_count"].isna().all() and r["taker_buy_imbalance_1"].isna().all() and r["log1p_volume"].notna().all()
    assert set(quality.unavailable_inputs(spark.createDataFrame(pdf))) == {"log1p_trade_count", *cat.FAMILIES["imbalance"]}


def test_smoothing_over_many_blocks(spark):
    n = 60_000
    rng = np.random.default_rng(3)
    x = np.abs(rng.normal(size=n))
    x[20_000:45_000] = 0  # long silence: decayed values must keep their ratio
    pdf = pd.DataFrame({"k": "a", "row": np.arange(n), "x": x, "y": 3 * x})
    scans = [smoothing.ema("e5", "x", 5), smoothing.rma("r42", "x", 42), smoothing.rma("s42", "y", 42), smoothing.ema("e160", "x", 160)]
    r = smoothing.smooth(spark.createDataFrame(pdf), scans, ["k"], "row").toPandas().sort_values("row")
    for s, col in ((scans[0], x), (scans[1], x), (scans[3], x)):
        want = smooth(col, s.period, s.alpha)
        np.testing.assert_allclose(r[s.out].to_numpy(float), want, rtol=1e-11, atol=1e-290, equal_nan=True)
    live = r["r42"].to_numpy(float)[41:44_000]
    np.testing.assert_allclose((r["s42"].to_numpy(float)[41:44_000] / live)[live > 1e-280], 3, rtol=1e-9)


def test_chunks_equal_the_whole(spark):
    parts = [walk(900, 5, 701).assign(symbol="A"), walk(420, 6).assign(symbol="B"), walk(300, 7, 100).assign(symbol="C"), walk(1, 8).assign(symbol="D")]
    parts[0].loc[300:, "end_ms"] += 57 * HOUR
    df = spark.createDataFrame(pd.concat(parts))
    order = ["symbol", "end_ms"]
    rows = segments.segment(df, ["symbol"], HOUR).toPandas().sort_values(order).reset_index(drop=True)
    found = chunked.indexed(df, ["symbol"], HOUR, 200).toPandas().sort_values(order).reset_index(drop=True)
    assert found.gap.equals(rows.gap) and found.segment_id.equals(rows.segment_id)
    assert (found[features.ROW] == rows.groupby(["symbol", "segment_id"]).cumcount()).all()
    wanted = [n for f in ("ema_distance", "macd", "rsi", "log_slope", "regime", "autocorr", "stochastic", "obv") for n in cat.FAMILIES[f]]
    whole = features.compute(segments.segment(df, ["symbol"], HOUR), ["symbol"], wanted).toPandas().sort_values(order).reset_index(drop=True)
    cut = chunked.compute(df, ["symbol"], HOUR, wanted, chunk_rows=200).toPandas().sort_values(order).reset_index(drop=True)
    for n in wanted:
        same(cut[n], whole[n].to_numpy(float))
    with pytest.raises(ValueError):
        chunked.compute(df, ["symbol"], HOUR, wanted, chunk_rows=100)


def test_quality_report(spark):
    df = spark.createDataFrame(walk(60, gap_at=30))
    out = features.compute(segments.segment(df, ["symbol"], HOUR), ["symbol"], ("log_return_5", "time_of_day_sin"))
    row = quality.wide(out, ["symbol"], ("log_return_5", "time_of_day_sin")).first()
    assert (row["rows"], row["segments"], row["missing_log_return_5"], row["complete_all"], row["first_complete_end_ms"]) == (60, 2, 10, 50, 6 * HOUR)


def test_validation_names_the_rule(spark):
    df = spark.createDataFrame([("A", HOUR, 2 * HOUR - 1, 2 * HOUR, 1.0, 3.0, 2.0, 1.5, 1.0, 1, 0.5)], "symbol string, open_ms long, close_ms long, end_ms long, open double, high double, low double, close double, volume double, trade_count long, taker_buy_base_volume double")
    with pytest.raises(validate.ValidationError, match="low <= open"):
        validate.require(df, validate.candle_rules(HOUR))


def test_ticks_edge_cases(spark):
    t = spark.createDataFrame([("A", 2, 10, 5.0, 0, False), ("A", 1, 9, 4.0, 0, True)], "symbol string, tick_id long, time_ms long, price double, quantity long, buyer_is_maker boolean")
    b = ticks.aggregate(t, ["symbol"], HOUR).first()
    assert (b["agg_open"], b["agg_close"], b["agg_vwap"], b["agg_trade_count"]) == (4.0, 5.0, None, 2)
    c = cd.from_ticks(t, ["symbol"], HOUR).first()
    assert (c["open"], c["close"], c["volume"], c["end_ms"]) == (4.0, 5.0, 0.0, HOUR)


def test_file_names(spark):
    df = spark.createDataFrame([(s,) for s in ("BTC", "btc", "a b", "ok-1", "x" * 65)], "symbol string")
    out = {r["symbol"]: r["file"] for r in names.file_names(df).collect()}
    assert out["ok-1"] == "ok-1-features.parquet" and out["a b"].startswith("symbol-") and out["BTC"].startswith("BTC-") and out["btc"].startswith("btc-") and len({x.lower() for x in out.values()}) == 5
