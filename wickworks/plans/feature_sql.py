"""The features in DuckDB SQL by family: plain formulas over the candles, for comparison."""

from __future__ import annotations

from wickworks.functions import catalogue as cat
from wickworks.plans import fixtures as fx

_PART = "PARTITION BY symbol, segment_id ORDER BY end_ms"


def last(n: int) -> str:
    return f"({_PART} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def before(n: int) -> str:
    return f"({_PART} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def earlier(n: int) -> str:
    return f"({_PART} ROWS BETWEEN {2 * n - 1} PRECEDING AND {n} PRECEDING)"


def lag(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER ({_PART})"


def full(first: int, e: str) -> str:
    return f"CASE WHEN i >= {first} THEN {e} END"


def corr(x: str, y: str, n: int) -> str:
    w = last(n)
    flat = f"max({x}) OVER {w} = min({x}) OVER {w} OR max({y}) OVER {w} = min({y}) OVER {w}"
    return f"CASE WHEN NOT ({flat}) THEN greatest(least(covar_pop({x}, {y}) OVER {w} / nullif(stddev_pop({x}) OVER {w} * stddev_pop({y}) OVER {w}, 0), 1), -1) END"


def columns(family: str) -> dict[str, str]:
    """Feature to expression over c, for families without recursion."""
    out: dict[str, str] = {}
    if family == "log_return":
        out = {f"log_return_{h}": f"ln(close / {lag('close', h)})" for h in cat.RETURNS}
    elif family == "candle_shape":
        out = {"candle_body": "(close - open) / pc", "candle_range": "(high - low) / pc", "upper_wick": "(high - greatest(open, close)) / pc", "lower_wick": "(least(open, close) - low) / pc"}
    elif family == "sma_distance":
        out = {f"sma_distance_{n}": full(n - 1, f"close / avg(close) OVER {last(n)} - 1") for n in cat.SMA}
    elif family in ("log_slope", "log_r2"):
        for n in cat.SLOPE:
            flat = f"max(lc) OVER {last(n)} = min(lc) OVER {last(n)}"
            what = "regr_slope" if family == "log_slope" else "regr_r2"
            out[f"{family}_{n}"] = full(n - 1, f"CASE WHEN {flat} THEN 0 ELSE {what}(lc, i) OVER {last(n)} END")
    elif family == "stochastic":
        for n in cat.STOCH:
            span = f"(max(high) OVER {last(n)} - min(low) OVER {last(n)})"
            out[f"stoch_k_{n}"] = full(n - 1, f"CASE WHEN {span} = 0 THEN 50 ELSE 100 * (close - min(low) OVER {last(n)}) / {span} END")
    elif family == "cci":
        for n in cat.CCI:
            xs = f"list(tp) OVER {last(n)}"
            mean = f"avg(tp) OVER {last(n)}"
            out[f"cci_{n}"] = full(n - 1, f"CASE WHEN max(tp) OVER {last(n)} = min(tp) OVER {last(n)} THEN 0 ELSE (tp - {mean}) / (0.015 * (SELECT avg(abs(q.x - q.m)) FROM (SELECT unnest({xs}) AS x, {mean} AS m) q)) END")
    elif family == "return_vol":
        out = {f"return_vol_{n}": full(n, f"stddev_pop(r) OVER {last(n)}") for n in cat.RETURN_VOL}
    elif family == "bollinger":
        for n in cat.BOLLINGER:
            m, s = f"avg(close) OVER {last(n)}", f"stddev_pop(close) OVER {last(n)}"
            out[f"bb_position_{n}"] = full(n - 1, f"coalesce((close - ({m} - 2 * {s})) / nullif(4 * {s}, 0), 0.5)")
            out[f"bb_width_{n}"] = full(n - 1, f"4 * {s} / {m}")
    elif family == "downside":
        out = {f"downside_deviation_{n}": full(n, f"sqrt(avg(least(r, 0) * least(r, 0)) OVER {last(n)})") for n in cat.DOWNSIDE}
    elif family == "relative_volume":
        out = {f"relative_volume_{n}": full(n, f"volume / nullif(avg(volume) OVER {before(n)}, 0)") for n in cat.RELATIVE_VOLUME}
    elif family == "volume_zscore":
        out = {f"volume_zscore_{n}": full(n, f"(volume - avg(volume) OVER {before(n)}) / nullif(stddev_pop(volume) OVER {before(n)}, 0)") for n in cat.VOLUME_Z}
    elif family == "obv":
        out = {f"obv_balance_{n}": full(n, f"sum(sign(close - pc) * volume) OVER {last(n)} / nullif(sum(volume) OVER {last(n)}, 0)") for n in cat.OBV}
    elif family == "mfi":
        for n in cat.MFI:
            up, down = (f"sum(CASE WHEN ptp IS NULL THEN NULL WHEN tp {op} ptp THEN tp * volume ELSE 0 END) OVER {last(n)}" for op in ("> ", "< "))
            out[f"mfi_{n}"] = full(n, f"coalesce(100 * {up} / nullif({up} + {down}, 0), 50)")
    elif family == "cmf":
        placed = "coalesce((2 * close - high - low) / nullif(high - low, 0), 0) * volume"
        out = {f"cmf_{n}": full(n - 1, f"sum({placed}) OVER {last(n)} / nullif(sum(volume) OVER {last(n)}, 0)") for n in cat.CMF}
    elif family == "log_activity":
        out = {"log1p_volume": "ln(1 + volume)", "log1p_trade_count": "ln(1 + trade_count)"}
    elif family == "autocorr":
        n, lags = cat.AUTOCORR
        out = {f"return_autocorr_{n}_lag_{k}": full(n + k, corr("r", f"r{k}", n)) for k in lags}
    elif family == "regime":
        for n in cat.REGIME:
            va, vb = f"var_pop(r) OVER {last(n)}", f"var_pop(r) OVER {earlier(n)}"
            out[f"mean_change_{n}"] = full(2 * n, f"(avg(r) OVER {last(n)} - avg(r) OVER {earlier(n)}) / nullif(sqrt(({va} + {vb}) / 2), 0)")
            out[f"log_variance_ratio_{n}"] = full(2 * n, f"CASE WHEN {va} > 0 AND {vb} > 0 THEN ln(({va}) / ({vb})) END")
    elif family == "imbalance":
        out = {f"taker_buy_imbalance_{n}": full(n - 1, f"(2 * sum(taker_buy_base_volume) OVER {last(n)} - sum(volume) OVER {last(n)}) / nullif(sum(volume) OVER {last(n)}, 0)") for n in cat.IMBALANCE}
    elif family == "volume_corr":
        out = {f"return_volume_corr_{n}": full(n, corr("r", "ln(1 + volume)", n)) for n in cat.VOLUME_CORR}
    elif family == "calendar":
        day = "(end_ms % 86400000) / 86400000.0"
        week = "(((end_ms // 86400000 + 3) % 7) + (end_ms % 86400000) / 86400000.0) / 7"
        out = {f"time_of_{n}_{f}": f"{f}(2 * pi() * ({x}))" for n, x in (("day", day), ("week", week)) for f in ("sin", "cos")}
    return out


def rounded(pairs: dict[str, str], digits: int = 6) -> str:
    return ", ".join(f"round({e}, {digits}) + 0.0 AS {n}" for n, e in pairs.items())


def _scans(family: str) -> list[tuple[str, str, int, float, int]]:
    """(name, column, period, alpha, first row with a value)."""
    if family == "ema_distance":
        return [(f"e{n}", "close", n, 2 / (n + 1), 0) for n in cat.EMA]
    if family == "rsi":
        return [(f"{x}{n}", x, n, 1 / n, 1) for n in cat.RSI for x in ("gain", "loss")]
    if family == "atr":
        return [(f"t{n}", "tr", n, 1 / n, 1) for n in cat.ATR]
    return [(f"e{n}", "close", n, 2 / (n + 1), 0) for n in sorted({x for f, s, _ in cat.MACD for x in (f, s)})]


def _recursion(prefix: str, scans, source: str) -> str:
    """CTEs that end in {prefix}w: (symbol, segment_id, i) with a column for each scan."""
    rows = ", ".join(f"('{k}', {p}, {a!r}, {s})" for k, _, p, a, s in scans)
    xs = " UNION ALL ".join(f"SELECT '{k}' AS k, symbol, segment_id, i, {x} AS x FROM {source}" for k, x, *_ in scans)
    wide = ", ".join(f"max(e) FILTER (k = '{k}') AS {k}" for k, *_ in scans)
    return f"""{prefix}p(k, p, a, s) AS (VALUES {rows}),
{prefix}x AS ({xs}),
{prefix}r AS (SELECT x.k, symbol, segment_id, any_value(s + p - 1) AS i, avg(x) AS e FROM {prefix}x x JOIN {prefix}p p ON x.k = p.k WHERE i BETWEEN s AND s + p - 1 GROUP BY x.k, symbol, segment_id HAVING count(*) = any_value(p)
  UNION ALL SELECT r.k, r.symbol, r.segment_id, x.i, p.a * x.x + (1 - p.a) * r.e FROM {prefix}r r JOIN {prefix}p p ON r.k = p.k JOIN {prefix}x x ON x.k = r.k AND x.symbol = r.symbol AND x.segment_id = r.segment_id AND x.i = r.i + 1),
{prefix}w AS (SELECT symbol, segment_id, i, {wide} FROM {prefix}r GROUP BY symbol, segment_id, i)"""


def family_sql(family: str, base: str, step: int) -> str:
    """The query of one family (moments and recursions included) over candles made by the CTEs in base."""
    head = f"WITH RECURSIVE {base}, {fx.segmented_sql(step)}"
    keys = "symbol, segment_id, end_ms"
    if family == "stochastic":
        k = ", ".join(f"{e} AS {n}" for n, e in columns(family).items())
        out = ", ".join(f"round(stoch_k_{n}, 6) + 0.0 AS stoch_k_{n}, round({full(n + 1, f'avg(stoch_k_{n}) OVER {last(3)}')}, 6) + 0.0 AS stoch_d_{n}" for n in cat.STOCH)
        return f"{head}, k AS (SELECT {keys}, i, {k} FROM c) SELECT {keys}, {out} FROM k"
    if family == "cci":
        lists = ", ".join(f"list(tp) OVER {last(n)} AS l{n}, avg(tp) OVER {last(n)} AS m{n}" for n in cat.CCI)
        out = {f"cci_{n}": full(n - 1, f"CASE WHEN list_max(l{n}) = list_min(l{n}) THEN 0 ELSE (tp - m{n}) / (0.015 * list_avg(list_transform(l{n}, lambda x: abs(x - m{n})))) END") for n in cat.CCI}
        return f"{head}, k AS (SELECT {keys}, i, tp, {lists} FROM c) SELECT {keys}, {rounded(out)} FROM k"
    if family == "moments":
        lists = ", ".join(f"list(r) OVER {last(n)} AS l{n}, avg(r) OVER {last(n)} AS m{n}" for n in cat.MOMENTS)
        out = {}
        for n in cat.MOMENTS:
            m = lambda k, n=n: f"list_avg(list_transform(l{n}, lambda x: power(x - m{n}, {k})))"
            some = f"list_max(l{n}) > list_min(l{n})"
            out[f"return_skew_{n}"] = full(n, f"CASE WHEN {some} THEN {m(3)} / power({m(2)}, 1.5) END")
            out[f"return_excess_kurtosis_{n}"] = full(n, f"CASE WHEN {some} THEN {m(4)} / power({m(2)}, 2) - 3 END")
        return f"{head}, k AS (SELECT {keys}, i, {lists} FROM c) SELECT {keys}, {rounded(out)} FROM k"
    if family == "autocorr":
        lags = ", ".join(f"{lag('r', k)} AS r{k}" for k in cat.AUTOCORR[1])
        return f"{head}, k AS (SELECT {keys}, i, r, {lags} FROM c) SELECT {keys}, {rounded(columns(family))} FROM k"
    if family in ("ema_distance", "rsi", "atr", "macd"):
        scans = _scans(family)
        head += ", " + _recursion("u", scans, "c")
        join = "LEFT JOIN uw USING (symbol, segment_id, i)"
        if family == "ema_distance":
            out = {f"ema_distance_{n}": f"close / e{n} - 1" for n in cat.EMA}
        elif family == "rsi":
            out = {f"rsi_{n}": f"CASE WHEN gain{n} + loss{n} = 0 THEN 50 ELSE 100 * gain{n} / (gain{n} + loss{n}) END" for n in cat.RSI}
        elif family == "atr":
            out = {f"atr_normalized_{n}": f"t{n} / close" for n in cat.ATR}
        else:
            lines = ", ".join(f"e{f} - e{s} AS m{f}" for f, s, _ in cat.MACD)
            head += f", m AS (SELECT c.*, {lines} FROM c {join}), " + _recursion("v", [(f"s{f}", f"m{f}", q, 2 / (q + 1), s - 1) for f, s, q in cat.MACD], "m")
            out = {}
            for f, s, q in cat.MACD:
                out[f"macd_line_{f}_{s}_{q}"] = f"m{f} / close"
                out[f"macd_hist_{f}_{s}_{q}"] = f"(m{f} - s{f}) / close"
            return f"{head} SELECT {keys}, {rounded(out)} FROM m LEFT JOIN vw USING (symbol, segment_id, i)"
        return f"{head} SELECT {keys}, {rounded(out)} FROM c {join}"
    return f"{head} SELECT {keys}, {rounded(columns(family))} FROM c"


def every_family_sql(base: str, step: int, before: str = "symbol, segment_id, end_ms") -> str:
    """All families joined by row, in the order of the catalogue."""
    keys = "symbol, segment_id, end_ms"
    first, *others = cat.FAMILIES
    joined = "".join(f" JOIN ({family_sql(f, base, step)}) f_{f} USING ({keys})" for f in others)
    return f"SELECT {before}, {', '.join(cat.NAMES)} FROM ({family_sql(first, base, step)}) f_{first}{joined}"
