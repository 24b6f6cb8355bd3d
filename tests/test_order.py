"""Order checks by summaries, smoothing after breaks, and the rows policy in chunks, against plain loops and whole-series plans."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.test_features import HOUR, walk
from wickworks.functions import smoothing
from wickworks.operators import chunked, features, order, segments, validate
from wickworks.plans import runs

DAY = 86_400_000
TICK = "symbol string, day_ms long, line long, tick_id long, time_ms long, first_trade_id long, last_trade_id long, price double, quantity double, buyer_is_maker boolean"


def tick(symbol, day, line, i, ms):
    return (symbol, day * DAY, line, i, ms, 1, 1, 1.0, 1.0, True)


def plain_breaks(values, ok):
    return sum(1 for a, b in zip(values, values[1:]) if a is not None and (b is None or not ok(a, b)))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_summaries_equal_a_walk_over_the_rows(spark, block):
    rng = random.Random(block)
    rows, n = [], 0
    for s in "ab":
        for day in (3, 1, 2):
            for line in range(rng.randint(0, 12)):
                n += rng.choice([1, 1, 1, 0, -2])
                rows.append((s, day, line, rng.choice([n, n, n, None]), n))
    rng.shuffle(rows)
    checks = [order.rising("up", "x"), order.not_falling("not down", "y"), order.apart("apart", "y", 1)]
    df = spark.createDataFrame(rows, "symbol string, day int, line int, x int, y int").repartition(5)
    got = {r["symbol"]: r for r in order.summaries(df, ["symbol"], ["day", "line"], checks, {"x given": F.col("x").isNotNull()}, block).collect()}
    for s in got:
        mine = [r for r in sorted(rows, key=lambda r: r[1:3]) if r[0] == s]
        xs, ys = [r[3] for r in mine], [r[4] for r in mine]
        assert got[s]["rows"] == len(mine) and got[s]["x given"] == xs.count(None)
        assert got[s]["up"] == plain_breaks(xs, lambda a, b: b > a)
        assert got[s]["not down"] == plain_breaks(ys, lambda a, b: b >= a) and got[s]["apart"] == plain_breaks(ys, lambda a, b: b - a >= 1)


def test_a_break_exactly_between_two_files_is_found(spark):
    whole = [tick("A", d, n, 100 * d + n, d * DAY + n) for d in (1, 2, 3) for n in range(1, 6)]
    count = lambda rows: {r["rule"]: r["violations"] for r in validate.tick_violations(spark.createDataFrame(rows, TICK), ["symbol"], ["day_ms", "line"], 2).collect() if r["violations"]}
    assert count(whole) == {}
    again = [r for r in whole if r[1] != 2 * DAY] + [tick("A", 2, n, 104 + n, 2 * DAY + n) for n in range(1, 6)]
    assert count(again) == {"ids strictly increasing": 1}  # day 2 starts at the id that day 1 ends with
    later = [tick("A", 1, 6, 199, 2 * DAY - 1), *whole, tick("B", 1, 1, 5, DAY)]
    assert count(later) == {}
    assert count([tick("A", 1, 6, 199, 2 * DAY + 2), *whole]) == {"times not falling": 1, "time inside its day": 1}
    assert count([]) == {}


def test_windows_over_ticks_stay_inside_a_block(spark):
    df = validate.tick_violations(spark.createDataFrame([tick("A", 1, 1, 1, DAY)], TICK), ["symbol"], ["day_ms", "line"])
    windows = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert len(windows) == 3 and "__block" in windows[-1].split("windowspecdefinition(")[1].split("ASC")[0]
    assert "__block" not in windows[0].split("windowspecdefinition(")[1].split("day_ms")[0]


def plain_runs(x, period, alpha):
    out, i = np.full(len(x), np.nan), 0
    good = [v is not None and np.isfinite(v) for v in x]
    while i < len(x):
        j = i
        while j < len(x) and good[j]:
            j += 1
        if j - i >= period:
            e = out[i + period - 1] = np.mean(x[i : i + period])
            for k in range(i + period, j):
                e = out[k] = alpha * x[k] + (1 - alpha) * e
        i = max(j, i + 1)
    return out


def holes(n, seed):
    rng = np.random.default_rng(seed)
    x = [float(v) for v in rng.normal(100, 10, n)]
    for i in range(n):
        if rng.random() < 0.01 or 300 <= i < 320 or i < 3:
            x[i] = (None, float("nan"), float("inf"))[i % 3]
    return x


@pytest.mark.parametrize("policy", ["whole", "rows", "reset"])
def test_smoothing_starts_anew_after_breaks(spark, policy):
    n = 1500
    x, y = holes(n, 1), [float(i % 17) if i % 50 else None for i in range(n)]
    ends = [(i + 1) * HOUR + (5 * HOUR if i >= 700 and policy == "rows" else 0) for i in range(n)]
    df = spark.createDataFrame([("A", e, a, b) for e, a, b in zip(ends, x, y)], "symbol string, end_ms long, x double, y double").repartition(4)
    scans = [smoothing.ema("e5", "x", 5), smoothing.rma("r14", "x", 14), smoothing.ema("e200", "x", 200), smoothing.ema("y20", "y", 20, start=3)]
    if policy == "whole":
        rows = df.withColumn("row", F.row_number().over(Window.partitionBy("symbol").orderBy("end_ms")) - 1)
        out = smoothing.smooth_runs(rows, scans, ["symbol"], "row", "end_ms")
    else:
        out = chunked.smoothed(df, scans, ["symbol"], HOUR, 256, policy)
    out = out.orderBy("end_ms").toPandas()
    assert len(out) == n and not [c for c in out.columns if c.startswith(("__run", "__at", "__value"))]
    for s in scans:
        np.testing.assert_allclose(out[s.out].to_numpy(float), plain_runs(x if s.x == "x" else y, s.period, s.alpha), rtol=1e-9, atol=1e-9, equal_nan=True)


def test_rows_policy_in_chunks_equals_the_whole(spark):
    pdf = walk(620)
    pdf.loc[200:, "end_ms"] += 300 * HOUR
    pdf.loc[500:, "end_ms"] += 5 * HOUR
    df = spark.createDataFrame(pdf)
    whole = features.compute(segments.segment(df, ["symbol"], HOUR, "rows"), ["symbol"]).toPandas().sort_values("end_ms").reset_index(drop=True)
    parts = runs.calculate(df, ["symbol"], HOUR, "rows", chunk_rows=200).toPandas().sort_values("end_ms").reset_index(drop=True)
    assert list(parts.columns) == list(whole.columns) and len(parts) == 620
    for c in parts.columns[1:]:
        np.testing.assert_allclose(parts[c].to_numpy(float), whole[c].to_numpy(float), rtol=2e-8, atol=2e-9, equal_nan=True)
    gaps = segments.gap_counts(df, ["symbol"], HOUR, block=7).first()
    assert (gaps["rows"], gaps["gap_count"]) == (620, 2)
    with pytest.raises(ValueError, match="gap policy"):
        chunked.split(df, ["symbol"], HOUR, "other")
