"""Seeded recursive smoothing, E = alpha x + (1 - alpha) E, as window sums: no UDF and no row-by-row loop.

The recursion is a weighted sum, E_t = sum of alpha x_i q^(t-i) with q = 1 - alpha. Inside a block of rows the weights q^-i stay in the
range of a double, so a running sum of alpha x q^-o, times q^o, is the block's own part; the rest is what the blocks before carry,
q^(o+1) times the value at their end. Block sizes come in three classes, so that q^block lies between 1e-300 and 1e-100 and three
blocks back reach beyond the range of doubles: nothing is truncated that a double could hold.

The seed is the mean of the first `period` values, put in at its row as seed / alpha; rows before it are null. smooth() takes a segment
whose values are all there from its scan's start on, as those of checked candles are. smooth_runs() takes any column: a value that is
missing or not finite ends a run, the next one starts another with a seed of its own, and a run shorter than the period gives nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = (1600, 6400, 25600)


@dataclass(frozen=True)
class Scan:
    """Smooths the column x, whose first value is at row `start` of each segment, into the column out."""

    out: str
    x: str
    period: int
    alpha: float
    start: int = 0

    @property
    def seed_row(self) -> int:
        return self.start + self.period - 1

    @property
    def block(self) -> int:
        """The largest block whose weights stay in range."""
        rate = -math.log1p(-self.alpha)
        return max(b for b in BLOCKS if rate * b <= 690) if rate * BLOCKS[0] <= 690 else int(690 / rate)


def ema(out: str, x: str, period: int, start: int = 0) -> Scan:
    return Scan(out, x, period, 2 / (period + 1), start)


def rma(out: str, x: str, period: int, start: int = 0) -> Scan:
    return Scan(out, x, period, 1 / period, start)


def smooth(df: DataFrame, scans: Sequence[Scan], keys: Sequence[str], row: str, order: str | None = None, at: str | None = None, live: Column | None = None, seeded: bool = False) -> DataFrame:
    """Adds each scan's column. row counts a segment's rows from 0; order is a column of the same order that other windows sort by.

    For a part of a segment, at counts the part's rows and live tells them from the rows before it, which add nothing; the result then
    is what the part's own rows add. seeded: the seeds are there, in __seed_<out>.
    """
    order = order or row
    index, ordered = F.col(row), Window.partitionBy(*keys).orderBy(order)
    at = F.col(at or row)
    live = F.lit(True) if live is None else live
    temp: list[str] = []

    def add(cols: dict) -> None:
        nonlocal df
        df = df.withColumns(cols)
        temp.extend(c for c in cols if c.startswith("__"))

    if not seeded:
        add({f"__seed_{s.out}": F.when(index == s.seed_row, F.avg(s.x).over(ordered.rowsBetween(-(s.period - 1), 0))) for s in scans})
    sizes = sorted({s.block for s in scans})
    add({f"__b_{b}": F.floor(at / b) for b in sizes} | {f"__o_{b}": F.pmod(at, F.lit(b)) for b in sizes})
    local = {}
    for s in scans:
        q, o = F.lit(1 - s.alpha), F.col(f"__o_{s.block}")
        y = F.when(~live | (index < s.seed_row), 0.0).when(index == s.seed_row, F.col(f"__seed_{s.out}")).otherwise(s.alpha * F.col(s.x))
        inside = Window.partitionBy(*keys, f"__b_{s.block}").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        local[f"__l_{s.out}"] = F.pow(q, o) * F.sum(y * F.pow(q, -o)).over(inside)
    add(local)
    past = ordered.rowsBetween(Window.unboundedPreceding, -1)
    for level in (1, 2, 3):
        carry = {}
        for s in scans:
            ends = F.col(f"__l_{s.out}")
            if level > 1:
                ends = ends + (1 - s.alpha) ** s.block * F.col(f"__c{level - 1}_{s.out}")
            carry[f"__c{level}_{s.out}"] = F.coalesce(F.last(F.when(live & (F.col(f"__o_{s.block}") == s.block - 1), ends), ignorenulls=True).over(past), F.lit(0.0))
        add(carry)
    df = df.withColumns({s.out: F.when(index >= s.seed_row, F.col(f"__l_{s.out}") + F.pow(F.lit(1 - s.alpha), F.col(f"__o_{s.block}") + 1) * F.col(f"__c3_{s.out}")) for s in scans})
    return df.drop(*temp)


def present(x: str) -> Column:
    """Whether a value is there and finite."""
    return F.coalesce(F.abs(F.col(x)) < float("inf"), F.lit(False))


def run_starts(df: DataFrame, x: str, keys: Sequence[str], row: str, order: str, own: Column | None = None) -> DataFrame:
    """Adds __run_<x>, the row that starts the run of present values that a row is in or after, among the rows of keys."""
    ordered = Window.partitionBy(*keys).orderBy(order)
    starts = present(x) & ~F.coalesce(F.lag(present(x)).over(ordered), F.lit(False))
    starts = starts if own is None else starts & own
    df = df.withColumn("__starts", F.when(starts, F.col(row)))
    return df.withColumn(f"__run_{x}", F.last("__starts", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))).drop("__starts")


def each_column(df: DataFrame, scans: Sequence[Scan], row: str, runs, within) -> DataFrame:
    """Smooths the runs of each scanned column apart: runs(df, x) finds them, within(df, scans, run, at) smooths by place in the run."""
    for x in dict.fromkeys(s.x for s in scans):
        mine = [replace(s, start=0) for s in scans if s.x == x]
        df = runs(df, x).withColumn(f"__value_{x}", F.when(present(x), F.col(x))).withColumn(f"__at_{x}", F.when(present(x), F.col(row) - F.col(f"__run_{x}")))
        df = within(df, [replace(s, x=f"__value_{x}") for s in mine], f"__run_{x}", f"__at_{x}")
        df = df.withColumns({s.out: F.when(present(x), F.col(s.out)) for s in mine}).drop(f"__run_{x}", f"__value_{x}", f"__at_{x}")
    return df


def smooth_runs(df: DataFrame, scans: Sequence[Scan], keys: Sequence[str], row: str, order: str | None = None) -> DataFrame:
    """smooth() for columns with breaks, seeded anew after each. A scan's start is not needed: its runs tell."""
    order = order or row
    return each_column(df, scans, row, lambda d, x: run_starts(d, x, keys, row, order), lambda d, mine, run, at: smooth(d, mine, [*keys, run], at, order))
