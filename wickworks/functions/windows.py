"""Window building blocks: full windows or null, safe division, statistics with an origin inside the window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


class Frames:
    """Row frames of one (partition, order): over the last n rows, the n before the current, and the n before those."""

    def __init__(self, keys: Sequence[str], order: str, row: str):
        self.ordered = Window.partitionBy(*keys).orderBy(order)
        self.row = F.col(row)

    def last(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-(n - 1), 0)

    def before(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-n, -1)

    def earlier(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-(2 * n - 1), -n)

    def lag(self, x: Column, k: int = 1) -> Column:
        return F.lag(x, k).over(self.ordered)

    def from_row(self, first: int, value: Column) -> Column:
        """value from row `first` of a segment on (when its window is full), else null."""
        return F.when(self.row >= first, value)


def div0(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.nullif(b, F.lit(0.0))


def finite(x: Column) -> Column:
    """x, null where it is infinite or NaN."""
    return F.when(F.abs(x) < float("inf"), x)


def variance(values: Column) -> Column:
    """Population variance of an array, from sums of differences to its first element, so that a level loses no digits."""
    origin = values[0]
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0).alias("n"))

    def add(acc: Column, x: Column) -> Column:
        d = x - origin
        return F.struct((acc["s"] + d).alias("s"), (acc["q"] + d * d).alias("q"), (acc["n"] + 1).alias("n"))

    return F.aggregate(values, zero, add, lambda a: F.when(a["n"] > 0, F.greatest(a["q"] / a["n"] - (a["s"] / a["n"]) * (a["s"] / a["n"]), F.lit(0.0))))


def std(values: Column) -> Column:
    return F.sqrt(variance(values))


def trend_product(values: Column, n: int) -> Column:
    """Sum over i of (i - (n-1)/2) * values[i], with values taken from the first."""
    origin, middle = values[0], (n - 1) / 2
    return F.aggregate(F.transform(values, lambda y, i: (i - middle) * (y - origin)), F.lit(0.0), lambda a, x: a + x)


def mean_deviation(values: Column, mean: Column, n: int) -> Column:
    return F.aggregate(F.transform(values, lambda x: F.abs(x - mean)), F.lit(0.0), lambda a, x: a + x) / n


def correlation(x: Column, y: Column, over: WindowSpec) -> Column:
    """Pearson correlation over full windows, null where a side is constant, within -1 and 1."""
    flat = (F.max(x).over(over) == F.min(x).over(over)) | (F.max(y).over(over) == F.min(y).over(over))
    r = div0(F.covar_pop(x, y).over(over), F.stddev_pop(x).over(over) * F.stddev_pop(y).over(over))
    return F.when(~flat, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
