"""Order checks by summaries that merge: a part of a series is its first and last values, its rows and its breaks.

Two neighbouring parts make one: breaks add up, and the step from the first part's last row to the second's first may be one more. A row
is a part without breaks. Rows are merged into blocks of the last order column, blocks into the other order columns' groups (files, days),
and these into the series, so the only window over rows is inside a block, and what meets by series are summaries, block times fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


@dataclass(frozen=True)
class Check:
    """A step from a row's column to the next row's that holds ok(before, now) is no break; the first row, and one after a null, is none."""

    name: str
    column: str
    ok: Callable[[Column, Column], Column]


def rising(name: str, column: str) -> Check:
    return Check(name, column, lambda before, now: now > before)


def not_falling(name: str, column: str) -> Check:
    return Check(name, column, lambda before, now: now >= before)


def steps(name: str, column: str, step: int) -> Check:
    return Check(name, column, lambda before, now: now - before == step)


def apart(name: str, column: str, least: int) -> Check:
    return Check(name, column, lambda before, now: now - before >= least)


def _merge(parts: DataFrame, by: Sequence[str], order: Sequence[str], checks: Sequence[Check], sums: Sequence[str]) -> DataFrame:
    """Neighbouring parts of each group, in order, as one."""
    inside = Window.partitionBy(*by).orderBy(*order)
    parts = parts.withColumns({f"__p{i}": F.lag(f"__l{i}").over(inside) for i in range(len(checks))})
    place = F.struct(*order)
    out = []
    for i, c in enumerate(checks):
        before, now = F.col(f"__p{i}"), F.col(f"__f{i}")
        broken = before.isNotNull() & ~F.coalesce(c.ok(before, now), F.lit(False))
        out += [F.sum(F.col(f"__b{i}") + broken.cast("long")).alias(f"__b{i}"), F.min_by(f"__f{i}", place).alias(f"__f{i}"), F.max_by(f"__l{i}", place).alias(f"__l{i}")]
    return parts.groupBy(*by).agg(*out, *[F.sum(s).alias(s) for s in sums])


def parts(rows: DataFrame, keys: Sequence[str], order: Sequence[str], checks: Sequence[Check], rules: Mapping[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """A part for each series: keys, first (__f), last (__l) and breaks (__b) of each check, violations (__r) of each rule, and __rows."""
    rules, source, line = dict(rules or {}), list(order[:-1]), order[-1]
    first = {f"__f{i}": F.col(c.column) for i, c in enumerate(checks)} | {f"__l{i}": F.col(c.column) for i, c in enumerate(checks)} | {f"__b{i}": F.lit(0).cast("long") for i in range(len(checks))}
    counts = {f"__r{i}": (~F.coalesce(ok, F.lit(False))).cast("long") for i, ok in enumerate(rules.values())} | {"__rows": F.lit(1).cast("long")}
    found = rows.select(*keys, *[F.col(c) for c in order if c not in keys], *[v.alias(k) for k, v in (first | counts).items()], F.floor(F.col(line) / block).alias("__block"))
    levels = [([*keys, *source, "__block"], [line]), ([*keys, *source], ["__block"])]
    levels += [(list(keys), source)] if source else []
    for by, within in levels:
        found = _merge(found, list(dict.fromkeys(by)), within, checks, list(counts))
    return found


def joined(found: DataFrame, keys: Sequence[str], place: str, checks: Sequence[Check]) -> DataFrame:
    """Parts of the same series, in the order of place, as one part each."""
    return _merge(found, list(keys), [place], checks, [c for c in found.columns if c.startswith("__r")])


def summaries(rows: DataFrame, keys: Sequence[str], order: Sequence[str], checks: Sequence[Check], rules: Mapping[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """keys, rows and a count named as each check and each rule: breaks of order, and rows that break a rule, of each series.

    The last order column is a whole number (a line, a time) and is cut into blocks of that many; those before it are merged as they are.
    """
    names = {f"__b{i}": c.name for i, c in enumerate(checks)} | {f"__r{i}": n for i, n in enumerate(rules or {})} | {"__rows": "rows"}
    return parts(rows, keys, order, checks, rules, block).select(*keys, *[F.col(k).alias(n) for k, n in names.items()])


def violations(rows: DataFrame, keys: Sequence[str], order: Sequence[str], checks: Sequence[Check], rules: Mapping[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """(rule, violations) of every check and rule over all series, from one pass."""
    names = [c.name for c in checks] + list(rules or {})
    total = summaries(rows, keys, order, checks, rules, block).agg(*[F.coalesce(F.sum(f"`{n}`"), F.lit(0)).alias(f"r{i}") for i, n in enumerate(names)])
    return total.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(names)])))
