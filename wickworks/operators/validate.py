"""Named checks over candles and ticks: one aggregation counts each rule's violations; a run fails rather than drop rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.operators import order
from wickworks.operators.candles import DAY_MS, MARKETS

# The syntax of whole and decimal numbers in archives.
DIGITS = "^[0-9]+$"
NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
MAX_LONG = 2**63 - 1


class ValidationError(ValueError):
    """Rules that rows violate, with the number of rows for each."""

    def __init__(self, found: Mapping[str, int]):
        self.found = dict(found)
        super().__init__("; ".join(f"{k}: {v} rows" for k, v in found.items()))


def is_integer(text: Column) -> Column:
    """Digits only and within 64 bits. A bare cast is laxer: it takes blanks and signs."""
    return text.rlike(DIGITS) & text.try_cast("bigint").isNotNull()


def is_number(text: Column, positive: bool = False) -> Column:
    """Plain decimal syntax, finite and at least zero (or above it)."""
    value = text.try_cast("double")
    return text.rlike(NUMBER) & (F.abs(value) < float("inf")) & ((value > 0) if positive else (value >= 0))


def finite(x: Column) -> Column:
    return F.abs(x) < float("inf")


def ohlc_consistent() -> Column:
    return (F.col("low") <= F.least("open", "close")) & (F.greatest("open", "close") <= F.col("high"))


def candle_rules(step_ms: int, taker_tolerance: float = 0.0) -> dict[str, Column]:
    """What a valid candle satisfies; null counts as a violation unless the rule says otherwise."""
    rules = {
        "open time on its boundary": F.pmod(F.col("open_ms"), F.lit(step_ms)) == 0,
        "close time one millisecond before the end": F.col("close_ms") == F.col("open_ms") + step_ms - 1,
        "availability at the end": F.col("end_ms") == F.col("open_ms") + step_ms,
        "prices finite and positive": finite(F.col("open")) & finite(F.col("high")) & finite(F.col("low")) & finite(F.col("close")) & (F.least("open", "high", "low", "close") > 0),
        "volume finite and not negative": finite(F.col("volume")) & (F.col("volume") >= 0),
        "low <= open, close <= high": ohlc_consistent(),
        "trade count whole and not negative": F.col("trade_count").isNull() | ((F.col("trade_count") >= 0) & (F.col("trade_count") == F.floor("trade_count"))),
        "taker buy volume within the volume": F.col("taker_buy_base_volume").isNull() | ((F.col("taker_buy_base_volume") >= 0) & (F.col("taker_buy_base_volume") <= F.col("volume") + taker_tolerance)),
    }
    return rules


def key_rules(keys: Sequence[str]) -> dict[str, Column]:
    rules = {f"{k} not empty": F.col(k).isNotNull() & (F.trim(k) != "") for k in keys}
    if "product" in keys:
        rules["known market"] = F.col("product").isin(*MARKETS)
    return rules


def tick_order() -> list[order.Check]:
    """Ids strictly increasing and times not falling, in the source's order."""
    return [order.rising("ids strictly increasing", "tick_id"), order.not_falling("times not falling", "time_ms")]


def tick_rules() -> dict[str, Column]:
    """Domains of a tick's fields."""
    return {
        "first trade id at most the last": F.col("first_trade_id") <= F.col("last_trade_id"),
        "price finite and positive": finite(F.col("price")) & (F.col("price") > 0),
        "quantity finite and not negative": finite(F.col("quantity")) & (F.col("quantity") >= 0),
        "price times quantity finite": finite(F.col("price") * F.col("quantity")),
        "maker flag known": F.col("buyer_is_maker").isNotNull(),
        "time inside its day": F.col("time_ms").between(F.col("day_ms"), F.col("day_ms") + DAY_MS - 1),
    }


def tick_violations(ticks: DataFrame, keys: Sequence[str], source: Sequence[str], block: int = order.BLOCK) -> DataFrame:
    """(rule, violations) of ticks whose source order is given by columns, the last one a line number; across files and days."""
    return order.violations(ticks, keys, source, tick_order(), tick_rules(), block)


def violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) of every rule, from one pass."""
    counts = rows.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{i}") for i, ok in enumerate(rules.values())])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)])))


def require_none(counted: DataFrame) -> None:
    """Raises ValidationError if any rule of (rule, violations) has violations."""
    found = {r["rule"]: r["violations"] for r in counted.where("violations > 0").collect()}
    if found:
        raise ValidationError(found)


def require(rows: DataFrame, rules: Mapping[str, Column]) -> None:
    """Raises ValidationError if any rule has violations."""
    require_none(violations(rows, rules))


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing_times(candles: DataFrame, keys: Sequence[str], step_ms: int, at: str = "open_ms") -> DataFrame:
    """The times between each series' first and last that it has no candle for."""
    span = candles.groupBy(*keys).agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    expected = span.select(*keys, F.explode(F.sequence("lo", "hi", F.lit(step_ms).cast("long"))).alias(at))
    return expected.join(candles.select(*keys, at), [*keys, at], "left_anti")


def missing_keys(requested: Sequence[str], candles: DataFrame, key: str = "symbol") -> DataFrame:
    """Requested keys that the candles don't have."""
    asked = candles.sparkSession.createDataFrame([(x,) for x in requested], f"{key} string")
    return asked.join(candles.select(key).distinct(), key, "left_anti")


def series(candles: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candles.select(*keys).distinct()


def crowded_symbols(candles: DataFrame, keys: Sequence[str], symbol: str = "symbol") -> DataFrame:
    """Symbols with more than one series."""
    return series(candles, keys).groupBy(symbol).agg(F.count("*").alias("series")).where("series > 1")
