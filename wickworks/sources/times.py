"""Times of generic files in milliseconds: whole-number units, local times of a zone, and texts with an offset. Nothing is guessed.

A local time is an instant if it is one at exactly one of the zone's offsets around it. Both are tried by a round trip: the offset a day
and more before, and the one a day and more after. A time that no offset gives (clocks went forward) or two do (clocks went back) is a
violation, as is a missing one. Zones with two changes of offset within two days are beyond this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickworks.operators import candles as cd

UNITS = {"s": 1000, "ms": 1, "us": 1000, "ns": 1_000_000}
OFFSET = r"(Z|z|[+-][0-9]{2}:?[0-9]{2})\s*$"
NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_REACH = 26 * 3_600_000


def from_number(value: Column, unit: str) -> Column:
    """Whole milliseconds, rounded down, of a number of units; whole numbers never go through a double."""
    if unit not in UNITS:
        raise ValueError("numeric times need a unit: s, ms, us or ns")
    exact = value.cast("decimal(30,9)")
    return F.floor(exact * F.lit(UNITS[unit]).cast("decimal(4,0)")).cast("long") if unit in ("s", "ms") else F.floor(exact / F.lit(UNITS[unit]).cast("decimal(7,0)")).cast("long")


def offset_ms(utc_ms: Column, zone: str) -> Column:
    """A zone's offset at an instant."""
    at = F.timestamp_millis(utc_ms)
    return F.unix_millis(F.from_utc_timestamp(at, zone)) - utc_ms


def instants(local_ms: Column, zone: str) -> Column:
    """The instants, 0 to 2 of them, that a zone's clocks show as a local time, given in milliseconds as if it were UTC."""
    tried = F.array(*(local_ms - offset_ms(local_ms + reach, zone) for reach in (-_REACH, _REACH)))
    return F.filter(F.array_distinct(tried), lambda u: u + offset_ms(u, zone) == local_ms)


def parse(raw: DataFrame, column: str, unit: str | None, zone: str | None) -> tuple[Column, dict[str, Column]]:
    """time_ms of a column, and the rules that its rows must meet. Raises where the column's kind needs a unit or a zone that isn't given."""
    kind, t = dict(raw.dtypes)[column], F.col(f"`{column}`")
    given = {"time given": t.isNotNull()}
    if kind == "string":
        text = F.trim(t)
        seen = raw.agg(
            F.count_if(text.rlike(NUMBER)).alias("numbers"), F.count_if(text.rlike(OFFSET) & ~text.rlike(NUMBER)).alias("aware"), F.count("*").alias("rows"),
            F.count_distinct(F.when(~text.rlike(NUMBER), F.regexp_extract(text, OFFSET, 1))).alias("offsets"),
        ).first()
        if unit or seen["numbers"] == seen["rows"]:
            return from_number(text.try_cast("decimal(30,9)"), unit or ""), given | {"time is a number": text.try_cast("decimal(30,9)").isNotNull()}
        if seen["aware"]:
            if seen["offsets"] > 1:
                raise ValueError("times with several offsets, or some without one")
            ms = F.unix_millis(text.try_cast("timestamp"))
            return ms, given | {"time readable": ms.isNotNull()}
        local = text.try_cast("timestamp_ntz")
        given["time readable"] = local.isNotNull()
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return from_number(t, unit or ""), given
    elif kind == "timestamp":
        return F.unix_millis(t), given
    else:
        local = t.cast("timestamp_ntz")
    if not zone:
        raise ValueError("times without a zone need one")
    if zone == "UTC":
        return cd.epoch_ms(local), given
    found = instants(cd.epoch_ms(local), zone)
    return F.get(found, F.lit(0)), given | {"local time exists": F.coalesce(F.size(found) > 0, F.lit(False)), "local time not ambiguous": F.coalesce(F.size(found) < 2, F.lit(False))}
