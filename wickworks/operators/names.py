"""Names: normal form, field aliases, series ids and safe output file names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names that generic files use for a field.
ALIASES = {
    "open": ("open",), "high": ("high",), "low": ("low",), "close": ("close",),
    "volume": ("volume", "base_volume", "base_asset_volume"),
    "trade_count": ("trade_count", "number_of_trades", "trades"),
    "taker_buy_base_volume": ("taker_buy_base_volume", "taker_buy_base_asset_volume"),
}
TIMES = ("timestamp", "datetime", "date", "time", "open_time", "close_time")
REQUIRED = ("open", "high", "low", "close", "volume")
INSTRUMENTS = ("symbol", "ticker", "asset")


def normal(name: Column) -> Column:
    """Trimmed, in small letters, blanks and hyphens as one underscore."""
    return F.lower(F.regexp_replace(F.trim(name), r"[\s-]+", "_"))


def normal_text(name: str) -> str:
    return re.sub(r"[\s-]+", "_", name.strip()).lower()


def resolve(columns: Sequence[str]) -> dict[str, str]:
    """Field to column by alias; two columns for a field, or a required field without one, are errors."""
    normal_names = [normal_text(c) for c in columns]
    if len(set(normal_names)) != len(normal_names):
        raise ValueError("columns that are several columns for one name after trimming, case and blanks")
    out = {}
    for field, names in ALIASES.items():
        found = [c for c in columns if normal_text(c) in names]
        if len(found) > 1:
            raise ValueError(f"several columns for {field}: {found}")
        if found:
            out[field] = found[0]
        elif field in REQUIRED:
            raise ValueError(f"no column for {field}")
    return out


def json_text(text: Column) -> Column:
    """A text as a JSON string of printable ASCII: other characters are the \\uXXXX of their UTF-16 units, line ends and the like in short."""
    short = {"0008": "\\b", "0009": "\\t", "000A": "\\n", "000C": "\\f", "000D": "\\r", "0022": '\\"', "005C": "\\\\"}
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("[0-9A-F]{4}"), F.lit(0))

    def one(u: Column) -> Column:
        out = F.when(u.between("0020", "007E"), F.chr(F.conv(u, 16, 10).cast("int"))).otherwise(F.concat(F.lit("\\u"), F.lower(u)))
        for code, escape in short.items():
            out = F.when(u == code, F.lit(escape)).otherwise(out)
        return out

    plain = text.rlike(r"^[ !#-\[\]-~]*$")
    return F.concat(F.lit('"'), F.when(plain, text).otherwise(F.array_join(F.transform(units, one), "")), F.lit('"'))


def series_id(*keys: Column) -> Column:
    """First 24 hex digits of the SHA-256 of the keys as a JSON list of ASCII strings, whatever characters they have."""
    return F.substring(F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *[json_text(k) for k in keys]), F.lit("]")), 256), 1, 24)


def file_names(symbols: DataFrame, symbol: str = "symbol") -> DataFrame:
    """(symbol, file): plain ASCII symbols of at most 64 characters keep their name, others take a hash of it; names that differ only
    by case take the hash as a suffix."""
    s = F.col(symbol)
    plain = s.rlike("^[A-Za-z0-9][A-Za-z0-9_-]{0,63}$")
    stem = F.when(plain, s).otherwise(F.concat(F.lit("symbol-"), F.sha2(s, 256)))
    named = symbols.select(symbol).distinct().withColumn("__stem", stem)
    same = F.count("*").over(Window.partitionBy(F.lower("__stem")))
    final = F.when(same > 1, F.concat("__stem", F.lit("-"), F.sha2(s, 256))).otherwise(F.col("__stem"))
    return named.select(symbol, F.concat(final, F.lit("-features.parquet")).alias("file"))
