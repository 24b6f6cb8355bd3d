"""Strict YAML configuration of the feature run and of the extractor."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, date, datetime
from pathlib import Path

from wickworks.operators.candles import ARCHIVE_INTERVALS
from wickworks.operators.segments import POLICIES

try:
    import yaml
except ImportError:  # without PyYAML settings can still be given as mappings
    yaml = None


class ConfigError(ValueError):
    """A setting that isn't as it should be."""


@dataclass(frozen=True)
class FeatureConfig:
    input: str
    output: str
    symbols: tuple[str, ...] = ()
    gap_policy: str = "reset"


@dataclass(frozen=True)
class ExtractConfig:
    symbols: tuple[str, ...]
    interval: str
    start_date: date
    end_date: date
    output_format: str
    market: str = "um"
    datasets: tuple[str, ...] = ("klines",)
    raw_folder: str = "data/raw"
    preprocessed_folder: str = "data/pre_processed"
    download_workers: int = 4
    download_retries: int = 3
    trade_chunksize: int = 250_000
    base_url: str = ""


def load_yaml(path: str | Path) -> dict:
    """A YAML mapping; a key given twice is an error."""
    if yaml is None:
        raise ConfigError("PyYAML isn't installed")

    class Loader(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        keys = [loader.construct_object(k, deep=deep) for k, _ in node.value]
        twice = sorted({str(k) for k in keys if keys.count(k) > 1})
        if twice:
            raise ConfigError(f"given twice: {', '.join(twice)}")
        return yaml.SafeLoader.construct_mapping(loader, node, deep)

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    try:
        found = yaml.load(Path(path).read_text(encoding="utf-8"), Loader)  # noqa: S506
    except yaml.YAMLError as e:
        raise ConfigError(f"{path}: {e}") from e
    if not isinstance(found, dict) or not all(isinstance(k, str) for k in found):
        raise ConfigError(f"{path}: expected a mapping with text keys")
    return found


def _path(value, base: Path, name: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ConfigError(f"{name} must be a path")
    if "://" in value:
        return value
    p = Path(value).expanduser()
    return str((p if p.is_absolute() else base / p).resolve())


def feature_config(settings: dict, base: str | Path = ".") -> FeatureConfig:
    unknown = sorted(set(settings) - {"input", "output", "symbols", "gap_policy"})
    if unknown:
        raise ConfigError(f"unknown settings: {', '.join(unknown)}")
    symbols = settings.get("symbols") or []
    if not isinstance(symbols, list) or any(not isinstance(s, str) or not s.strip() for s in symbols):
        raise ConfigError("symbols must be a list of names")
    policy = settings.get("gap_policy", "reset")
    if policy not in POLICIES:
        raise ConfigError(f"gap_policy must be one of {', '.join(POLICIES)}")
    base = Path(base)
    return FeatureConfig(_path(settings.get("input"), base, "input"), _path(settings.get("output"), base, "output"), tuple(symbols), policy)


def pairs(settings: dict) -> tuple[str, ...]:
    """Full pairs of the one of coins, coin and symbol that is set; bare coins get the quote asset."""
    chosen = [k for k in ("coins", "coin", "symbol") if k in settings]
    if len(chosen) != 1:
        raise ConfigError("set one of coins, coin and symbol")
    values = settings[chosen[0]] if chosen[0] == "coins" else [settings[chosen[0]]]
    quote = settings.get("quote_asset", "USDT")
    quote = quote.strip().upper() if isinstance(quote, str) else ""
    if quote not in ("USDT", "USDC"):
        raise ConfigError("quote_asset must be USDT or USDC")
    if not isinstance(values, list) or not values:
        raise ConfigError("coins must be a list with at least one name")
    out: list[str] = []
    for v in values:
        if not isinstance(v, str) or not re.fullmatch("[A-Za-z0-9]+", v.strip()) or v.strip().upper() in ("USDT", "USDC"):
            raise ConfigError(f"not a coin or pair: {v!r}")
        v = v.strip().upper()
        v = v if v.endswith(("USDT", "USDC")) else v + quote
        if v in out:
            raise ConfigError(f"given twice: {v}")
        out.append(v)
    return tuple(out)


def extract_config(settings: dict, base: str | Path = ".", today: date | None = None) -> ExtractConfig:
    if settings.get("market") != "um":
        raise ConfigError("market must be um")
    symbols = pairs(settings)
    if settings.get("interval") not in ARCHIVE_INTERVALS:
        raise ConfigError(f"interval must be one of {', '.join(ARCHIVE_INTERVALS)}")
    if settings.get("output_format") not in ("csv", "parquet"):
        raise ConfigError("output_format must be csv or parquet")
    datasets = settings.get("datasets", ["klines"])
    if datasets not in (["klines"], ["klines", "aggTrades"], ["aggTrades", "klines"]):
        raise ConfigError("datasets must be [klines] or [klines, aggTrades]")
    if "aggTrades" in datasets and (settings["interval"], settings["output_format"]) != ("1h", "csv"):
        raise ConfigError("aggTrades need interval 1h and output_format csv")
    days = {}
    for name in ("start_date", "end_date"):
        try:
            days[name] = date.fromisoformat(str(settings[name]))
        except (KeyError, ValueError):
            raise ConfigError(f"{name} must be a date, YYYY-MM-DD") from None
    if days["start_date"] > days["end_date"]:
        raise ConfigError("start_date is after end_date")
    if days["end_date"] >= (today or datetime.now(UTC).date()):
        raise ConfigError("end_date must be before today, UTC")
    numbers = {}
    for name, default in (("download_workers", 4), ("download_retries", 3), ("trade_chunksize", 250_000)):
        value = settings.get(name, default)
        if type(value) is not int or value < 1 or name == "download_workers" and value > 4:
            raise ConfigError(f"{name} must be a whole number of at least 1" + " and at most 4" * (name == "download_workers"))
        numbers[name] = value
    folders = {k: _path(settings.get(k, d), Path(base), k) for k, d in (("raw_folder", "data/raw"), ("preprocessed_folder", "data/pre_processed"))}
    base_url = settings.get("base_url", "")
    if not isinstance(base_url, str) or base_url and not re.match("https?://", base_url):
        raise ConfigError("base_url must be an http address")
    return ExtractConfig(symbols, settings["interval"], days["start_date"], days["end_date"], settings["output_format"], datasets=tuple(datasets), base_url=base_url, **folders, **numbers)
