"""Daily ZIP archives of candles and trades as DataFrames: one row a CSV line, cells as text, with its file and line number.

Archives are read as binary files, so any store that Spark reads will do, and unpacked in Arrow batches of BATCH lines by the task that
has the file. Structure is checked there (members, header, number of cells); values are checked by the validators afterwards.
"""

from __future__ import annotations

import csv
import io
import re
import shutil
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.operators import candles as cd
from wickworks.operators import order, ticks, validate

BATCH = 65_536
# Columns of the sources, and the names that a header may use for each candle column.
KLINE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore")
TRADES = ("agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time", "is_buyer_maker")
KLINE_ALIASES = (
    {"opentime"}, {"open"}, {"high"}, {"low"}, {"close"}, {"volume"}, {"closetime"}, {"quotevolume", "quoteassetvolume"}, {"count", "tradecount", "numberoftrades"},
    {"takerbuyvolume", "takerbuybasevolume", "takerbuybaseassetvolume"}, {"takerbuyquotevolume", "takerbuyquoteassetvolume"}, {"ignore"},
)
FILE_NAME = r"([A-Za-z0-9_]+)-([A-Za-z0-9]+)-([0-9]{4}-[0-9]{2}-[0-9]{2})\.[A-Za-z]+$"
OUTPUT_OF = {"count": "trade_count", "taker_buy_volume": "taker_buy_base_volume", "ignore": "kline_ignore"}


def _is_header(cells: Sequence[str], columns: Sequence[str], mode: str, path: str) -> bool:
    """Whether a first line is a header; one that looks like a header and isn't the right one is an error."""
    first = cells[0].strip().lower() if cells else ""
    if mode == "aliases":
        if re.fullmatch("[0-9]+", first):
            return False
        names = [re.sub("[ _]", "", c.strip().lower()) for c in cells]
        if len(names) != len(KLINE_ALIASES) or any(n not in a for n, a in zip(names, KLINE_ALIASES, strict=True)):
            raise ValueError(f"{path}: unexpected header")
        return True
    if first != columns[0]:
        return False
    if mode == "exact" and [c.strip().lower() for c in cells] != list(columns):
        raise ValueError(f"{path}: unexpected header")
    return True


def member_fault(archive: zipfile.ZipFile, expected: str) -> str | None:
    """What keeps an archive's directory from being that of one plain file of the expected name, before anything is unpacked."""
    members = archive.infolist()
    if len(members) != 1:
        return f"{len(members)} members"
    m = members[0]
    if m.is_dir():
        return "a folder"
    if m.external_attr >> 16 & 0o170000 == 0o120000:
        return "a symbolic link"
    if m.flag_bits & 1:
        return "encrypted"
    if m.filename != expected:
        return "another name"
    return None if m.file_size else "empty"


def faults(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, fault) of archives, checked by the tasks that read them; fault is null for a sound one."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(paths if isinstance(paths, str) else list(paths))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, found = [p.as_py().rsplit("/", 1)[-1] for p in b.column("path")], []
            for name, content in zip(names, b.column("content"), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                        found.append(member_fault(archive, name.rsplit(".", 1)[0] + ".csv"))
                except (zipfile.BadZipFile, EOFError):
                    found.append("no archive")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.string())], ["file", "fault"])

    return files.select("path", "content").mapInArrow(check, "file string, fault string")


def _lines(path: str, content: bytes, columns: Sequence[str], header: str, exact_member: bool) -> Iterator[tuple[int, list[str]]]:
    stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        if exact_member:
            members, fault = archive.infolist(), member_fault(archive, f"{stem}.csv")
        else:
            members = [m for m in archive.infolist() if not m.is_dir() and m.filename.lower().endswith(".csv")]
            fault = None if len(members) == 1 and not members[0].flag_bits & 1 else f"{len(members)} members"
        if fault:
            raise ValueError(f"{path}: expected one plain member {stem}.csv, found {fault}")
        with archive.open(members[0]) as raw:
            n = 0
            for n, cells in enumerate(csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline="")), 1):
                if not cells and not exact_member or n == 1 and _is_header(cells, columns, header, path):
                    continue
                if len(cells) != len(columns):
                    raise ValueError(f"{path}, line {n}: expected {len(columns)} cells, found {len(cells)}")
                yield n, [c.strip() for c in cells]
            if not n:
                raise ValueError(f"{path}: the archive's CSV is empty")


def read(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], header: str = "exact", exact_member: bool = True) -> DataFrame:
    """(file, line, columns as text) of ZIP archives. header: aliases, exact, or first (only the first cell decides)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(paths if isinstance(paths, str) else list(paths))
    return unpacked(files, columns, header, exact_member)


def unpacked(files: DataFrame, columns: Sequence[str], header: str = "exact", exact_member: bool = True) -> DataFrame:
    """read() of archives that are rows of a table: (path, content)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "line", *columns]

        def batch(path: str, rows: list[tuple[int, list[str]]]) -> pa.RecordBatch:
            cells = list(zip(*(r[1] for r in rows), strict=True))
            return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array([r[0] for r in rows], pa.int64()), *[pa.array(c, pa.string()) for c in cells]], names)

        for b in batches:
            for path, content in zip(b.column("path"), b.column("content"), strict=True):
                rows = []
                for row in _lines(path.as_py(), content.as_py(), columns, header, exact_member):
                    rows.append(row)
                    if len(rows) == BATCH:
                        yield batch(path.as_py(), rows)
                        rows = []
                if rows:
                    yield batch(path.as_py(), rows)

    return files.select("path", "content").mapInArrow(unpack, "file string, line long, " + ", ".join(f"`{c}` string" for c in columns))


def sources(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, bytes, sha256) of archives."""
    return spark.read.format("binaryFile").load(list(paths)).select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def unpack(spark: SparkSession, path: str) -> str:
    """Writes an archive's CSV beside it, byte for byte and in blocks, and returns its path."""
    from wickworks.sinks.publish import Store

    target = path.rsplit(".", 1)[0] + ".csv"
    store = Store(spark, target)
    with tempfile.TemporaryDirectory() as here:
        store.fetch(path, f"{here}/archive.zip")
        with zipfile.ZipFile(f"{here}/archive.zip") as archive:
            members = [m for m in archive.infolist() if not m.is_dir()]
            if len(members) != 1:
                raise ValueError(f"{path}: expected one member")
            with archive.open(members[0]) as source, open(f"{here}/member.csv", "wb") as out:
                shutil.copyfileobj(source, out, 1 << 20)
        store.write_file(target, f"{here}/member.csv")
    return target


def daily_paths(folder: str, symbol: str, kind: str, start: date, end: date) -> list[str]:
    """The archives of each day from start to end, both in."""
    return [f"{folder.rstrip('/')}/{symbol}-{kind}-{start + timedelta(days=i)}.zip" for i in range((end - start).days + 1)]


def _day_ms(file):
    return cd.epoch_ms(F.to_date(F.regexp_extract(file, FILE_NAME, 3)).cast("timestamp_ntz"))


def klines(lines: DataFrame, market: str, symbol: str, interval: str, taker_tolerance: float = 0.0, complete: bool = True) -> DataFrame:
    """Checked candles of kline lines: typed columns, and the decimal text of numbers in raw_*. A violated rule fails the run."""
    step = cd.interval_ms(interval)
    if cd.DAY_MS % step:
        raise ValueError(f"a day has no whole number of {interval} candles")
    numbers = [c for c in KLINE if c not in ("open_time", "close_time", "count")]
    texts = {f"{c}: whole number": validate.is_integer(F.col(c)) for c in ("open_time", "close_time", "count")}
    texts |= {f"{c}: finite number": validate.is_number(F.col(c), positive=c in ("open", "high", "low", "close")) for c in numbers}
    validate.require(lines, texts)
    typed = lines.select(
        "file", "line", F.lit(market).alias("market"), F.lit(symbol).alias("symbol"), F.lit(interval).alias("interval"), _day_ms(F.col("file")).alias("day_ms"),
        F.col("open_time").cast("long").alias("open_ms"), F.col("close_time").cast("long").alias("close_ms"), (F.col("open_time").cast("long") + step).alias("end_ms"),
        *[F.col(c).cast("double").alias(OUTPUT_OF.get(c, c)) for c in numbers], F.col("count").cast("long").alias("trade_count"), *[F.col(c).alias(f"raw_{OUTPUT_OF.get(c, c)}") for c in numbers],
    )
    exact = F.col("raw_taker_buy_base_volume").cast("decimal(38,18)") <= F.col("raw_volume").cast("decimal(38,18)") if not taker_tolerance else F.lit(True)
    rules = validate.candle_rules(step, taker_tolerance) | {
        "open time inside its day": F.col("open_ms").between(F.col("day_ms"), F.col("day_ms") + cd.DAY_MS - 1),
        "taker buy quote volume within the quote volume": F.col("taker_buy_quote_volume") <= F.col("quote_volume") + taker_tolerance,
        "taker buy volume within the volume, exactly": exact,
    }
    validate.require_none(order.violations(typed, ["file"], ["line"], [order.rising("times strictly increasing", "open_ms")], rules))
    if complete:
        days = typed.groupBy("file").agg(F.count("*").alias("n")).where(F.col("n") != cd.DAY_MS // step)
        validate.require(days, {f"{cd.DAY_MS // step} candles a day": F.lit(False)})
    return typed


def candles_of(checked: DataFrame) -> DataFrame:
    """The 16 candle columns of checked klines."""
    ts = lambda c: F.timestamp_millis(c)
    times = {"open_time": ts("open_ms"), "close_time": ts("close_ms"), "feature_available_at": ts("end_ms")}
    return checked.select(*[times[f.name].alias(f.name) if f.name in times else F.col(f.name).cast(f.dataType).alias(f.name) for f in cd.CANDLE_SCHEMA])


def candles_text(checked: DataFrame) -> DataFrame:
    """The same as text for CSV: ISO times, numbers as the source wrote them."""
    times = {"open_time": "open_ms", "close_time": "close_ms", "feature_available_at": "end_ms"}
    pick = lambda n: cd.utc_text(F.col(times[n])) if n in times else F.col(f"raw_{n}") if f"raw_{n}" in checked.columns else F.col(n).cast("string")
    return checked.select(*[pick(n).alias(n) for n in cd.EXTRACTOR_COLUMNS])


def trades(lines: DataFrame, symbol: str) -> DataFrame:
    """Checked ticks of aggTrades lines, in the order of days and lines."""
    whole = ("agg_trade_id", "first_trade_id", "last_trade_id", "transact_time")
    maker = F.lower("is_buyer_maker")
    texts = {f"{c}: whole number": validate.is_integer(F.col(c)) for c in whole} | {"is_buyer_maker: true or false": maker.isin("true", "false")}
    validate.require(lines, texts)
    typed = lines.select(
        F.lit(symbol).alias("symbol"), "file", "line", _day_ms(F.col("file")).alias("day_ms"), F.col("agg_trade_id").cast("long").alias("tick_id"), F.col("transact_time").cast("long").alias("time_ms"),
        F.col("price").try_cast("double").alias("price"), F.col("quantity").try_cast("double").alias("quantity"), F.col("first_trade_id").cast("long").alias("first_trade_id"), F.col("last_trade_id").cast("long").alias("last_trade_id"), (maker == "true").alias("buyer_is_maker"),
    )
    validate.require_none(validate.tick_violations(typed, ["symbol"], ["day_ms", "line"]))
    return typed


def combined(spark: SparkSession, kline_paths: Sequence[str], trade_paths: Sequence[str], market: str, symbol: str) -> DataFrame:
    """Hourly candles with their trades' aggregates, differences and match flags."""
    checked = klines(read(spark, kline_paths, KLINE, "exact"), market, symbol, "1h", taker_tolerance=ticks.ABSOLUTE)
    found = trades(read(spark, trade_paths, TRADES, "exact"), symbol)
    return ticks.reconcile(checked, ticks.aggregate(found, ["symbol"], cd.interval_ms("1h")), ["symbol"])
