"""Daily enriched CSV files and their yearly merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickworks.operators import candles as cd
from wickworks.sinks.publish import Store, many_files, parquet
from wickworks.sources import archives

_NAME = r"([A-Za-z0-9_]+)-([A-Za-z0-9]+)-([0-9]{4})-([0-9]{2})-([0-9]{2})\.csv"


def enrich(lines: DataFrame) -> DataFrame:
    """Kline lines with date, coin and interval from the file's name, and times as HH:MM:SS.mmmZ."""
    part = lambda i: F.regexp_extract("file", archives.FILE_NAME, i)
    time = lambda c: F.substring(cd.utc_text(F.floor(F.col(c).cast("double")).cast("long")), 12, 13)
    cells = [time(c).alias(c) if c in ("open_time", "close_time") else F.col(c) for c in archives.KLINE]
    return lines.select("file", "line", part(3).alias("date"), part(1).alias("coin"), part(2).alias("interval"), *cells)


def daily_csv(spark: SparkSession, source: str, target: str, mode: str = "ignore") -> list[str]:
    """One CSV of date, coin, interval and the archive's columns for each archive under source, by one job; files that are there stay
    unless mode is overwrite."""
    enriched = enrich(archives.read(spark, source, archives.KLINE, "first", exact_member=False))
    named = enriched.withColumn("__file", F.concat(F.regexp_extract("file", r"([^/]+)\.[^./]*$", 1), F.lit(".csv"))).drop("file")
    return many_files(named, "__file", target, ["line"], mode, hidden=["line"])


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file, file_coin, file_interval, file_year, header) of the CSV files under a folder that have a byte at least.

    The executors read the first lines. Names are trimmed; a header is one line.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
    lines = spark.read.options(**options).text(folder).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    first = lines.where("at = 0").groupBy("path").agg(F.min_by("value", "n").alias("value"))
    names = F.transform(F.split(F.regexp_replace("value", "^\ufeff|\r$|\"", ""), ","), lambda c: F.trim(c))
    found = first.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.array_join(names, ",").alias("header"))
    return found.select("path", "file", *[F.regexp_extract("file", _NAME, i).alias(a) for i, a in ((1, "file_coin"), (2, "file_interval"), (3, "file_year"))], "header")


def by_header(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The daily files' cells as text, a table for each header, with the file's group and the line's place (__path, __block, __line).

    A file without a header, and one whose header isn't that of its (coin, interval, year)'s first file, fail the run.
    """
    found = headers(spark, folder)
    empty = [name for name, size in Store(spark, folder).files(folder, ".csv") if not size] or [r["file"] for r in found.where("header = ''").limit(3).collect()]
    if empty:
        raise ValueError(f"no header: {empty}")
    group = Window.partitionBy("file_coin", "file_interval", "file_year").orderBy("path")
    odd = [r["file"] for r in found.withColumn("first", F.first("header").over(group)).where("header <> first").orderBy("path").limit(3).collect()]
    if odd:
        raise ValueError(f"columns do not match in {odd}")
    out = []
    for r in found.groupBy("header").agg(F.collect_list("path").alias("paths")).orderBy("header").collect():  # as many paths as the listing has
        columns = r["header"].split(",")
        if len(set(columns)) != len(columns):
            raise ValueError(f"a column comes twice: {r['header']}")
        raw = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).option("header", "true").option("escape", '"').csv(r["paths"])
        name = F.col("_metadata.file_name")
        group = [F.regexp_extract(name, _NAME, i).alias(a) for i, a in ((1, "file_coin"), (2, "file_interval"), (3, "file_year"))]
        out.append(raw.select("*", *group, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__line")))
    return out


def read_daily(spark: SparkSession, folder: str) -> DataFrame:
    """All daily CSV files with their (coin, interval, year) from the name, cells as text; columns that a file hasn't are null."""
    first, *others = by_header(spark, folder)
    for more in others:
        first = first.unionByName(more, allowMissingColumns=True)
    return first.drop("__path", "__block", "__line")


_NUMBERS = ("open", "high", "low", "close", "volume", "quote_volume", "taker_buy_volume", "taker_buy_quote_volume", "ignore")
_GROUP = ("file_coin", "file_interval", "file_year")


def _typed(daily: DataFrame) -> DataFrame:
    typed = {c: F.col(c).cast("double") for c in _NUMBERS if c in daily.columns} | {"count": F.col("count").cast("long"), "date": F.to_date("date")}
    return daily.withColumns({k: v for k, v in typed.items() if k in daily.columns})


def yearly(spark: SparkSession, folder: str) -> DataFrame:
    """All daily rows with typed numbers, the date as a date, by (coin, interval, year), date and open time."""
    return _typed(read_daily(spark, folder)).orderBy(*_GROUP, "date", "open_time")


def merge_parquet(spark: SparkSession, folder: str, target: str) -> None:
    """Yearly Parquet, partitioned by coin, interval and year and sorted inside."""
    yearly(spark, folder).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "date", "open_time").write.mode("overwrite").partitionBy(*_GROUP).parquet(target)


def merge_csv(spark: SparkSession, folder: str, target: str, mode: str = "overwrite") -> list[str]:
    """One CSV a (coin, interval, year): the files' header and their lines in the order of paths, values untouched. Yearly files that are
    there stay under mode ignore."""
    place = ["__path", "__block", "__line"]
    name = F.concat(F.concat_ws("-", *_GROUP), F.lit(".csv"))
    written = [n for rows in by_header(spark, folder) for n in many_files(rows.withColumn("__file", name).drop(*_GROUP), "__file", target, place, mode, hidden=place)]
    return sorted(written)


def merge_years(spark: SparkSession, folder: str, target: str, mode: str = "ignore") -> list[str]:
    """One typed Parquet file a (coin, interval, year), with the daily files' columns, by date and open time. Files that are there stay under
    mode ignore; each is published with its own commit."""
    written, store = [], Store(spark, target)
    for rows in by_header(spark, folder):
        typed = _typed(rows.drop("__path", "__block", "__line"))
        for r in typed.select(*_GROUP).distinct().orderBy(*_GROUP).collect():  # a file each
            name = "-".join(r) + ".parquet"
            mine = typed.where((F.col("file_coin") == r[0]) & (F.col("file_interval") == r[1]) & (F.col("file_year") == r[2])).drop(*_GROUP)
            if mode == "overwrite" or not store.exists(f"{target}/{name}"):
                parquet(mine, f"{target}/{name}", ["date", "open_time"], mode)
            written.append(name)
    return sorted(written)


def merge_xlsx(spark: SparkSession, folder: str, target: str) -> int:
    """One workbook of all daily rows in yearly order, streamed to the driver; needs openpyxl. Returns the number of rows."""
    try:
        from openpyxl import Workbook
    except ImportError as e:
        raise RuntimeError("Excel output needs openpyxl") from e
    rows = yearly(spark, folder).drop("file_coin", "file_interval", "file_year")
    book = Workbook(write_only=True)
    sheet = book.create_sheet("candles")
    sheet.append(rows.columns)
    n = 0
    for n, r in enumerate(rows.toLocalIterator(prefetchPartitions=True), 1):
        sheet.append(list(r))
    book.save(target)
    return n
