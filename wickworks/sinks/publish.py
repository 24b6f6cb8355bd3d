"""Publishing: everything is written to a staging folder beside the target and renamed when it is whole.

A commit is a journal, then renames and texts, then the journal's removal. A driver that dies before the journal is there leaves the old
files as they were; one that dies after it leaves all that recover() needs to finish, as each of its steps can be done again. Each
publisher recovers its own target first. Staging folders that no journal names are left to recover().
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickworks.operators import names


CSV_AS_IS = {"header": "true", "emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: Rows of a Parquet row group at most.
ROW_GROUP = 32_768
PARQUET = {"compression": "zstd", "parquet.block.row.count.limit": str(ROW_GROUP)}


def _json(value) -> str:
    return json.dumps(value, indent=2, allow_nan=False) + "\n"


class Store:
    """The few calls of Hadoop's file system that publishing needs, on whatever store a path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self.at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.at(path))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self.at(path))

    def rename(self, a: str, b: str) -> None:
        if not self._fs.rename(self.at(a), self.at(b)):
            raise OSError(f"can't rename {a} to {b}")

    def delete(self, path: str) -> None:
        self._fs.delete(self.at(path), True)

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self.at(folder))]

    def files(self, folder: str, suffix: str) -> list[tuple[str, int]]:
        """(name, bytes) of the files under a folder, at any depth."""
        found, it = [], self._fs.listFiles(self.at(folder), True)
        while it.hasNext():
            s = it.next()
            if s.getPath().getName().endswith(suffix):
                found.append((s.getPath().getName(), s.getLen()))
        return found

    def write_text(self, path: str, text: str) -> None:
        """Through a temporary name, so that a reader never sees half a file."""
        part = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self.at(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.exists(path):
            self.delete(path)
        self.rename(part, path)

    def write_file(self, path: str, source: str) -> None:
        """A file of this machine, through a temporary name."""
        part = f"{path}.{uuid.uuid4().hex}.tmp"
        self.make(path.rsplit("/", 1)[0])
        self._fs.copyFromLocalFile(False, True, self.at(source), self.at(part))
        if self.exists(path):
            self.delete(path)
        self.rename(part, path)

    def fetch(self, path: str, target: str) -> None:
        """A copy on this machine."""
        self._fs.copyToLocalFile(False, self.at(path), self.at(target), True)

    def write_json(self, path: str, value) -> None:
        self.write_text(path, _json(value))

    def read_text(self, path: str) -> str:
        """A small file of UTF-8."""
        stream = self._fs.open(self.at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def journal_of(target: str) -> str:
    return f"{target.rstrip('/')}.journal"


def _finish(store: Store, journal: str) -> None:
    """Does what is left of a journal's steps. Each step is a no-op once done, so any number of attempts may be cut off."""
    plan = json.loads(store.read_text(journal))
    for folder in plan["folders"]:
        store.make(folder)
    for source, target in plan["moves"]:
        if store.exists(source):
            if store.exists(target):
                store.delete(target)
            store.rename(source, target)
    for path, text in plan["texts"]:
        store.write_text(path, text)
    if store.exists(plan["staging"]):
        store.delete(plan["staging"])
    store.delete(journal)


def commit(store: Store, target: str, staging: str, moves: Sequence[tuple[str, str]], texts: Sequence[tuple[str, str]] = (), folders: Sequence[str] = ()) -> None:
    """Renames staged files to their targets and writes texts, all of it or, if cut off, all of it by recover()."""
    store.write_text(journal_of(target), json.dumps({"staging": staging, "moves": list(moves), "texts": list(texts), "folders": list(folders)}))
    _finish(store, journal_of(target))


def recover(spark: SparkSession, target: str) -> str:
    """What a run on target left: finishes a commit that was cut off ("completed"), clears staged files that were never committed
    ("cleared"), or finds "nothing". Not while a run on target is under way."""
    store = Store(spark, target)
    if store.exists(journal_of(target)):
        _finish(store, journal_of(target))
        return "completed"
    folder, name = target.rstrip("/").rsplit("/", 1)
    left = [n for n in (store.names(folder) if store.exists(folder) else []) if n.startswith(f"{name}.staging-")]
    for n in left:
        store.delete(f"{folder}/{n}")
    summary = f"{target.rstrip('/')}/summary.json"
    if left and store.exists(summary) and (said := json.loads(store.read_text(summary))).get("status") == "running":
        store.write_json(summary, said | {"status": "interrupted"})
    return "cleared" if left else "nothing"


def _one_file(df: DataFrame, order: Sequence[str], target: str, mode: str, report, write) -> bool:
    store = Store(df.sparkSession, target)
    if mode not in ("error", "ignore", "overwrite"):
        raise ValueError("mode is error, ignore or overwrite")
    if store.exists(journal_of(target)):
        recover(df.sparkSession, target)
    if store.exists(target) and mode != "overwrite":
        if mode == "ignore":
            return False
        raise FileExistsError(target)
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    try:
        write(df.repartition(1).sortWithinPartitions(*order), staging)
        part = next(n for n in store.names(staging) if n.startswith("part-"))
        texts = [] if report is None else [(target.rsplit(".", 1)[0] + ".validation.json", _json(report))]
    except BaseException:
        store.delete(staging)
        raise
    commit(store, target, staging, [(f"{staging}/{part}", target)], texts)
    return True


def many_files(df: DataFrame, name: str, folder: str, order: Sequence[str], mode: str = "overwrite", hidden: Sequence[str] = ()) -> list[str]:
    """One CSV file with a header for each value of the column name, ordered, all from one job; returns the names, sorted.

    Files that are there stay under mode ignore. Each file's rows are one task's, whatever the number of files. hidden columns only order
    the rows and aren't written; cells are written as they are, blanks included.
    """
    store = Store(df.sparkSession, folder)
    if store.exists(journal_of(folder)):
        recover(df.sparkSession, folder)
    wanted = sorted(r[0] for r in df.select(name).distinct().collect())
    if mode == "error" and (there := [n for n in wanted if store.exists(f"{folder}/{n}")]):
        raise FileExistsError(f"{folder}/{there[0]}")
    new = [n for n in wanted if mode == "overwrite" or not store.exists(f"{folder}/{n}")]
    if not new:
        return wanted
    staging = f"{folder.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        rows = df if len(new) == len(wanted) else df.where(F.col(name).isin(new))
        # A name that can't be null keeps the writer from sorting again by name alone.
        rows = rows.withColumn(name, F.coalesce(name, F.lit(""))).repartition(name).sortWithinPartitions(name, *order).drop(*hidden)
        rows.write.options(**CSV_AS_IS).partitionBy(name).csv(staging)
        moves = []
        for n in new:
            (part,) = [x for x in store.names(f"{staging}/{name}={n}") if x.startswith("part-")]
            moves.append((f"{staging}/{name}={n}/{part}", f"{folder}/{n}"))
    except BaseException:
        store.delete(staging)
        raise
    commit(store, folder, staging, moves, folders=[folder])
    return wanted


def candles_parquet(df: DataFrame, target: str, mode: str = "error", report=None) -> bool:
    """One zstd Parquet file of candles by open time; False if the target was there and mode is ignore."""
    return parquet(df, target, ["open_time"], mode, report)


def parquet(df: DataFrame, target: str, order: Sequence[str], mode: str = "error", report=None) -> bool:
    """One zstd Parquet file, ordered."""
    return _one_file(df, order, target, mode, report, lambda d, at: d.write.options(**PARQUET).parquet(at))


def text_csv(df: DataFrame, target: str, order: Sequence[str], mode: str = "error", report=None) -> bool:
    """One CSV file with a header, ordered."""
    return _one_file(df, order, target, mode, report, lambda d, at: d.write.options(**CSV_AS_IS).csv(at))


def shards(df: DataFrame, shard_ms: int | None) -> DataFrame:
    """(symbol, __shard, __file): a symbol's file name; with spans of shard_ms, a numbered file for each span that has rows, in order."""
    span = F.floor(F.unix_millis("candle_end_utc") / shard_ms) if shard_ms else F.lit(0).cast("long")
    found = df.select("symbol", span.alias("__shard")).distinct().join(names.file_names(df), "symbol")
    number = F.row_number().over(Window.partitionBy("symbol").orderBy("__shard"))
    many = F.count("*").over(Window.partitionBy("symbol")) > 1
    return found.select("symbol", "__shard", F.when(many, F.format_string("%s-%05d.parquet", F.regexp_replace("file", "[.]parquet$", ""), number)).otherwise(F.col("file")).alias("__file"))


def features(df: DataFrame, folder: str, summary: dict | Callable[[DataFrame], dict], shard_ms: int | None = None) -> list[str]:
    """One zstd Parquet file a symbol, with candle_end_utc, symbol and the features, and summary.json; the folder must be new.

    All symbols are written by one job into a staging folder beside it, in row groups of at most ROW_GROUP rows; a symbol whose history is
    too long for one task is split by shard_ms into numbered files that follow one another. summary may be a function of the staged rows, so
    that df is computed once. The summary says running, and complete only with the renames; failed or interrupted if they never began.
    """
    spark = df.sparkSession
    store = Store(spark, folder)
    folder = folder.rstrip("/")
    if store.exists(journal_of(folder)):
        recover(spark, folder)
    if store.exists(folder):
        raise FileExistsError(f"the output folder must be new: {folder}")
    store.make(folder)
    staging = f"{folder}.staging-{uuid.uuid4().hex}"
    head = summary if isinstance(summary, dict) else {}
    store.write_json(f"{folder}/summary.json", head | {"status": "running"})
    columns = [c for c in df.columns if c not in ("candle_end_utc", "symbol")]
    try:
        # The rows once, by symbol and span; the names of files follow from what is there.
        span = F.floor(F.unix_millis("candle_end_utc") / shard_ms) if shard_ms else F.lit(0).cast("long")
        keyed = df.select("candle_end_utc", "symbol", *columns, F.concat_ws("-", F.sha2("symbol", 256), span.cast("string")).alias("__key"))
        keyed.withColumn("__key", F.coalesce("__key", F.lit(""))).repartition("__key").sortWithinPartitions("__key", "candle_end_utc").write.options(**PARQUET).partitionBy("__key").parquet(staging)
        staged = spark.read.parquet(staging)
        if not isinstance(summary, dict):
            head = summary(staged.drop("__key"))
        found = shards(staged, shard_ms).withColumn("__key", F.concat_ws("-", F.sha2("symbol", 256), F.col("__shard").cast("string"))).collect()
        moves = []
        for r in sorted(found, key=lambda r: r["__file"]):
            parts = [n for n in store.names(f"{staging}/__key={r['__key']}") if n.startswith("part-")]
            if len(parts) != 1:
                raise OSError(f"{r['symbol']}: {len(parts)} files")
            moves.append((f"{staging}/__key={r['__key']}/{parts[0]}", f"{folder}/{r['__file']}"))
        files = sorted(r["__file"] for r in found)
    except BaseException as e:
        status = "interrupted" if isinstance(e, KeyboardInterrupt) else "failed"
        store.write_json(f"{folder}/summary.json", head | {"status": status, "error": f"{type(e).__name__}: {str(e)[:500]}"})
        store.delete(staging)
        raise
    commit(store, folder, staging, moves, [(f"{folder}/feature_columns.json", _json(columns)), (f"{folder}/summary.json", _json(head | {"status": "complete", "output_files": files}))])
    return files
