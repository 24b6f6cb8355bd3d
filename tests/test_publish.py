"""Publishing that is cut off at any step, bounded row groups, shards, merges by header, and strict times of generic files."""

import hashlib
import json
import zoneinfo
from datetime import datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_runs import day_rows, write_zip
from wickworks.operators import names, validate
from wickworks.sinks import legacy, publish
from wickworks.sources import tables, times

HOUR = 3_600_000


class Dead(BaseException):
    pass


class Dying(publish.Store):
    """A store that stops answering after some calls that change it, as one does whose driver dies; nothing is cleaned up afterwards."""

    left = 0

    def _next(self):
        if Dying.left <= 0:
            raise Dead
        Dying.left -= 1

    def make(self, path):
        self._next()
        super().make(path)

    def rename(self, a, b):
        self._next()
        super().rename(a, b)

    def delete(self, path):
        self._next()
        super().delete(path)


def cut_off_everywhere(spark, monkeypatch, run, check):
    """Runs once for each step that run() may die before, and then recovers and checks; returns what recover() said."""
    said, n = [], 0
    real = publish.Store
    while True:
        prepare = run(n)
        Dying.left = n
        monkeypatch.setattr(publish, "Store", Dying)
        died = False
        try:
            prepare()
        except Dead:
            died = True
        monkeypatch.setattr(publish, "Store", real)
        said.append(check(n, died))
        if not died:
            return said
        n += 1


def rows(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "open_time int, v string")


def test_a_file_and_its_report_are_old_or_new_together(spark, tmp_path, monkeypatch):
    old, new = rows(spark, ["old"] * 3), rows(spark, ["new"] * 4)

    def run(n):
        target = str(tmp_path / f"{n}/a.csv")
        publish.text_csv(old, target, ["open_time"], report={"v": "old"})
        return lambda: publish.text_csv(new, target, ["open_time"], "overwrite", {"v": "new"})

    def check(n, died):
        target = str(tmp_path / f"{n}/a.csv")
        said = publish.recover(spark, target)
        data = [line.split(",")[1] for line in (tmp_path / f"{n}/a.csv").read_text().splitlines()[1:]]
        report = json.loads((tmp_path / f"{n}/a.validation.json").read_text())["v"]
        assert data == [report] * (3 if report == "old" else 4)
        assert died or report == "new"
        assert sorted(x.name for x in (tmp_path / f"{n}").iterdir() if not x.name.endswith(".crc") and not x.name.endswith(".tmp")) == ["a.csv", "a.validation.json"]
        assert publish.recover(spark, target) == "nothing"
        return said

    said = cut_off_everywhere(spark, monkeypatch, run, check)
    assert {"cleared", "completed", "nothing"} == set(said) and said[-1] == "nothing"


def feature_rows(spark, n=40):
    return spark.range(n).select(F.timestamp_millis((F.col("id") + 1) * HOUR).alias("candle_end_utc"), F.when(F.col("id") % 2 == 0, "A").otherwise("b/c").alias("symbol"), F.col("id").cast("double").alias("x"))


def test_feature_files_are_all_there_or_none(spark, tmp_path, monkeypatch):
    df = feature_rows(spark)

    def run(n):
        return lambda: publish.features(df, str(tmp_path / f"f{n}"), {"n": n})

    def check(n, died):
        folder = tmp_path / f"f{n}"
        said = publish.recover(spark, str(folder))
        files = sorted(x.name for x in folder.glob("*.parquet")) if folder.exists() else []
        status = json.loads((folder / "summary.json").read_text())["status"] if (folder / "summary.json").exists() else None
        if status == "complete":
            assert len(files) == 2 and spark.read.parquet(*[str(folder / f) for f in files]).count() == 40 and json.loads((folder / "feature_columns.json").read_text()) == ["x"]
        else:
            assert not files and died
        assert not list(tmp_path.glob(f"f{n}.staging-*")) and not list(tmp_path.glob(f"f{n}.journal"))
        return status

    said = cut_off_everywhere(spark, monkeypatch, run, check)
    assert {"complete", "interrupted"} <= set(said)


def test_row_groups_and_shards(spark, tmp_path):
    df = spark.range(100_000).select(F.timestamp_millis((F.col("id") + 1) * HOUR).alias("candle_end_utc"), F.lit("A").alias("symbol"), F.col("id").cast("double").alias("x"))
    (one,) = publish.features(df, str(tmp_path / "one"), lambda staged: {"rows": staged.count()})
    meta = pq.ParquetFile(tmp_path / "one" / one).metadata
    assert meta.num_rows == 100_000 and max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 32_768 and meta.num_row_groups == 4
    assert json.loads((tmp_path / "one/summary.json").read_text())["rows"] == 100_000
    many = publish.features(df, str(tmp_path / "many"), {}, shard_ms=30_000 * HOUR)
    assert many == [f"A-features-0000{i}.parquet" for i in range(1, 5)]
    stitched = [v for f in many for v in pq.read_table(tmp_path / "many" / f)["x"].to_pylist()]
    assert stitched == [float(i) for i in range(100_000)]
    publish.candles_parquet(df.withColumnRenamed("candle_end_utc", "open_time"), str(tmp_path / "c.parquet"))
    assert pq.ParquetFile(tmp_path / "c.parquet").metadata.num_row_groups == 4


def test_features_are_computed_once(spark, tmp_path):
    """The report reads what was staged: a value that differs each time it's made is the same in report and file."""
    df = feature_rows(spark).withColumn("x", F.rand())
    publish.features(df, str(tmp_path / "f"), lambda staged: {"total": staged.agg(F.sum("x")).first()[0]})
    total = spark.read.option("pathGlobFilter", "*.parquet").parquet(str(tmp_path / "f")).agg(F.sum("x")).first()[0]
    assert abs(json.loads((tmp_path / "f/summary.json").read_text())["total"] - total) < 1e-9


# Daily and yearly files ----------------------------------------------------------------------------------------------------------


def test_daily_and_yearly_files_have_the_sources_columns_only(spark, tmp_path):
    for d in range(2):
        write_zip(tmp_path / f"raw/ABCUSDT-1h-2024-01-0{d + 1}.zip", day_rows(d))
    legacy.daily_csv(spark, str(tmp_path / "raw"), str(tmp_path / "daily"))
    header = "date,coin,interval,open_time,open,high,low,close,volume,close_time,quote_volume,count,taker_buy_volume,taker_buy_quote_volume,ignore"
    days = [(tmp_path / f"daily/ABCUSDT-1h-2024-01-0{d + 1}.csv").read_text().splitlines() for d in range(2)]
    assert [d[0] for d in days] == [header] * 2 and days[0][1].startswith("2024-01-01,ABCUSDT,1h,00:00:00.000Z,100,102,99,101,10.0,00:59:59.999Z,")
    (name,) = legacy.merge_csv(spark, str(tmp_path / "daily"), str(tmp_path / "yearly"))
    assert name == "ABCUSDT-1h-2024.csv" and (tmp_path / "yearly" / name).read_text().splitlines() == [header, *days[0][1:], *days[1][1:]]


def test_merges_keep_values_and_refuse_other_headers(spark, tmp_path):
    at = tmp_path / "in"
    at.mkdir()
    (at / "A-1h-2024-01-01.csv").write_text('﻿open, high ,note\n1,2,"a, ""b"" "\n3,,  c\n')
    (at / "A-1h-2024-01-02.csv").write_text("open,high,note\n5,6,d\n")
    (at / "B-1h-2024-01-01.csv").write_text("high,open\n9,1\n")
    assert legacy.merge_csv(spark, str(at), str(tmp_path / "out")) == ["A-1h-2024.csv", "B-1h-2024.csv"]
    assert (tmp_path / "out/A-1h-2024.csv").read_text() == 'open,high,note\n1,2,"a, ""b"" "\n3,,  c\n5,6,d\n'
    assert (tmp_path / "out/B-1h-2024.csv").read_text() == "high,open\n9,1\n"
    (at / "B-1h-2024-01-02.csv").write_text("open,high\n1,9\n")
    with pytest.raises(ValueError, match="columns do not match.*B-1h-2024-01-02"):
        legacy.merge_csv(spark, str(at), str(tmp_path / "out2"))
    (at / "B-1h-2024-01-02.csv").write_text("")
    with pytest.raises(ValueError, match="no header.*B-1h-2024-01-02"):
        legacy.merge_csv(spark, str(at), str(tmp_path / "out3"))


# Times ---------------------------------------------------------------------------------------------------------------------------


def generic(tmp_path, stamps):
    path = tmp_path / f"{hashlib.sha256(repr(stamps).encode()).hexdigest()[:12]}.csv"
    path.write_text("Time,open,high,low,close,volume\n" + "".join(f"{t},1,1,1,1,1\n" for t in stamps))
    return str(path)


def read(spark, tmp_path, stamps, **how):
    return [r["time_ms"] for r in tables.read_generic(spark, generic(tmp_path, stamps), **how).orderBy("time_ms").collect()]


def test_numeric_times_are_whole_number_arithmetic(spark, tmp_path):
    ns = [1_700_000_000_000_000_000 + i * 1_000_000 for i in range(2000)]
    assert read(spark, tmp_path, ns, unit="ns") == [n // 1_000_000 for n in ns]
    assert read(spark, tmp_path, ["1.5", "-0.0015"], unit="s") == [-2, 1500] and read(spark, tmp_path, [1999, -1], unit="us") == [-1, 1]


def test_local_times_that_are_none_or_two_fail(spark, tmp_path):
    zone = "America/New_York"
    assert read(spark, tmp_path, ["2024-03-10 01:30:00", "2024-03-10 03:30:00", "2024-11-03 00:59:59", "2024-11-03 02:00:00"], zone=zone) == [1710052200000, 1710055800000, 1730609999000, 1730617200000]
    for bad, rule in (("2024-11-03 01:30:00", "ambiguous"), ("2024-03-10 02:30:00", "exists")):
        with pytest.raises(validate.ValidationError, match=rule):
            read(spark, tmp_path, [bad], zone=zone)


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "Asia/Kolkata", "Pacific/Apia"])
def test_instants_equal_the_zone_database(spark, zone):
    z = zoneinfo.ZoneInfo(zone)
    start = datetime(2023, 1, 1)
    local = [start + timedelta(minutes=30 * i + 7) for i in range(48 * 366)]

    def plain(t):
        both = {t.replace(tzinfo=z, fold=f).astimezone(timezone.utc) for f in (0, 1)}
        return len([u for u in both if u.astimezone(z).replace(tzinfo=None) == t]), min(int(u.timestamp() * 1000) for u in both)

    ms = lambda t: int(t.replace(tzinfo=timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms(t),) for t in local], "local_ms long")
    got = {r[0]: (r[1], r[2]) for r in df.select("local_ms", F.size(times.instants(F.col("local_ms"), zone)), F.array_min(times.instants(F.col("local_ms"), zone))).collect()}
    for t in local:
        n, first = plain(t)
        assert got[ms(t)][0] == n and (n == 0 or got[ms(t)][1] == first), t


def test_missing_repeated_and_mixed_times_fail(spark, tmp_path):
    with pytest.raises(validate.ValidationError, match="time given"):
        read(spark, tmp_path, ["2024-01-01 00:00:00", ""], zone="UTC")
    with pytest.raises(validate.ValidationError, match="unique"):
        read(spark, tmp_path, ["1000", "1000"], unit="s")
    with pytest.raises(ValueError, match="several offsets"):
        read(spark, tmp_path, ["2024-01-01T00:00:00+01:00", "2024-01-01T00:00:00Z"])
    with pytest.raises(ValueError, match="several offsets"):
        read(spark, tmp_path, ["2024-01-01T00:00:00+01:00", "2024-01-02T00:00:00"])
    with pytest.raises(ValueError, match="need one"):
        read(spark, tmp_path, ["2024-01-01T00:00:00"])
    with pytest.raises(validate.ValidationError, match="readable"):
        read(spark, tmp_path, ["2024-01-01 00:00:00", "soon"], zone="UTC")
    assert read(spark, tmp_path, ["2024-01-01T00:00:00+01:00", "2024-01-01T02:00:00+01:00"]) == [1704063600000, 1704070800000]
    with pytest.raises(validate.ValidationError, match="step apart"):
        tables.spaced(spark.createDataFrame([(HOUR,), (2 * HOUR - 1,)], "end_ms long"), HOUR)
    assert tables.spaced(spark.createDataFrame([(HOUR,), (2 * HOUR,), (9 * HOUR,)], "end_ms long"), HOUR).count() == 3


def test_series_ids_of_any_text(spark):
    texts = ["ABC", 'q"\\', "tab\tline\nfeed\r\b\f", "é", "日本", "😀x", "\x7f\x00\x1f", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got in df.select("t", names.series_id(F.lit("um"), F.col("t"))).collect():
        assert got == hashlib.sha256(json.dumps(["um", t]).encode()).hexdigest()[:24], repr(t)
