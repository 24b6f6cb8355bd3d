"""Whole runs over small archives made here, sources, sinks, configuration and streaming."""

import hashlib
import http.server
import io
import json
import threading
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wickworks import cli
from wickworks.operators import candles as cd
from wickworks.operators import names, validate
from wickworks.plans import runs
from wickworks.sinks import legacy, publish
from wickworks.sources import archives, config, fetch, manifest, tables
from wickworks.streaming import candles as stream

HOUR = 3_600_000
D0 = 1_704_067_200_000  # 2024-01-01


def kline(ms, price, volume=10.0, taker=4.0, step=HOUR):
    return [ms, price, price + 2, price - 1, price + 1, volume, ms + step - 1, volume * price, 2, taker, taker * price, 0]


def write_zip(path, rows, header=None, member=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    out = io.StringIO()
    for r in ([header] if header else []) + rows:
        out.write(",".join(map(str, r)) + "\n")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(member or path.with_suffix(".csv").name, out.getvalue())


def day_rows(day, change=None):
    rows = [kline(D0 + day * 24 * HOUR + h * HOUR, 100 + h + day) for h in range(24)]
    if change:
        change(rows)
    return rows


def make(folder, days=2, change=None, header=None):
    for d in range(days):
        write_zip(folder / f"um/ABCUSDT/1h/ABCUSDT-1h-2024-01-0{d + 1}.zip", day_rows(d, change if d == 0 else None), header)


def cfg(folder, fmt="parquet", **more):
    return config.extract_config({"market": "um", "coins": ["abc"], "interval": "1h", "start_date": "2024-01-01", "end_date": "2024-01-02", "output_format": fmt, "raw_folder": str(folder / "raw"), "preprocessed_folder": str(folder / "out"), **more})


def test_extract_then_features(spark, tmp_path):
    make(tmp_path / "raw", header=["Open Time", "open", "high", "low", "close", "volume", "close_time", "quote_asset_volume", "number of trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore"])
    (report,) = runs.extract(spark, cfg(tmp_path))
    assert report["status"] == "passed" and report["rows"] == report["expected_rows"] == 48
    assert json.loads((tmp_path / "out/um/ABCUSDT/1h/ABCUSDT-1h-2024-01-01-2024-01-02-klines.validation.json").read_text())["rows"] == 48
    zips = sorted((tmp_path / "raw/um/ABCUSDT/1h").glob("*.zip"))
    assert [(x["rows"], x["sha256"]) for x in report["sources"]] == [(24, hashlib.sha256(z.read_bytes()).hexdigest()) for z in zips]
    csv_file = archives.unpack(spark, str(zips[0]))
    with zipfile.ZipFile(zips[0]) as z:
        assert open(csv_file, "rb").read() == z.read(z.namelist()[0])
    with pytest.raises(FileExistsError):
        runs.extract(spark, cfg(tmp_path))
    summary = runs.generate_dataset(spark, config.FeatureConfig(str(tmp_path / "out"), str(tmp_path / "features")))
    assert summary["status"] == "complete" and summary["rows"] == 48 and summary["output_files"] == ["ABCUSDT-features.parquet"]
    out = spark.read.parquet(str(tmp_path / "features/ABCUSDT-features.parquet"))
    assert len(out.columns) == 130 and out.columns[:2] == ["candle_end_utc", "symbol"] and out.count() == 48
    assert json.loads((tmp_path / "features/summary.json").read_text())["status"] == "complete"
    assert summary["series"][0]["missing_values_by_feature"]["log_return_5"] == 5
    with pytest.raises(FileExistsError):
        runs.generate_dataset(spark, config.FeatureConfig(str(tmp_path / "out"), str(tmp_path / "features")))
    with pytest.raises(ValueError, match="not in the input"):
        tables.read_candles(spark, str(tmp_path / "out"), ["NOPE"])


def test_csv_keeps_source_text(spark, tmp_path):
    make(tmp_path / "raw", change=lambda rows: rows[0].__setitem__(5, "10.50"))
    runs.extract(spark, cfg(tmp_path, "csv"))
    lines = (tmp_path / "out/um/ABCUSDT/1h/ABCUSDT-1h-2024-01-01-2024-01-02-klines.csv").read_text().splitlines()
    assert lines[0].split(",") == list(cd.EXTRACTOR_COLUMNS) and len(lines) == 49
    assert lines[1].split(",")[3] == "2024-01-01T00:00:00.000Z" and lines[1].split(",")[10] == "10.50"


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda r: r[3].__setitem__(0, D0 + 5 * HOUR + 1), "boundary"),
        (lambda r: r.__setitem__(3, list(r[2])), "increasing"),
        (lambda r: r.pop(), "candles a day"),
        (lambda r: r[3].__setitem__(3, 999), "low <="),
        (lambda r: r[3].__setitem__(9, 11), "taker buy volume"),
        (lambda r: r[3].__setitem__(1, "-5"), "finite number"),
        (lambda r: r[3].__setitem__(8, "2.0"), "whole number"),
        (lambda r: r[3].__setitem__(1, "1d"), "finite number"),
        (lambda r: r[23].__setitem__(0, D0 + 24 * HOUR), "inside its day"),
    ],
)
def test_invalid_days_fail(spark, tmp_path, change, rule):
    make(tmp_path / "raw", change=change)
    with pytest.raises(validate.ValidationError, match=rule):
        runs.extract(spark, cfg(tmp_path))


def test_archive_structure(spark, tmp_path):
    make(tmp_path / "raw", days=1)
    with pytest.raises(FileNotFoundError):
        runs.extract(spark, cfg(tmp_path))
    write_zip(tmp_path / "x/A-1h-2024-01-01.zip", day_rows(0), member="other.csv")
    with pytest.raises(Exception, match="expected one plain member"):
        archives.read(spark, str(tmp_path / "x"), archives.KLINE).collect()
    write_zip(tmp_path / "y/A-1h-2024-01-01.zip", [r[:11] for r in day_rows(0)])
    with pytest.raises(Exception, match="expected 12 cells"):
        archives.read(spark, str(tmp_path / "y"), archives.KLINE).collect()


def trade(i, ms, price, quantity, maker):
    return [i, price, quantity, i, i, ms, maker]


def test_combined_reconciliation(spark, tmp_path):
    def candles(rows):
        for h, r in enumerate(rows):
            if h == 0:  # two trades: buy 3 at 100, sell 1 at 102
                r[1:12] = [100, 102, 100, 102, 4, r[6], 402, 2, 3, 300, 0]
            else:
                r[1:12] = [102, 102, 102, 102, 0, r[6], 0, 0, 0, 0, 0]
        rows[5][5] = rows[5][7] = 9  # a volume without trades

    make(tmp_path / "raw", change=candles)
    make_second = [[D0 + 24 * HOUR + h * HOUR, 102, 102, 102, 102, 0, D0 + 24 * HOUR + (h + 1) * HOUR - 1, 0, 0, 0, 0, 0] for h in range(24)]
    write_zip(tmp_path / "raw/um/ABCUSDT/1h/ABCUSDT-1h-2024-01-02.zip", make_second)
    base = tmp_path / "raw/um/ABCUSDT/aggTrades"
    write_zip(base / "ABCUSDT-aggTrades-2024-01-01.zip", [trade(1, D0 + 5, 100, 3, "False"), trade(2, D0 + 7, 102, 1, "true")], list(archives.TRADES))
    write_zip(base / "ABCUSDT-aggTrades-2024-01-02.zip", [], list(archives.TRADES))
    (report,) = runs.extract(spark, cfg(tmp_path, "csv", datasets=["klines", "aggTrades"]))
    assert report["status"] == "mismatches" and report["mismatched_hours"] == 1 and report["hours_without_agg_trades"] == 47
    assert report["failed_base_volume_matches"] == 1 and report["mismatch_examples"][0]["open_ms"] == D0 + 5 * HOUR
    write_zip(base / "ABCUSDT-aggTrades-2024-01-02.zip", [trade(2, D0 + 24 * HOUR, 100, 3, "false")])
    with pytest.raises(validate.ValidationError, match="ids strictly increasing"):
        runs.extract(spark, cfg(tmp_path, "csv", datasets=["klines", "aggTrades"]), overwrite=True)


def test_legacy_csv_and_merges(spark, tmp_path):
    make(tmp_path / "raw")
    written = legacy.daily_csv(spark, str(tmp_path / "raw"), str(tmp_path / "daily"))
    assert written == ["ABCUSDT-1h-2024-01-01.csv", "ABCUSDT-1h-2024-01-02.csv"]
    assert legacy.daily_csv(spark, str(tmp_path / "raw"), str(tmp_path / "daily")) == written
    legacy.merge_parquet(spark, str(tmp_path / "daily"), str(tmp_path / "yearly"))
    merged = spark.read.parquet(str(tmp_path / "yearly"))
    assert merged.count() == 48 and merged.select("file_year").distinct().count() == 1
    assert merged.orderBy("date", "open_time").first()["open_time"] == "00:00:00.000Z"
    (name,) = legacy.merge_csv(spark, str(tmp_path / "daily"), str(tmp_path / "yearly_csv"))
    assert name == "ABCUSDT-1h-2024.csv" and len((tmp_path / "yearly_csv" / name).read_text().splitlines()) == 49


def test_manifest(spark, tmp_path):
    make(tmp_path)
    zips = sorted((tmp_path / "um/ABCUSDT/1h").glob("*.zip"))
    zips[0].with_name(zips[0].name + ".CHECKSUM").write_text(f"{hashlib.sha256(zips[0].read_bytes()).hexdigest()}  {zips[0].name}\n")
    zips[1].with_name(zips[1].name + ".CHECKSUM").write_text(f"{'0' * 64}  {zips[1].name}\n")
    planned = manifest.plan(spark, "um", ["ABCUSDT"], "1h", date(2024, 1, 1), date(2024, 1, 3))
    found = {str(r["day"]): r["status"] for r in manifest.verify(planned, str(tmp_path)).collect()}
    assert found == {"2024-01-01": "ok", "2024-01-02": "mismatch", "2024-01-03": "missing"}
    assert {r["status"]: r["files"] for r in manifest.totals(manifest.verify(planned, str(tmp_path))).collect()} == {"ok": 1, "mismatch": 1, "missing": 1}


@pytest.fixture
def server(tmp_path):
    """Serves a folder; the first answers to some paths are errors or broken off."""
    folder, troubles = tmp_path / "served", {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            path = folder / self.path.lstrip("/")
            kind = troubles[self.path].pop(0) if troubles.get(self.path) else None
            if kind == "busy" or not path.exists():
                self.send_error(503 if kind else 404)
                return
            body = path.read_bytes()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body[:-9] if kind == "short" else b"\0" * len(body) if kind == "wrong" else body)

        def log_message(self, *args):
            pass

    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield folder, troubles, f"http://127.0.0.1:{made.server_port}"
    made.shutdown()


def test_fetch(spark, tmp_path, server):
    folder, troubles, url = server
    for d in (1, 2, 3):
        z = folder / f"klines/ABCUSDT/1h/ABCUSDT-1h-2024-01-0{d}.zip"
        write_zip(z, day_rows(d - 1), member="other.csv" if d == 3 else None)
        z.with_name(z.name + ".CHECKSUM").write_text(f"{hashlib.sha256(z.read_bytes()).hexdigest()}  {z.name}\n")
    paths = [f"/klines/ABCUSDT/1h/ABCUSDT-1h-2024-01-0{d}.zip" for d in (1, 2, 3)]
    troubles |= {paths[0]: ["busy", "short"], f"{paths[0]}.CHECKSUM": ["busy"], paths[1]: ["wrong"]}
    waits = []
    go = lambda days: fetch.fetch(spark, manifest.plan(spark, "um", ["ABCUSDT"], "1h", date(2024, 1, 1), date(2024, 1, days)), url, str(tmp_path / "raw"), str(tmp_path / "raw/manifest.json"), 2, 3, wait=waits.append)
    done = go(2)
    assert done["status"] == "complete" and done["downloaded"] == 2 and sorted(waits) == [1.0, 1.0, 1.0, 2.0]
    assert manifest.verify(manifest.plan(spark, "um", ["ABCUSDT"], "1h", date(2024, 1, 1), date(2024, 1, 2)), str(tmp_path / "raw")).where("status = 'ok'").count() == 2
    assert archives.read(spark, str(tmp_path / "raw"), archives.KLINE).count() == 48
    (tmp_path / "raw/um/ABCUSDT/1h/ABCUSDT-1h-2024-01-02.zip").write_bytes(b"half")
    for x in (tmp_path / "raw/um/ABCUSDT/1h").glob(".*.crc"):
        x.unlink()
    again = go(2)
    assert (again["skipped"], again["downloaded"]) == (1, 1)
    with pytest.raises(fetch.FetchError, match="one plain member"):
        go(3)
    with pytest.raises(fetch.FetchError, match="404"):
        fetch.fetch_one(publish.Store(spark, str(tmp_path)), f"{url}/nothing.zip", str(tmp_path / "nothing.zip"), wait=waits.append)
    state = json.loads((tmp_path / "raw/manifest.json").read_text())
    assert state["status"] == "incomplete" and len(state["objects"]) == 2 and len(state["errors"]) == 1


def test_generic_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Open Time,Open,HIGH,low,close,Base-Asset Volume,trades\n1704067200000,1,2,1,2,5,3\n1704070800000,2,3,2,3,6,4\n")
    out = tables.ends(tables.read_generic(spark, str(tmp_path / "a.csv"), unit="ms"), HOUR, "start")
    assert [r["end_ms"] for r in out.orderBy("end_ms").collect()] == [D0 + HOUR, D0 + 2 * HOUR] and "trade_count" in out.columns
    with pytest.raises(ValueError, match="unit"):
        tables.read_generic(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text("time,open,high,low,close,volume,symbol\n1,1,1,1,1,1,A\n2,1,1,1,1,1,B\n")
    with pytest.raises(ValueError, match="more than one instrument"):
        tables.read_generic(spark, str(tmp_path / "b.csv"), unit="s")
    (tmp_path / "c.csv").write_text("time,open,high,low,close,volume,Asset\n1,1,1,1,1,1,A\n2,1,1,1,1,1,B\n")
    with pytest.raises(ValueError, match="more than one instrument"):
        tables.read_generic(spark, str(tmp_path / "c.csv"), unit="s")
    (tmp_path / "d.csv").write_text("time,open,high,low,close,volume\n")
    with pytest.raises(ValueError, match="no rows"):
        tables.read_generic(spark, str(tmp_path / "d.csv"), unit="s")
    (tmp_path / "e.csv").write_text("time,Open ,high,low,close,volume,x-y,x y\n1,1,1,1,1,1,1,1\n")
    with pytest.raises(ValueError, match="several columns"):
        tables.read_generic(spark, str(tmp_path / "e.csv"), unit="s")
    with pytest.raises(ValueError, match="the file is"):
        tables.read_generic(spark, str(tmp_path / "f.txt"), unit="s")
    with pytest.raises(ValueError, match="role"):
        tables.ends(out, HOUR, "start", 5)
    with pytest.raises(ValueError, match="several columns"):
        names.resolve(["open", "high", "low", "close", "volume", "base_volume"])


def test_config_rules(tmp_path):
    (tmp_path / "c.yaml").write_text("input: a\noutput: b\ninput: c\n")
    with pytest.raises(config.ConfigError, match="twice"):
        config.load_yaml(tmp_path / "c.yaml")
    with pytest.raises(config.ConfigError, match="unknown"):
        config.feature_config({"input": "a", "output": "b", "x": 1})
    assert config.pairs({"coins": ["btc", "ETHUSDC"]}) == ("BTCUSDT", "ETHUSDC")
    for bad in ({"coins": ["btc", "BTCUSDT"]}, {"coins": []}, {"coin": "USDT"}, {"coin": "a", "symbol": "b"}):
        with pytest.raises(config.ConfigError):
            config.pairs(bad)
    base = {"market": "um", "coin": "btc", "interval": "1h", "start_date": "2024-01-01", "end_date": "2024-01-02", "output_format": "csv"}
    assert config.extract_config(base).download_workers == 4
    for k, v in (("market", "spot"), ("interval", "7m"), ("output_format", "x"), ("end_date", "2023-01-01"), ("download_workers", 9), ("datasets", ["aggTrades"]), ("start_date", "x")):
        with pytest.raises(config.ConfigError):
            config.extract_config(base | {k: v})
    with pytest.raises(config.ConfigError):
        config.extract_config(base, today=date(2024, 1, 2))


def test_intervals_and_layouts():
    assert [cd.interval_ms(x) for x in ("1s", "15m", "1h", "2d", "1w")] == [1000, 900_000, HOUR, 172_800_000, 604_800_000]
    for bad in ("", "1M", "0h", "h", "1.5h"):
        with pytest.raises(ValueError):
            cd.interval_ms(bad)
    assert cd.layout(cd.EXTRACTOR_COLUMNS) == "extractor" and cd.layout(cd.LEGACY_COLUMNS) == "legacy"
    with pytest.raises(ValueError):
        cd.layout([*cd.LEGACY_COLUMNS, "market"])


def test_legacy_layout_text(spark):
    row = ("venue", "um", "A", "1h", "trade", D0, D0 + HOUR - 1, D0 + HOUR, "1.5", "2", "1", "1.7", "10", 3, "4")
    df = spark.createDataFrame([row], ", ".join(f"`{c}` {'long' if c.endswith('_ms') or c == 'trade_count' else 'string'}" for c in cd.LEGACY_COLUMNS))
    out, interval = tables.checked(cd.canonical(df))
    assert interval == "1h" and out.first()["close"] == 1.7


def test_publish_failure_is_visible(spark, tmp_path):
    bad = spark.range(3).select(F.current_timestamp().alias("candle_end_utc"), F.lit("A").alias("symbol"), F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.lit(1.0)).cast("double").alias("x"))
    with pytest.raises(Exception, match="boom"):
        publish.features(bad, str(tmp_path / "f"), {})
    assert json.loads((tmp_path / "f/summary.json").read_text())["status"] == "failed" and not list((tmp_path / "f").glob("*.parquet"))


def test_stream_equals_batch(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [("A", i, start + timedelta(minutes=7 * i), 100.0 + (i * 37) % 11, i % 5, i % 2 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "symbol string, tick_id long, ts timestamp, price double, quantity long, buyer_is_maker boolean")
    for k in range(4):
        df.where((F.col("tick_id") >= 50 * k) & (F.col("tick_id") < 50 * k + 55)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream.build(live, ["symbol"]).writeStream.format("memory").queryName("made").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["open_time"]: r for r in spark.table("made").collect()}
    want = {r["open_time"]: r for r in stream.build(df, ["symbol"]).collect()}
    assert len(got) >= len(want) - 2 and all(got[t] == want[t] for t in got)
    assert stream.sessions(df, ["symbol"], "5 minutes").count() == 200


def test_long_series_are_computed_in_chunks(spark):
    rows = [("A", D0 + (i + 1 + 3 * (i > 700)) * HOUR, *kline(0, 100 + (i * 37) % 11)[1:6], 2, 4.0) for i in range(900)]
    df = spark.createDataFrame([(s, e, float(o), float(h), float(x), float(c), float(v), n, t) for s, e, o, h, x, c, v, n, t in rows], "symbol string, end_ms long, open double, high double, low double, close double, volume double, trade_count long, taker_buy_base_volume double")
    whole, cut = (runs.calculate(df, ["symbol"], HOUR, chunk_rows=n).select("end_ms", "segment_id", *[F.round(x, 6).alias(x) for x in ("ema_distance_160", "log_return_80", "relative_volume_20")]) for n in (16_384, 300))
    assert whole.exceptAll(cut).count() == cut.exceptAll(whole).count() == 0 and whole.count() == 900


def test_fetch_by_executors(spark, tmp_path, server):
    folder, troubles, url = server
    for d in (1, 2, 3):
        z = folder / f"klines/ABCUSDT/1h/ABCUSDT-1h-2024-01-0{d}.zip"
        write_zip(z, day_rows(d - 1), member="other.csv" if d == 3 else None)
        z.with_name(z.name + ".CHECKSUM").write_text(f"{hashlib.sha256(z.read_bytes()).hexdigest()}  {z.name}\n")
    troubles |= {"/klines/ABCUSDT/1h/ABCUSDT-1h-2024-01-01.zip": ["busy", "short"], "/klines/ABCUSDT/1h/ABCUSDT-1h-2024-01-02.zip": ["wrong"]}
    go = lambda first, last: fetch.fetch_table(manifest.plan(spark, "um", ["ABCUSDT"], "1h", date(2024, 1, first), date(2024, 1, last)), url, str(tmp_path / "raw"), 2, 3)
    assert go(1, 1).count() == 1
    got = go(1, 2)
    assert sorted(r["path"][-14:-4] for r in got.collect()) == ["2024-01-01", "2024-01-02"]
    assert all(hashlib.sha256(r["content"]).hexdigest() == r["sha256"] for r in got.collect())
    lines = archives.unpacked(got.select("path", "content"), archives.KLINE)
    assert archives.klines(lines, "um", "ABCUSDT", "1h").count() == 48
    with pytest.raises(Exception, match="one plain member"):
        go(1, 3)
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_run_modes_and_commands(spark, tmp_path, server, capsys):
    folder, _, url = server
    for d in (1, 2):
        z = folder / f"klines/ABCUSDT/1h/ABCUSDT-1h-2024-01-0{d}.zip"
        write_zip(z, day_rows(d - 1))
        z.with_name(z.name + ".CHECKSUM").write_text(f"{hashlib.sha256(z.read_bytes()).hexdigest()}  {z.name}\n")
    settings = f"market: um\ncoins: [abc]\ninterval: 1h\nstart_date: 2024-01-01\nend_date: 2024-01-02\noutput_format: csv\nbase_url: {url}\n"
    (tmp_path / "c.yaml").write_text(settings)
    run = lambda *args: cli.main([str(a) for a in args])
    assert run("extract", "--config", tmp_path / "c.yaml", "--process-only") == 1  # nothing is there yet
    assert run("extract", "--config", tmp_path / "c.yaml", "--download-only") == 0 and not (tmp_path / "data/pre_processed").exists()
    assert run("extract", "--config", tmp_path / "c.yaml", "--process-only") == 0
    assert len(list((tmp_path / "data/pre_processed").rglob("*klines.csv"))) == 1
    assert run("daily", "--input", tmp_path / "data/raw", "--output", tmp_path / "daily") == 0 and len(list((tmp_path / "daily").glob("*.csv"))) == 2
    for kind in ("csv", "parquet"):
        assert run("yearly", "--input", tmp_path / "daily", "--output", tmp_path / "yearly", "--format", kind) == 0
    assert spark.read.parquet(str(tmp_path / "yearly/ABCUSDT-1h-2024.parquet")).count() == 48 and (tmp_path / "yearly/ABCUSDT-1h-2024.csv").exists()
    assert run("download", "--base-url", url, "--symbol", "ABCUSDT", "--start", "2024-01-01", "--end", "2024-01-01", "--output", tmp_path / "raw2", "--extract") == 0
    assert (tmp_path / "raw2/um/ABCUSDT/1h/ABCUSDT-1h-2024-01-01.csv").exists()
    assert run("download", "--base-url", "ftp://x", "--symbol", "ABCUSDT", "--start", "2024-01-01", "--end", "2024-01-01") == 2
    with pytest.raises(ValueError, match="exclude"):
        runs.run_extractor(spark, cfg(tmp_path), True, True)
    assert "2 archives" in capsys.readouterr().out


def test_archive_member_faults(spark, tmp_path):
    def one(name, *members, cut=None):
        path = tmp_path / "in" / f"{name}.zip"
        path.parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(path, "w") as z:
            for member, text, mode in members:
                info = zipfile.ZipInfo(member)
                info.external_attr = mode << 16
                z.writestr(info, text)
        if cut:
            path.write_bytes(path.read_bytes()[:cut])

    plain = 0o100644
    one("sound", ("sound.csv", "1,2\n", plain))
    one("two", ("two.csv", "1", plain), ("b.csv", "1", plain))
    one("folder", ("folder.csv/", "", 0o040755))
    one("link", ("link.csv", "/etc/passwd", 0o120777))
    one("name", ("other.csv", "1", plain))
    one("empty", ("empty.csv", "", plain))
    one("none", ("none.csv", "1", plain), cut=10)
    one("locked", ("locked.csv", "1", plain))
    path = tmp_path / "in/locked.zip"
    body = bytearray(path.read_bytes())
    at = body.index(b"PK\x01\x02")
    body[at + 8] |= 1
    path.write_bytes(bytes(body))
    got = {r["file"]: r["fault"] for r in archives.faults(spark, str(tmp_path / "in")).collect()}
    assert got == {"sound.zip": None, "two.zip": "2 members", "folder.zip": "a folder", "link.zip": "a symbolic link", "name.zip": "another name", "empty.zip": "empty", "none.zip": "no archive", "locked.zip": "encrypted"}
    for name, fault in got.items():
        if fault and fault != "no archive":
            with pytest.raises(Exception, match=fault):
                archives.read(spark, [str(tmp_path / "in" / name)], ["a", "b"]).collect()


def test_features_of_a_generic_file(spark, tmp_path):
    with (tmp_path / "a.csv").open("w") as f:
        f.write("Date,open,high,low,close,volume\n")
        for i in range(300):
            t = datetime(2024, 1, 1) + timedelta(hours=i + 1 + (5 if i >= 200 else 0))
            f.write(f"{t},{100 + i % 7},{110 + i % 7},{90},{100 + i % 5},{i % 9}\n")
    out, report = runs.calculate_file(spark, str(tmp_path / "a.csv"), "1h", "end", zone="UTC")
    assert (report["rows"], report["gap_count"], report["calculation_segments"], report["input_timestamp_role"]) == (300, 1, 2, "end") and out.columns[0] == "end_ms" and len(out.columns) == 129
    _, other = runs.calculate_file(spark, str(tmp_path / "a.csv"), "1h", "end", "rows", zone="UTC", chunk_rows=200)
    assert other["calculation_segments"] == 1 and any("across gaps" in n for n in other["notes"])
    with pytest.raises(validate.ValidationError, match="step apart"):
        runs.calculate_file(spark, str(tmp_path / "a.csv"), "2h", "end", zone="UTC")
