"""Command-line jobs, sinks, encodings, durations, counters and the streaming wick log."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidepool import cli
from tidepool.functions import times
from tidepool.operators import bars, health, topics, wicks
from tidepool.plans import adapters
from tidepool.sources import market, schemas, sinks


def test_durations():
    assert [times.duration(t) for t in ("90s", "240m", "24h", "7d")] == [90_000_000, 14_400_000_000, 86_400_000_000, 604_800_000_000]
    for bad in ("", "m", "4", "1.5h", "-1m", "3w"):
        with pytest.raises(ValueError):
            times.duration(bad)


def test_bytes_that_are_not_utf8(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"caf\xe9 ok")
    (tmp_path / "b.txt").write_text("née")
    got = {r.source_file[-5:]: r.content for r in topics.read_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "caf� ok", "b.txt": "née"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", datetime(2024, 1, 1, 23), 1), ("A", datetime(2024, 1, 2), 2), ("B", datetime(2024, 1, 1), 3)], "inst_id string, ts timestamp, v int")
    for _ in range(2):
        sinks.append_daily(df, str(tmp_path / "daily"))
        sinks.inbox(df.drop("ts", "inst_id"), str(tmp_path / "inbox"), "BTC", "funding")
        sinks.snapshot(df, str(tmp_path / "snap"))
    assert sorted(p.name for p in (tmp_path / "daily" / "inst_id=A").iterdir()) == ["date=2024-01-01", "date=2024-01-02"]
    assert spark.read.parquet(str(tmp_path / "daily")).count() == 6 and spark.read.parquet(str(tmp_path / "snap")).count() == 3
    box = spark.read.json(str(tmp_path / "inbox"))
    assert box.count() == 6 and {(r.symbol, r.kind, r.ingest_time is None) for r in box.collect()} == {("BTC", "funding", False)}


def test_fail_fast(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"symbol":"A","price":"1"}\n{bad\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        market.read_lines(spark, str(tmp_path), schemas.TRADES_SPOT, fail_fast=True).collect()


def test_counters_come_with_the_run(spark):
    df, seen = health.observed(adapters.trades(spark, SF), "run", "ts", F.col("side") == "other")
    n = df.count()
    assert seen.get["n_rows"] == n and 0 < seen.get["n_bad"] < n and seen.get["first_ts"] < seen.get["last_ts"]


def test_missing_instrument(spark):
    none = spark.createDataFrame([("X",)], "inst_id string")
    (r,) = health.per_instrument(adapters.trades(spark, SF), "trades", "ts", "2024-02-01", none, n=F.count("*")).collect()
    assert (r.status, r.age_minutes, r.attrs) == ("MISSING", None, "")


def feed(path):
    """Ninety minutes of trades and books of one instrument, its contract, and one repeated snapshot."""
    for d in ("trades", "book", "meta"):
        (path / d).mkdir()
    t0, trades, books = datetime(2024, 1, 1, 23), [], []
    for i in range(270):
        at = (t0 + timedelta(seconds=20 * i)).strftime("%Y-%m-%dT%H:%M:%S.000000Z")
        price = str(100 + (i * 7) % 11)
        trades.append({"timestamp_utc": at, "exchange": "okx", "market": "perp", "instId": adapters.BTC, "symbol_canon": "BTC/USDT", "trade_id": str(i), "side": "buy" if i % 3 else "sell", "price": price, "qty_contracts": "2", "ctVal": "0.01", "ctMult": "1", "ctType": "linear"})
        books.append({"timestamp_utc": at, "instId": adapters.BTC, "mid_price": "105", "bids": [["104.9", "5000000"], ["104", "3"]], "asks": [["105.1", "4"], ["106", "3"]], "seqId": i, "prevSeqId": i - 1})
    books.append(dict(books[-1], bids=[], seqId=999))
    for d, rows in (("trades", trades), ("book", books)):
        (path / d / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (path / "meta" / "m.json").write_text(json.dumps({"instId": adapters.BTC, "ctVal": "0.01", "ctMult": "1", "ctType": "linear", "tickSz": "0.1"}))
    return [f"--{k}={path / v}" for k, v in (("trades", "trades"), ("book", "book"), ("contracts", "meta"))]


def test_command_line(spark, tmp_path):
    trades, book, contracts = feed(tmp_path)
    out = lambda n: f"--out={tmp_path / n}"
    as_of = "--as-of=2024-01-02 00:29:00"
    for _ in range(2):
        cli.main(["cvd", trades, out("cvd")])
    assert spark.read.parquet(str(tmp_path / "cvd")).count() == 90
    cli.main(["candles", trades, out("c"), as_of, "--since=10m"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 11
    cli.main(["wicks", trades, contracts, out("wicks")])
    states = spark.read.parquet(str(tmp_path / "wicks"))
    assert {r.status for r in states.collect()} <= {"touched", "untouched"} and states.where("tip_distance_ticks is not null").count() == states.where("status = 'touched'").count()
    cli.main(["hidden", trades, as_of, out("hidden"), "--min-touched=1", "--age-max=90"])
    spark.read.parquet(str(tmp_path / "hidden")).count()
    cli.main(["buckets", book, contracts, out("buckets")])
    rows = spark.read.parquet(str(tmp_path / "buckets"))
    assert rows.count() == 270 and rows.where("best_bid > 0").count() == 270
    cli.main(["confluence", trades, book, contracts, as_of, out("score")])
    spark.read.parquet(str(tmp_path / "score")).count()
    cli.main(["dashboard", trades, book, contracts, as_of, out("five")])
    five = {r.component: (r.status, r.attrs) for r in spark.read.parquet(str(tmp_path / "five")).collect()}
    assert set(five) == {"wicks", "volume", "walls", "cvd", "vwap", "overall"} and {s for c, (s, _) in five.items() if c != "overall"} == {"FRESH"}
    assert five["overall"] == ("HEALTHY", "fresh=5, stale=0, missing=0")
    with pytest.raises(SystemExit):
        cli.main(["candles", trades, out("never"), "--since=10m"])


def test_tag_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"{n}.jsonl").write_text("\n".join(json.dumps({"text": f"the task over there {i}", "role": "user"}) for i in range(9)))
    cli.main(["tag", f"--input={tmp_path / 'in'}", f"--out={tmp_path / 'out'}", "--max-chars=1200"])
    (m,) = spark.read.json(str(tmp_path / "out" / "manifest")).collect()
    got = spark.read.json(str(tmp_path / "out" / "chunks"))
    assert m.kept == got.count() == 27 and m.files == 3 and m.chunks == got.select("chunk_id").distinct().count()
    assert got.groupBy("chunk_id").agg(F.sum("size").alias("n")).where("n > 1200").isEmpty()
    assert sorted(r.chunk_id for r in got.select("chunk_id").distinct().collect()) == list(range(1, m.chunks + 1))
    listed = {r.filename: (r.record_count, r.char_size) for r in spark.read.json(str(tmp_path / "out" / "output_chunks")).collect()}
    assert listed == {f"chunk_{r.chunk_id:04d}.json": (r.n, r.s) for r in got.groupBy("chunk_id").agg(F.count("*").alias("n"), F.sum("size").alias("s")).collect()}
    assert m.failed == 0 and got.where("size <> length(text)").count() == 27


def test_files_that_fail(spark, tmp_path):
    good = json.dumps([{"content": "the task over there", "role": "user"}, {"content": "short"}, {"content": "nothing of note here"}])
    for name, text in {"a.json": good, "b.json": good[:-3], "c.jsonl": '{"text": "the way over\n{bad', "d.jsonl": '{bad\n{"text": "with a line that holds"}', "e.json": "", "f.txt": "the plain text"}.items():
        (tmp_path / name).write_text(text)
    files = topics.read_corpus(spark, str(tmp_path))
    assert {r.source_file.rsplit("/", 1)[1]: r.error for r in topics.failed_files(files).collect()} == {"b.json": "not JSON", "c.jsonl": "no line is a JSON object"}
    records = topics.messages(files)
    (m,) = topics.manifest(files, records, topics.chunked(topics.tag(records).drop("match_score"), ["source_file", "message_index"], 10_000)).collect()
    assert (m.files, m.failed, m.seen, m.kept, m.dropped, m.dropped_short, m.chunks) == (5, 2, 5, 3, 2, 1, 1)  # Spark passes over the empty file


def test_self_test(spark, capsys):
    cli.main(["self-test"])
    assert "passed" in capsys.readouterr().out
