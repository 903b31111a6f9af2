"""The polled source over recorded answers: batch, and polls that overlap."""

import json

import pytest

from tidepool import cli
from tidepool.sources import poller

T = 1_700_000_000


@pytest.fixture
def recorded(tmp_path):
    def record(upto, late=()):
        for series, field in (("oi", "o"), ("funding", "fr")):
            (tmp_path / "answers" / series).mkdir(parents=True, exist_ok=True)
            for symbol in ("BTC", "ETH"):
                history = [{"t": T + 60 * i, field: i + 0.5} for i in range(upto) if i not in late or symbol == "ETH"]
                (tmp_path / "answers" / series / f"{symbol}.json").write_text(json.dumps([{"symbol": symbol, "history": history}, {"symbol": "other", "history": [{"t": T, field: -1}]}]))
        return str(tmp_path / "answers")

    return record


def test_batch(spark, recorded):
    spark.dataSource.register(poller.Poller)
    df = spark.read.format("tidepool-poller").options(recorded=recorded(100), symbols="BTC, ETH", to=str(T + 60 * 50), lookback="600").load()
    assert df.rdd.getNumPartitions() == 8  # two symbols, four series, two of them without an answer
    got = poller.points(df.union(df)).collect()
    assert len(got) == 2 * 2 * 11 and {r.symbol for r in got} == {"BTC", "ETH"}
    assert {(r.o, r.fr) for r in got if r.series == "oi"} == {(i + 0.5, None) for i in range(40, 51)}


def test_polls_overlap_and_restart(spark, recorded, tmp_path):
    spark.dataSource.register(poller.Poller)
    for upto, late in ((20, {15}), (40, {15, 33}), (60, set())):  # point 15 is published two polls late, 33 one poll late
        stream = spark.readStream.format("tidepool-poller").options(recorded=recorded(upto, late), symbols="BTC,ETH", series="oi,funding", since=str(T), to=str(T + 60 * upto), lookback="3600").load()
        q = poller.points(stream, "2 hours").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    got = spark.read.parquet(str(tmp_path / "out"))
    rows = got.where("series = 'oi'").collect()
    assert sorted((r.symbol, r.o) for r in rows) == sorted((s, i + 0.5) for s in ("BTC", "ETH") for i in range(60))
    assert got.count() == 240


def test_poll_job_once(spark, recorded, tmp_path):
    for upto in (20, 40):  # the second poll sees all points again and adds the new ones
        cli.main(["poll", f"--recorded={recorded(upto)}", "--symbols=BTC,ETH", f"--out={tmp_path / 'out'}", f"--checkpoint={tmp_path / 'check'}", f"--since={T}", f"--to={T + 60 * upto}", "--once"])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.select("symbol", "series", "ts").distinct().count() == 2 * 2 * 40
