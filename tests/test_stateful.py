"""Streams on transformWithState against the batch operators and plain models, over several triggers and restarts."""

import random
import zlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.test_models import T0, tape
from tidepool.operators import bars, vwap, wicks
from tidepool.plans import adapters
from tidepool.sources import market
from tidepool.streaming import market as market_streams
from tidepool.streaming import stateful


@pytest.fixture(autouse=True)
def rocks(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.configure(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def fed(spark, parts, schema, transform, where):
    """Rows of a stream that gets one part a trigger; every trigger is a new run from the checkpoint."""
    where.mkdir()
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(where / "in"))
        out = transform(spark.readStream.schema(schema).parquet(str(where / "in")))
        q = out.writeStream.format("parquet").option("path", str(where / "out")).option("checkpointLocation", str(where / "check")).trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(str(where / "out"))


def test_trailing_vwap_equals_batch(spark, tmp_path):
    rows, _ = tape(spark, 300, 5)
    edge = rows[100][1].replace(second=30)
    rows += [("A", edge, 9000, "buy", Decimal(7), Decimal(3), Decimal(1)), ("A", edge + timedelta(hours=1), 9001, "buy", Decimal(9), Decimal(2), Decimal(1)), ("A", edge + timedelta(hours=4), 9002, "sell", Decimal(5), Decimal(2), Decimal(1))]
    rows.sort(key=lambda r: (r[1], r[2]))
    rows += [(k, rows[-1][1] + timedelta(hours=3), 10_000 + i, "buy", Decimal(1), Decimal(1), Decimal(1)) for i, k in enumerate("AB")]
    df = market.with_money(spark.createDataFrame(rows, "inst_id string, ts timestamp, trade_id long, side string, price decimal(16,4), qty decimal(16,4), ct_val decimal(8,4)"))
    parts = [df.where(F.col("ts") < F.lit(c)).where(F.col("ts") >= F.lit(b)) for b, c in zip([datetime(2000, 1, 1), rows[90][1], rows[150][1], rows[220][1]], [rows[90][1], rows[150][1], rows[220][1], datetime(2100, 1, 1)], strict=True)]
    got = fed(spark, [p.orderBy(F.rand(1)).collect() for p in parts], df.schema, stateful.vwap, tmp_path / "v")
    want = vwap.vwap(df).where(F.col("window_start") < F.lit(rows[-1][1].replace(second=0) - timedelta(minutes=1)))
    assert got.count() == want.count() > 150
    assert got.select(*want.columns).exceptAll(want).isEmpty()
    assert want.where((F.col("window_start") == F.lit((edge + timedelta(hours=1)).replace(second=0)))).count() == 1


def test_running_cvd_with_late_rows(spark, tmp_path):
    rows, df = tape(spark, 300, 6)
    data = df.orderBy("ts").collect()
    parts = [data[:100], data[100:200], data[200:]]
    got = fed(spark, parts, df.schema, stateful.cvd, tmp_path / "a")
    batch = bars.cvd(df)
    assert got.select("inst_id", "window_start", "cvd_delta", "cvd_value").exceptAll(batch.select("inst_id", "window_start", "cvd_delta", "cvd_value")).isEmpty() and got.count() > 100

    # one trade of minute T0 comes two days late
    one = next(r for r in data if r.side == "buy" and r.inst_id == "A")
    row = one.asDict() | {"ts": T0 + timedelta(seconds=1), "trade_id": 77, "notional": Decimal("1000.5")}
    tuple_ = tuple(row[c] for c in df.schema.fieldNames())
    more = fed(spark, [data[:100], [tuple_, *data[100:200]], data[200:]], df.schema, stateful.cvd, tmp_path / "b")
    a = {(r.inst_id, r.window_start): r for r in got.collect()}
    b = {(r.inst_id, r.window_start): r for r in more.collect()}
    assert a.keys() == b.keys() and all(a[k].cvd_delta == b[k].cvd_delta for k in a)
    moved = {k: b[k].cvd_value - a[k].cvd_value for k in a}
    assert set(moved.values()) == {0, Decimal("1000.5")} and all(v == 0 for k, v in moved.items() if k[0] == "B")
    first = min(k[1] for k, v in moved.items() if v)
    assert all((v != 0) == (k[1] >= first) for k, v in moved.items() if k[0] == "A")


def messages(seed=3, n=60):
    """A snapshot, updates that change it, and the books they lead to."""
    r, book, out, seen, seq, at = random.Random(seed), {}, [], [], 10, T0
    for i in range(n):
        at += timedelta(milliseconds=700)
        change = {}
        for _ in range(r.randint(5, 9) if i == 0 else r.randint(1, 4)):
            side = r.choice(["bid", "ask"])
            price = f"{1000 + (r.randint(1, 40) if side == 'ask' else -r.randint(1, 40)) / 10:.1f}"
            change[side, price] = r.choice(["0", "1", "2.50", "17"]) if i else str(r.randint(1, 9))
        for k, q in change.items():
            book.pop(k, None) if q == "0" else book.update({k: q})
        sides = stateful.Book._sides(book, 25)
        level = lambda s: [(p, q) for (x, p), q in change.items() if x == s]  # noqa: B023, E731
        out.append(["X", at, "snapshot" if i == 0 else "update", seq + 1, -1 if i == 0 else seq, level("bid"), level("ask"), stateful.checksum(*sides)])
        seen.append(sides)
        seq += 1
    return out, seen


BOOKS = "inst_id string, ts timestamp, action string, seqId long, prevSeqId long, bids array<struct<price:string,qty:string>>, asks array<struct<price:string,qty:string>>, checksum long"


def test_books_from_updates(spark, tmp_path):
    rows, seen = messages()
    schema = spark.createDataFrame([], BOOKS).schema
    run = lambda rows, name: {r.seqId: r for r in fed(spark, [rows[:20], rows[20:45], rows[45:]], schema, lambda s: stateful.books(s, every="0s", depth=25), tmp_path / name).collect()}
    got = run(rows, "whole")
    assert len(got) == len(rows) and all(r.checksum_ok and not r.gap_detected for r in got.values())
    for row, (bids, asks) in zip(rows, seen, strict=True):
        r = got[row[3]]
        assert [(x.price, x.qty) for x in r.bids] == [(Decimal(p), Decimal(q)) for p, q in bids] and [x.price for x in r.asks] == [Decimal(p) for p, _ in asks]
    # a message is lost, a fresh snapshot comes later, and one checksum is wrong
    broken = rows[:30] + rows[31:]
    broken[39] = ["X", rows[40][1], "snapshot", rows[40][3], -1, seen[40][0], seen[40][1], rows[40][7]]
    broken[50] = [*broken[50][:7], 5]
    got = run(broken, "broken")
    assert [s for s, r in got.items() if r.gap_detected] == [rows[31][3]]
    assert [(x.price, x.qty) for x in got[rows[31][3]].bids] == [(Decimal(p), Decimal(q)) for p, q in seen[29][0]]
    assert not any(rows[31][3] < s < rows[40][3] for s in got)
    assert [s for s, r in got.items() if r.checksum_ok is False] == [broken[50][3]]
    assert [(x.price, x.qty) for x in got[rows[-1][3]].asks] == [(Decimal(p), Decimal(q)) for p, q in seen[-1][1]]


def test_books_at_a_cadence(spark, tmp_path):
    rows, _ = messages()
    got = fed(spark, [rows], spark.createDataFrame([], BOOKS).schema, stateful.books, tmp_path / "c")
    assert [r.seqId for r in got.orderBy("ts").collect()] == [r[3] for r in rows[::3]]


def test_checksum_of_uneven_sides():
    assert stateful.checksum([("1", "2")], [("3", "4"), ("5", "6")]) == stateful.checksum([("1", "2")], [("3", "4"), ("5", "6")], 2) != stateful.checksum([("1", "2")], [("3", "4")])
    crc = zlib.crc32(b"3366.1:7:3366.8:9:3368:8")
    assert stateful.checksum([("3366.1", "7")], [("3366.8", "9"), ("3368", "8")]) == (crc - 2**32 if crc >= 2**31 else crc)


def test_wick_log_equals_batch(spark, tmp_path):
    candles = bars.candles(adapters.trades(spark, SF), "1h").select("inst_id", "timeframe", "window_end", "open", "high", "low", "close")
    rows = candles.collect()
    days = [datetime(2000, 1, 1), datetime(2024, 1, 8), datetime(2024, 1, 16), datetime(2024, 1, 24), datetime(2100, 1, 1)]
    parts = [[r for r in rows if a <= r.window_end < b] for a, b in zip(days, days[1:], strict=False)]
    got = fed(spark, parts, candles.schema, lambda s: stateful.wick_log(s, hours=24), tmp_path / "log").collect()
    last = {r.event_id: r for r in wicks.lifecycle(wicks.detect(candles), candles, hours=24).collect()}
    born = {r.event_id for r in got if r.status == "untouched"}
    ends = {r.event_id: r for r in got if r.status != "untouched"}
    assert born == last.keys() and len(got) == len(born) + len(ends)
    # batch takes the end of a series' own candles as its present, the stream the watermark of all
    assert all(ends[e].status == r.status and ends[e].at == (r.touch_ts or r.created + timedelta(hours=24)) for e, r in last.items() if r.status != "untouched")
    assert all(ends[e].status == "expired" for e, r in last.items() if r.status == "untouched" and e in ends)
    assert {r.status for r in last.values()} >= {"touched", "expired"}


def test_wicks_expire_without_candles(spark, tmp_path):
    """One series falls silent; candles of another one move the watermark past the expiry."""
    row = lambda k, h, o, hi, lo, c: (k, "1h", T0 + timedelta(hours=h), *map(Decimal, (o, hi, lo, c)))
    schema = "inst_id string, timeframe string, window_end timestamp, open decimal(16,4), high decimal(16,4), low decimal(16,4), close decimal(16,4)"
    parts = [[row("A", 0, 10, 12, 9, 11), row("B", 0, 10, 10, 10, 10)], [row("A", 1, 10, 10, 9, 10)], [row("B", 200, 10, 10, 10, 10)], [row("B", 201, 10, 10, 10, 10)]]
    got = fed(spark, parts, spark.createDataFrame([], schema).schema, stateful.wick_log, tmp_path / "w").collect()
    assert sorted((r.wick_type, r.status, r.price, r.at) for r in got) == sorted([("high", "untouched", 12, T0), ("low", "untouched", 9, T0), ("low", "touched", 9, T0 + timedelta(hours=1)), ("low", "untouched", 9, T0 + timedelta(hours=1)), ("high", "expired", 12, T0 + timedelta(hours=168)), ("low", "expired", 9, T0 + timedelta(hours=169))])


def test_late_trades_leave_closed_candles_alone(spark, tmp_path):
    """A late trade within the delay counts; one behind the watermark changes no candle that has gone out, and is in none."""
    row = lambda m, s, price, i: ("A", T0 + timedelta(minutes=m, seconds=s), i, "buy", Decimal(price), Decimal(1), Decimal(1))
    schema = spark.createDataFrame([], "inst_id string, ts timestamp, trade_id long, side string, price decimal(16,4), qty decimal(16,4), ct_val decimal(8,4)").schema
    parts = [[row(0, 5, 10, 1), row(0, 50, 12, 2), row(1, 5, 11, 3)], [row(0, 10, 99, 4), row(1, 20, 14, 5)], [row(20, 0, 20, 6)], [row(0, 20, 500, 7), row(1, 30, 500, 8), row(20, 30, 21, 9)], [row(60, 0, 1, 10)], [row(90, 0, 1, 11)]]
    got = fed(spark, parts, schema, lambda s: market_streams.candles(s, "1m", "2 minutes"), tmp_path / "late").orderBy("window_start").collect()
    minute = lambda m: T0 + timedelta(minutes=m)
    assert [(r.window_start, r.open, r.high, r.close, r.trade_count) for r in got if r.window_start <= minute(20)] == [(minute(0), 10, 99, 12, 3), (minute(1), 11, 14, 14, 2), (minute(20), 20, 21, 21, 2)]
