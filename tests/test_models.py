"""Order-sensitive operators against small Python models, boundary rows, and batch against stream."""

import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidepool.operators import bars, book, confluence, joins, scale, topics, volume, vwap, wicks
from tidepool.plans import adapters
from tidepool.sources import market, replay, schemas, sinks
from tidepool.streaming import market as streams

T0 = datetime(2024, 1, 1, 23, 0)


def tape(spark, n=400, seed=1):
    """Trades with ties, exact gaps of an hour, ids of different length and unknown sides, over a midnight."""
    r, at, rows = random.Random(seed), T0, []
    for i in range(n):
        at += timedelta(seconds=r.choice([0, 0, 1, 20, 60, 600, 3600]))
        rows.append(("A" if r.random() < 0.7 else "B", at, 995 + i, r.choice(["buy", "sell", "other"]), Decimal(r.randint(1, 50)), Decimal(r.randint(1, 9)), Decimal(1)))
    df = spark.createDataFrame(rows, "inst_id string, ts timestamp, trade_id long, side string, price decimal(16,4), qty decimal(16,4), ct_val decimal(8,4)")
    return rows, market.with_money(df)


def test_vwap_model(spark):
    rows, df = tape(spark)
    got = {(r.inst_id, r.window_start): r for r in vwap.vwap(df, {"1h": 3600}, anchor=T0 + timedelta(hours=5)).collect()}
    for inst in ("A", "B"):
        own = sorted((ts, i, p, q) for k, ts, i, _, p, q, _ in rows if k == inst)
        seen = set()
        for j, (ts, _, _, _) in enumerate(own):
            minute = ts.replace(second=0)
            if minute in seen:
                continue
            seen.add(minute)
            upto = own[: j + 1]
            for name, keep in (("1h", lambda t, ts=ts: t >= ts - timedelta(hours=1)), ("session", lambda t, ts=ts: t.date() == ts.date()), ("anchored", lambda t: t >= T0 + timedelta(hours=5))):
                part = [(p, p * q) for t, _, p, q in upto if keep(t)]
                r = got[(inst, minute)]
                assert r[f"trade_count_{name}"] == len(part)
                assert r[f"vwap_{name}"] == (pytest.approx(float(sum(p * n for p, n in part) / sum(n for _, n in part)), abs=1e-6) if part else None)
    assert len(got) == len({(k, ts.replace(second=0)) for k, ts, *_ in rows})


def test_cvd_ignores_order_and_unknown_sides(spark):
    rows, df = tape(spark)
    total = {k: sum(p * q * (1 if s == "buy" else -1) for i, _, _, s, p, q, _ in rows if i == k and s != "other") for k in ("A", "B")}
    out = bars.cvd(df.orderBy(F.rand(3))).orderBy("window_start").collect()
    assert {r.inst_id: r.cvd_value for r in out} == total


def test_ladder_equals_direct(spark):
    _, df = tape(spark)
    direct, rolled = bars.candles(df, "4h"), bars.roll_up(bars.candles(df, "1m"), "4h")
    assert direct.select(*rolled.columns).exceptAll(rolled).isEmpty() and rolled.exceptAll(direct.select(*rolled.columns)).isEmpty()


def median(v):
    v, n = sorted(v), len(v)
    return (v[(n - 1) // 2] + v[n // 2]) / 2


@pytest.mark.parametrize("lookback", [5, None])
def test_volume_signals_model(spark, lookback):
    r = random.Random(2)
    rows = [("A", T0 + timedelta(minutes=3 * i), Decimal(r.choice([0, 1, 2, 4, 8, 100])), r.choice([0.0, 0.1, -0.1, 0.2]), Decimal(r.choice([-1, 0, 1]))) for i in range(40)]
    df = spark.createDataFrame(rows, "inst_id string, window_start timestamp, total_volume decimal(24,8), price_change_pct double, delta decimal(24,8)")
    got = volume.signals(df, lookback, block=7).orderBy("window_start").collect()
    for i, g in enumerate(got):
        v, h = float(rows[i][2]), [float(x[2]) for x in rows[max(0, i - lookback) if lookback else 0 : i]]
        m = median(h) if h else 0
        assert g.volume_tier == ("T2" if not m else "T4" if v > 2 * m else "T3" if v > m else "T2" if 2 * v > m else "T1")
        mad = median([abs(x - m) for x in h]) if h else 0
        assert g.modified_z_score == (pytest.approx(0.6745 * (v - m) / mad, abs=1e-6) if len(h) >= 3 and mad else None)
        up = sorted(h)[len(h) // 2] if h else 0
        assert g.absorption == bool(up and abs(rows[i][3]) <= 0.1 and v > 2 * up)
        assert g.divergence == (rows[i][3] * float(rows[i][4]) < 0)


@pytest.mark.parametrize("batch_expiry", [False, True])
def test_first_touch_model(spark, batch_expiry):
    r, rows = random.Random(7), []
    for i in range(300):
        o, c = r.randint(90, 110), r.randint(90, 110)
        start = T0 + timedelta(hours=i + (i > 150) * 200)
        rows.append(("A", "1h", start, start + timedelta(hours=1), o, max(o, c) + r.randint(0, 6), min(o, c) - r.randint(0, 6), c))
    df = spark.createDataFrame([(*x[:4], *map(Decimal, x[4:])) for x in rows], "inst_id string, timeframe string, window_start timestamp, window_end timestamp, open decimal(16,4), high decimal(16,4), low decimal(16,4), close decimal(16,4)")
    got = {r.event_id: r for r in wicks.lifecycle(wicks.detect(df), df, batch_expiry=batch_expiry).collect()}
    end, n = rows[-1][3], 0
    for i, (_, _, _, born, o, h, low, c) in enumerate(rows):
        for kind, price, there in (("high", h, h > max(o, c)), ("low", low, low < min(o, c))):
            if not there:
                continue
            n += 1
            hit = next((x for x in rows[i + 1 :] if x[3] < born + timedelta(hours=168) and (x[5] >= price if kind == "high" else x[6] <= price)), None)
            old = end >= born + timedelta(hours=168)
            want = "touched" if hit and not (batch_expiry and old) else "expired" if old else "untouched"
            g = got[f"A|1h|{born:%Y-%m-%dT%H:%M:%SZ}|{kind}"]
            assert (g.status, g.touch_ts) == (want, hit[3] if want == "touched" else None)
    assert n == len(got)


def band_rows(spark, seed=1, n=600):
    r, at, rows = random.Random(seed), T0, []
    for _ in range(n):
        at += timedelta(seconds=r.choice([2, 2.5, 10, 29, 600]))
        rows.append(("X", at, "bid", 0, Decimal(5 if r.random() < 0.97 else 1), Decimal(1)))
    return rows, spark.createDataFrame(rows, "inst_id string, ts timestamp, side string, band int, notional decimal(30,8), base decimal(28,8)")


def wall_model(rows):
    born, out = None, []
    for _, ts, _, _, n, _ in rows:
        age = None
        if n < 5:
            born = None
        elif born is None:
            born = ts.replace(microsecond=0)
        elif (d := (ts - born).total_seconds()) > 3600:
            born = None
        elif d >= 30:
            age = int(d)
        out.append(age)
    return out


@pytest.mark.parametrize("width_s", [None, 3600])
def test_walls_model(spark, width_s):
    rows, df = band_rows(spark, seed=1 if width_s else 9)
    got = book.walls(df, {"X": 5}, width_s=width_s).orderBy("ts").collect()
    assert [r.wall_age for r in got] == wall_model(rows)
    ends = [rows[0], *(r for r in rows if r[4] < 5), rows[-1]]
    assert max(b[1] - a[1] for a, b in zip(ends, ends[1:], strict=False)) > timedelta(hours=3)
    assert all(r.wall_active == (r.wall_age is not None) for r in got)


def test_walls_deal_their_rows_once(spark, monkeypatch):
    """Where no streak outlasts the limit, nothing is written but the rows with their day's starts and the empty list of streaks."""
    names = []
    monkeypatch.setattr(book, "written", lambda df, name="step", real=book.written: (names.append(name), real(df, name))[1])
    rows, df = band_rows(spark, seed=6, n=40)
    got = book.walls(df, {"X": 5}, longest_s=10**6, parts=7)
    assert names == ["bands", "streaks"] and got.count() == len(rows)


def test_streams_equal_batch(spark, tmp_path):
    rows, df = band_rows(spark, 4, 200)
    for i in range(4):  # one file a batch, in order
        spark.createDataFrame(rows[50 * i : 50 * i + 50], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "bands"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "bands"))
    q = streams.walls(stream, {"X": 5}).writeStream.format("memory").queryName("walls").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination()
    assert [r.wall_age for r in spark.table("walls").orderBy("us").collect()] == wall_model(rows)

    _, trades = tape(spark)
    trades.coalesce(1).write.parquet(str(tmp_path / "trades"))
    source = spark.readStream.schema(trades.schema).parquet(str(tmp_path / "trades"))
    for _ in range(2):  # a second run adds nothing
        streams.write_once(streams.candles(source, "5m"), str(tmp_path / "out"), ["inst_id", "window_start"], str(tmp_path / "c2")).awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "out"))
    batch = bars.candles(trades, "5m")
    assert closed.count() > 10 and closed.select(*batch.columns).exceptAll(batch).isEmpty()
    assert closed.count() == closed.select("inst_id", "window_start").distinct().count()


def test_replay_source(spark, tmp_path):
    spark.dataSource.register(replay.Replay)
    spark.range(95).select(F.col("id"), (F.col("id") * 2).alias("v")).coalesce(1).write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.format("tidepool-replay").option("schema", "id long, v long").option("path", str(tmp_path / "t")).option("order", "id").option("rows", "40").load()
    q = stream.writeStream.format("memory").queryName("replayed").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in spark.table("replayed").collect()) == list(range(95))


def test_running_and_blocks(spark):
    r = random.Random(0)
    rows = [("k", i // 7, i, r.randint(-5, 5)) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, day int, i long, v long")
    got = scale.running(df, ["k"], "day", ["i"], {"s": F.col("v")}, {"m": F.col("v")}).orderBy("i").collect()
    assert [(x.s, x.m) for x in got] == [(sum(y[3] for y in rows[: i + 1]), max(y[3] for y in rows[: i + 1])) for i in range(100)]
    dealt = scale.in_blocks(df, ["k"], "i", 10, before=3, after=2)
    assert dealt.where("_own").count() == 100 and dealt.where("_block = 2").count() == 15


def test_sources(spark, tmp_path):
    good = '{"timestamp_utc":"2025-01-02T00:00:59.999000Z","exchange":"okx","market":"perp","instId":"BTC-USDT-SWAP","symbol_canon":"BTC/USDT","trade_id":"1000","side":"buy","price":"100.5","qty_contracts":"2.5","ctVal":"0.01","ctMult":"1","ctType":"linear"}'
    (tmp_path / "a.jsonl").write_text("\n".join([good, "", "{bad", good.replace('"100.5"', '""'), good.replace("BTC-USDT-SWAP", "DOGE")]))
    rows = market.read_lines(spark, str(tmp_path), schemas.TRADES_PERPS)
    assert sum(r[market.BAD] is not None for r in rows.collect()) == 1
    ok, bad = market.split_valid(market.canonical_perps(rows.where(f"{market.BAD} is null")), [adapters.BTC])
    assert [(r.notional, r.trade_id) for r in ok.collect()] == [(Decimal("2.5125"), 1000)] and bad.count() == 2
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "m.jsonl").write_text('{"instId":"A","ctVal":"0.1","tickSz":""}\n{"normalized":{"instId":"B","ctVal":"1"},"raw":{"tickSz":"0.5"}}')
    meta = {r.inst_id: (r.ct_val, r.tick) for r in market.contracts(spark.read.schema(schemas.INSTRUMENTS).json(str(tmp_path / "m"))).collect()}
    assert meta == {"A": (Decimal("0.1"), None), "B": (Decimal("1"), Decimal("0.5"))}
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.jsonl").write_text('{"timestamp_utc":"2025-01-02T00:00:00Z","instId":"A","mid_price":"10","bids_top200":[],"bids":[["9","1","0","2"],["8"]],"asks":[["x","1"],["11","2"]]}')
    (snap,) = market.book_snapshots(spark.read.schema(schemas.BOOK).json(str(tmp_path / "b"))).collect()
    assert [x.price for x in snap.bids] == [9] and [x.price for x in snap.asks] == [11]
    points = spark.createDataFrame([("S", [(1, 2.0), (1, 2.0), (60, 3.0)]), ("T", [(5, 1.0)])], schemas.DERIVATIVES["open_interest"].replace(":long", ":bigint"))
    assert market.derivative_points(points, "S").count() == 2


def test_append_new_is_idempotent(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.lit(1))
    for _ in range(2):
        sinks.append_new(df, str(tmp_path / "t"), ["id"])
    sinks.append_new(spark.range(12).withColumn("v", F.lit(2)), str(tmp_path / "t"), ["id"])
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("v").count().orderBy("v").collect() == [(1, 10), (2, 2)]


def test_bands_at_their_bounds(spark):
    levels = [(1000, 1), (999, 1), (997.5, 1), (949.9, 1), (1001, 9)]
    snap = spark.createDataFrame([("BTC-USDT-SWAP", T0, Decimal(1000), [(Decimal(str(p)), Decimal(q)) for p, q in levels], [])], "inst_id string, ts timestamp, mid decimal(16,4), bids array<struct<price:decimal(16,4),qty:decimal(16,4)>>, asks array<struct<price:decimal(16,4),qty:decimal(16,4)>>")
    (row,) = book.buckets(snap, adapters.meta(spark)).collect()
    assert [float(x) for x in row.bid_base] == [0.02, 0.01, 0, 0, 0, 0] and row.obi == 1 and row.imbalance[0] == 1


def test_level_rows_equal_arrays(spark):
    """Bands of levels in rows are those of arrays: no levels, no mid, levels of the other side of the mid and beyond the last band."""
    r, snaps = random.Random(5), []
    for i in range(60):
        sides = [[(Decimal(r.randint(9300, 10700)) / 10, Decimal(r.randint(1, 99)) / 4) for _ in range(r.choice([0, 1, 5]))] for _ in range(2)]
        snaps.append((i, "BTC-USDT-SWAP" if i % 3 else "ETH-USDT-SWAP", T0 + timedelta(hours=i), Decimal(1000) if i % 10 else None, *sides))
    level = "array<struct<price:decimal(16,4),qty:decimal(16,4)>>"
    df = spark.createDataFrame(snaps, f"seq long, inst_id string, ts timestamp, mid decimal(16,4), bids {level}, asks {level}")
    rows = df.select("seq", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}s").alias("l")) for s in ("bid", "ask")])).alias("x")).select("seq", "x.side", F.inline("x.l"))
    meta = adapters.meta(spark)
    got, want = book.level_buckets(df.drop("bids", "asks"), rows, meta, "seq", parts=5), book.buckets(df, meta)
    key = lambda d: sorted(map(tuple, d.select(*got.columns).collect()))
    assert key(got) == key(want) and want.count() == 54
    names = ["inst_id", "ts", "side", "band", "notional", "delta", "significant"]
    assert sorted(map(tuple, book.bucket_changes(got, 500, parts=5).select(*names).collect())) == sorted(map(tuple, book.changes(book.by_band(want), 500).select(*names).collect()))


def test_tasks_of_books_follow_the_orders(spark, monkeypatch):
    """1,500 orders at 100 a task, whatever the number of shuffle partitions."""
    monkeypatch.setattr(adapters, "ORDERS_A_TASK", 100)
    b = adapters.book(spark, SF)
    flow = book.order_flow(book.buckets(b, adapters.meta(spark)), adapters.book_parts(spark, SF))
    assert b.rdd.getNumPartitions() == 15 and flow.rdd.getNumPartitions() == 15


def test_confluence_all_layers(spark):
    w = spark.createDataFrame([("BTC-USDT-SWAP", "1m", "e", "high", Decimal("100"), T0, "untouched")], "inst_id string, timeframe string, event_id string, wick_type string, price decimal(16,4), created timestamp, status string")
    v = spark.createDataFrame([("BTC-USDT-SWAP", T0, "T4", True)], "inst_id string, ts timestamp, volume_tier string, absorption boolean")
    b = spark.createDataFrame([("BTC-USDT-SWAP", T0, Decimal(100), [Decimal(0)], [Decimal(2_500_000)], [-0.71], [None], [299])], "inst_id string, ts timestamp, mid decimal(16,4), bid_notional array<decimal(30,8)>, ask_notional array<decimal(30,8)>, imbalance array<double>, bid_wall_age array<bigint>, ask_wall_age array<bigint>")
    c = spark.createDataFrame([("BTC-USDT-SWAP", T0, Decimal(-1))], "inst_id string, ts timestamp, cvd_delta decimal(30,8)")
    p = spark.createDataFrame([("BTC-USDT-SWAP", T0, 100.4)], "inst_id string, ts timestamp, vwap_session double")
    (row,) = confluence.score(w, T0 + timedelta(minutes=9), v, b, c, p).collect()
    assert row.score == 100 and row.signals == ["WICK", "VOL_T4", "ABSORPTION", "WALL_2.5M", "IMB_0.71", "YOUNG_299s", "CVD_ALIGNED", "VWAP_SESSION"] and row.direction == "SHORT"
    assert [(r.score, r.signals) for r in confluence.score(w, T0, least=20).collect()] == [(20, ["WICK"])]


def test_as_of_join_carries_over_days(spark):
    left = spark.createDataFrame([("k", T0 + timedelta(days=d), d) for d in range(-1, 5)], "k string, ts timestamp, i int")
    right = spark.createDataFrame([("k", T0, 1), ("k", T0 + timedelta(days=2, hours=1), 2)], "k string, ts timestamp, v int")
    assert [r.v for r in joins.as_of(left, right, ["k"], "ts", ["v"]).orderBy("i").collect()] == [None, 1, 1, 1, 2, 2]


@pytest.mark.parametrize("width", [None, 200])
def test_chunks_model(spark, width):
    """One greedy fold over all records of all files, as the writer of chunks would do it; sizes are those of Python's json."""
    r = random.Random(3)
    rows = [(i // 9, i, r.choice(["x", "é\"\\\n\u0001/日😀", None]) and "ab\"\n" * r.choice([1, 8, 20, 75]), r.choice([None, "user"]), ["t"] * r.choice([0, 1, 3]), 0.1 * r.randint(1, 20)) for i in range(150)]
    rows = [(*x[:5], round(x[5], 2)) for x in rows]
    names = ["file", "i", "text", "role", "topics", "score"]
    df = spark.createDataFrame(rows, "file int, i int, text string, role string, topics array<string>, score double")
    got = topics.chunked(df, ["file", "i"], 200, width=width).orderBy("i").collect()
    size, chunk = 0, 1
    for x, g in zip(rows, got, strict=True):
        n = len(json.dumps(dict(zip(names, x, strict=True)), ensure_ascii=False)) + 10
        assert g["size"] == n
        if size and size + n > 200:
            chunk, size = chunk + 1, 0
        size += n
        assert g.chunk_id == chunk
    assert chunk > 60 and any(g["size"] > 200 for g in got)


def test_text_formats(spark, tmp_path):
    files = {"a.json": '[{"content": "one", "role": "user", "ts": 1}, "two"]', "b.json": '{"messages": [{"text": null, "content": "never", "author": "me"}]}', "c.json": '{"conversations": [{"id": "c1", "messages": [{"body": "three"}]}]}', "d.jsonl": '{"message": "four"}\n\n{bad\n{"text": "five"}', "e.txt": "intro\nUser: six\nAI: seven\neight", "f.md": "User: alone", "g.html": "<p>n&eacute;e &amp;amp; x</p>"}
    for n, t in files.items():
        (tmp_path / n).write_text(t)
    rows = {(r.source_file.rsplit("/", 1)[1], r.message_index): (r.role, r.text) for r in topics.messages(topics.read_corpus(spark, str(tmp_path))).collect()}
    assert rows == {("a.json", 0): ("user", "one"), ("a.json", 1): ("unknown", "two"), ("b.json", 0): ("me", None), ("c.json", 0): ("unknown", "three"), ("d.jsonl", 0): ("unknown", "four"), ("d.jsonl", 3): ("unknown", "five"), ("e.txt", 0): ("user", "six"), ("e.txt", 1): ("ai", "seven\neight"), ("f.md", 0): ("unknown", "User: alone"), ("g.html", 0): ("unknown", "née &amp; x")}


def test_html_records_of_odd_pages_equal_their_sql(spark, duck, tmp_path):
    from tidepool.plans.catalog import ORACLE_SQL, QUERIES

    odd = ["<h1>a&amp;&amp</h1>", "x&copy y&copy; &middot;&amp;nbsp; &nbsp;z", "no\u00a0break\u2003 \x0b &eacute; &#233;", "&amp;lt;b&amp;gt; &lt;i&gt; ", "", None]
    spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    db = duck.cursor()
    db.execute(f"CREATE TEMP VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = {tuple(r) for r in db.execute(ORACLE_SQL["n4_html_records"]).fetchall()}
    assert {tuple(r) for r in QUERIES["n4_html_records"](spark, str(tmp_path)).collect()} == want and len(want) == len(odd)


def test_tags_respect_word_boundaries(spark):
    df = spark.createDataFrame([(1, "adding the tasks up"), (2, "a task to do"), (3, "task"), (4, "see the city trip there")], "i int, text string")
    got = {r.i: (r.topics, r.match_score) for r in topics.tag(df, {"work": ["task", "add"], "travel": ["city trip"]}).collect()}
    assert got == {2: (["work"], 0.1), 4: (["travel"], 0.1)}


def test_manifest(spark):
    from tidepool.plans.catalog import QUERIES, _chunks

    (m,) = topics.manifest(*_chunks(spark, SF)).collect()
    assert m.seen == m.kept + m.dropped and sum(m.topic_counts.values()) >= m.kept
    (q,) = QUERIES["k11_manifest"](spark, SF).collect()
    assert dict(x.split("=") for x in q.topic_counts.split(",")) == {k: str(v) for k, v in m.topic_counts.items()} and q.chunks == m.chunks


def test_values_before_are_carried_over_days(spark):

    t = lambda h: T0.replace(hour=0) + timedelta(hours=h)
    rows = [("a", t(1), 5), ("a", t(23), None), ("a", t(30), 7), ("a", t(31), 8), ("a", t(90), 9), ("b", t(2), 1), (None, t(3), 2), (None, t(40), 3)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    got = {(r.k, r.ts): r.b for r in scale.previous(df, ["k"], F.date_trunc("day", "ts"), ["ts"], F.col("v"), "b").collect()}
    assert len(got) == len(rows) and [got["a", t(h)] for h in (1, 23, 30, 31, 90)] == [None, 5, None, 7, 8]
    assert got["b", t(2)] is None and [got[None, t(h)] for h in (3, 40)] == [None, 2]
    turns = bars.delta_turns(df.where("v is not null and k = 'a'").select(F.col("k").alias("inst_id"), F.col("ts").alias("window_start"), (F.col("v") * F.when(F.col("v") == 7, -1).otherwise(1)).alias("cvd_delta")))
    assert [r.window_start for r in turns.orderBy("window_start").collect()] == [t(30), t(31)]
    gaps = book.sequence_gaps(spark.createDataFrame([("a", t(1), 5, -1), ("a", t(30), 9, 5), ("a", t(60), 20, 12)], "inst_id string, ts timestamp, seqId long, prevSeqId long"))
    assert [r.gap_detected for r in gaps.orderBy("ts").collect()] == [False, False, True]
