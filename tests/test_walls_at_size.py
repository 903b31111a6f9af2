"""Band sums and walls that stay one row a snapshot: equal to the long form, and no instrument's rows in one task."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidepool.operators import bars, book, vwap

T0 = datetime(2024, 3, 1, 22, 50)
PRICE = "decimal(16,4)"


def meta(spark):
    return spark.createDataFrame([("X", Decimal("0.5")), ("Y", Decimal("0.1"))], "inst_id string, ct_val decimal(8,4)")


def books(spark, n=40, seed=3):
    """Snapshots and levels whose distances lie on the bands' bounds and next to them; some snapshots have no level."""
    r = random.Random(seed)
    heads, levels = [], []
    for k in range(n):
        mid = Decimal(r.choice(["333.3333", "1000", "0.0421", "77777.7777"]))
        heads.append((k, r.choice("XY"), T0 + timedelta(seconds=2 * k), mid))
        for _ in range(r.choice([0, 1, 5, 30])):
            edge = mid * r.choice(book.BANDS) / 10_000
            off = (edge.quantize(Decimal("0.0001")) + r.choice([-1, 0, 1]) * Decimal("0.0001")) * r.choice([1, 1, 1, -1])
            side = r.choice(["bid", "ask"])
            levels.append((k, side, mid - off if side == "bid" else mid + off, Decimal(r.randint(1, 99))))
    return heads, levels, spark.createDataFrame(heads, f"seq long, inst_id string, ts timestamp, mid {PRICE}"), spark.createDataFrame(levels, f"seq long, side string, price {PRICE}, qty {PRICE}")


@pytest.mark.parametrize("parts", [None, 5])
def test_bands_at_their_bounds(spark, parts):
    heads, levels, h, lv = books(spark)
    got = {r.seq: r for r in book.level_buckets(h, lv, meta(spark), "seq", parts=parts).collect()}
    assert len(got) == len(heads)
    for seq, inst, _, mid in heads:
        want = {"bid": [Decimal(0)] * len(book.BANDS), "ask": [Decimal(0)] * len(book.BANDS)}
        for k, side, price, qty in levels:
            if k == seq and (price <= mid if side == "bid" else price >= mid):
                place = next((i for i, b in enumerate(book.BANDS) if abs(price - mid) * 10_000 <= mid * b), None)
                if place is not None:
                    want[side][place] += qty * Decimal("0.5" if inst == "X" else "0.1") * price
        assert {s: got[seq][f"{s}_notional"] for s in want} == {s: [x.quantize(Decimal("1e-8")) for x in v] for s, v in want.items()}


def test_contracts_dont_deal_rows_by_instrument(spark):
    """Contracts made in the session have no known size, so a plain join with them deals all levels of an instrument to one task."""
    _, _, h, lv = books(spark, 4)
    arrays = lv.groupBy("seq").agg(*[F.collect_list(F.when(F.col("side") == s, F.struct("price", "qty"))).alias(f"{s}s") for s in ("bid", "ask")])
    for df in (book.level_buckets(h, lv, meta(spark), "seq", parts=3), book.buckets(h.join(arrays, "seq"), meta(spark))):
        assert "hashpartitioning(inst_id" not in df._jdf.queryExecution().executedPlan().toString()


def bucket_rows(spark, n=300, seed=5, keep=0.8):
    r = random.Random(seed)
    rows = []
    for inst in "XY":
        at = T0
        for _ in range(n):
            at += timedelta(seconds=r.choice([2, 2.5, 10, 29, 600]))
            side = lambda: [Decimal(5 if r.random() < (0.995 if i == 2 else keep) else 1) for i in range(len(book.BANDS))]
            rows.append((inst, at, side(), side()))
    return spark.createDataFrame(rows, "inst_id string, ts timestamp, bid_notional array<decimal(30,8)>, ask_notional array<decimal(30,8)>")


def plain(df):
    return sorted((r.inst_id, r.ts, r.side, r.band, r.wall_age, r.wall_active) for r in df.collect())


@pytest.mark.parametrize("longest_s", [900, 10**7])
def test_walls_of_bucket_rows(spark, monkeypatch, longest_s):
    made = {}
    monkeypatch.setattr(book, "written", lambda df, name="step", real=book.written: made.setdefault(name, real(df, name)))
    rows = bucket_rows(spark).withColumns({f"{s}_base": F.col(f"{s}_notional") for s in ("bid", "ask")})
    least = {"X": 5, "Y": 5}
    got = book.bucket_walls(rows, least, longest_s=longest_s, parts=7)
    assert made["bands"].count() == rows.count()  # a row a snapshot, not one a band
    assert ("lasting" in made) == (longest_s == 900)
    made.clear()
    want = plain(book.walls(book.by_band(rows), least, longest_s=longest_s))
    assert plain(got) == want and any(w[-1] for w in want)
    made.clear()
    assert plain(book.bucket_walls(rows, least, longest_s=longest_s, bands=(1, 2))) == [w for w in want if w[3] in (1, 2)]
    made.clear()
    ends = {k: max(w[1] for w in want if w[0] == k) for k in least}
    assert plain(book.last_walls(rows, least, longest_s=longest_s, parts=7)) == [w for w in want if w[1] == ends[w[0]]]


def test_last_walls_at_every_end(spark):
    """Cut after any snapshot, the last one's walls are those that it has among all."""
    rows = bucket_rows(spark, 60, 8, 0.9).where("inst_id = 'X'").cache()
    want = plain(book.bucket_walls(rows, {"X": 5}, longest_s=900))
    for at in sorted({w[1] for w in want})[::15]:
        assert plain(book.last_walls(rows.where(F.col("ts") <= F.lit(at)), {"X": 5}, longest_s=900)) == [w for w in want if w[1] == at]


def trades(spark, n=400, seed=2):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        at = T0 + timedelta(seconds=r.choice([0.0, 1, 59]) + 37 * k)
        rows.append((r.choice("XY"), at, k, r.choice(["buy", "sell", "other"]), Decimal(r.randint(100, 900)), Decimal(r.randint(1, 50))))
    df = spark.createDataFrame(rows, f"inst_id string, ts timestamp, trade_id long, side string, price {PRICE}, notional decimal(24,8)")
    return df.withColumn("pv", (F.col("notional") * F.col("price")).cast("decimal(30,8)"))


def test_latest_vwap_is_the_last_row(spark):
    t = trades(spark)
    last = {}
    for r in vwap.vwap(t, windows={"1h": 3600, "5s": 5}).collect():
        last[r.inst_id] = max(last.get(r.inst_id, r), r, key=lambda x: x.window_start)
    got = vwap.latest(t, {"1h": 3600, "5s": 5})
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[c] for c in got.columns) for r in last.values())
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_deltas_are_those_of_cvd(spark):
    t = trades(spark)
    pick = lambda df: sorted((r.inst_id, r.window_start, r.cvd_delta) for r in df.collect())
    assert pick(bars.deltas(t)) == pick(bars.cvd(t))
