"""Stateful streams on ``transformWithState``: trailing VWAP, running CVD with late rows, wick log, order books from updates.

State lives in RocksDB: sessions set ``spark.sql.streaming.stateStore.providerClass`` to ``PROVIDER`` (:func:`configure`).
Amounts in state are whole units of 1e-8, so sums are exact.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import money, times

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE, DAY = times.MICROS["1m"], times.MICROS["1d"]
UNITS = "decimal(38,0)"


def configure(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


def units(amount: Column) -> Column:
    return (amount * 100_000_000).cast(UNITS)


def _amount(units_: Column) -> Column:
    return (units_.cast("decimal(38,8)") / 100_000_000).cast("decimal(30,8)")


class Trailing(StatefulProcessor):
    """Rows (us, trade_id, n, pv) of one instrument to sums over trailing windows, at the first trade of each closed minute.

    State: a map from minute to its trades and to the sums of all trades before it, the minutes still kept, and the running
    totals. A minute is closed by its timer; then minutes that no window of a later minute reaches are evicted. A window's
    start falls into one kept minute, whose trades are the only ones looked at, so a closed minute costs one look-up a window.
    """

    def __init__(self, windows: dict[str, int]):
        self.windows, self.longest = windows, max(windows.values())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "minute long", f"n {UNITS}, pv {UNITS}, trades long, us array<long>, id array<long>, ns array<{UNITS}>, pvs array<{UNITS}>")
        self.known = handle.getValueState("known", "open array<long>, closed array<long>")
        self.total = handle.getValueState("total", f"n {UNITS}, pv {UNITS}, trades long, day long, day_n {UNITS}, day_pv {UNITS}, day_trades long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        waiting, closed = self.known.get() if self.known.exists() else ([], [])
        waiting = list(waiting)
        for f in rows:
            for minute, part in f.groupby(f.us // MINUTE):
                minute = int(minute)
                got = [part[c].tolist() for c in ("us", "trade_id", "n", "pv")]
                if minute in waiting:
                    got = [list(a) + b for a, b in zip(self.minutes.getValue((minute,))[3:], got, strict=True)]
                else:
                    waiting.append(minute)
                    self.handle.registerTimer((minute + 1) * 60_000)
                self.minutes.updateValue((minute,), (Decimal(0), Decimal(0), 0, *got))
        self.known.update((sorted(waiting), list(closed)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        waiting, closed = (list(x) for x in self.known.get())
        upto = expiredTimerInfo.getExpiryTimeInMs() // 60_000
        out = [self._close(m, closed) for m in waiting if m < upto]
        if out:
            self.known.update(([m for m in waiting if m >= upto], closed))
            yield pd.DataFrame([{"inst_id": key[0], **r} for r in out])

    def _close(self, minute: int, closed: list[int]) -> dict:
        n, pv, trades, day, *at_day = self.total.get() if self.total.exists() else (Decimal(0), Decimal(0), 0, None, Decimal(0), Decimal(0), 0)
        before = int(n), int(pv), trades
        *_, us, ids, ns, pvs = self.minutes.getValue((minute,))
        rows = sorted(zip(us, ids, map(int, ns), map(int, pvs), strict=True))
        if day != minute * MINUTE // DAY:
            day, at_day = minute * MINUTE // DAY, [Decimal(before[0]), Decimal(before[1]), trades]
        first = rows[0]
        now = before[0] + first[2], before[1] + first[3], trades + 1
        starts = {"session": tuple(map(int, at_day))} | {name: self._upto(first[0] - w, closed, rows, before) for name, w in self.windows.items()}
        out = {"us": minute * MINUTE}
        for name, start in starts.items():
            out |= {f"n_{name}": Decimal(now[0] - start[0]), f"pv_{name}": Decimal(now[1] - start[1]), f"trade_count_{name}": now[2] - start[2]}
        self.minutes.updateValue((minute,), (Decimal(before[0]), Decimal(before[1]), trades, *([r[i] for r in rows] for i in (0, 1)), *([Decimal(r[i]) for r in rows] for i in (2, 3))))
        self.total.update((Decimal(before[0] + sum(r[2] for r in rows)), Decimal(before[1] + sum(r[3] for r in rows)), trades + len(rows), day, *at_day))
        closed.append(minute)
        old = bisect_left(closed, minute - self.longest // MINUTE - 1)
        for m in closed[:old]:
            self.minutes.removeKey((m,))
        del closed[:old]
        return out

    def _upto(self, edge: int, closed: list[int], current: list[tuple], before: tuple[int, int, int]) -> tuple[int, int, int]:
        """Sums of all trades before ``edge``."""
        i = bisect_left(closed, edge // MINUTE)
        if i == len(closed):
            base, rows = before, current
        else:
            n, pv, trades, us, _, ns, pvs = self.minutes.getValue((closed[i],))
            base, rows = (int(n), int(pv), trades), zip(us, [0] * len(us), map(int, ns), map(int, pvs), strict=True)
        less = [r for r in rows if r[0] < edge]
        return base[0] + sum(r[2] for r in less), base[1] + sum(r[3] for r in less), base[2] + len(less)


def vwap(trades: DataFrame, windows: dict[str, int] | None = None, delay: str = "1 minute") -> DataFrame:
    """The streaming form of ``operators.vwap.vwap`` without an anchor: a row for each minute that the watermark has passed.

    ``windows``: name to seconds. Trades later than the watermark are dropped, as the closed minutes have gone out."""
    windows = windows or {"1h": 3_600, "4h": 14_400}
    rows = trades.withWatermark("ts", delay).select("inst_id", "ts", times.micros(F.col("ts")).alias("us"), "trade_id", units(F.col("notional")).alias("n"), units(F.col("pv")).alias("pv"))
    names = ["session", *windows]
    kind = "inst_id string, us long" + "".join(f", n_{k} {UNITS}, pv_{k} {UNITS}, trade_count_{k} long" for k in names)
    out = rows.groupBy("inst_id").transformWithStateInPandas(Trailing({k: v * 1_000_000 for k, v in windows.items()}), kind, "Append", "EventTime")
    value = lambda k: F.when(F.col(f"n_{k}") > 0, money.ratio(_amount(F.col(f"pv_{k}")), _amount(F.col(f"n_{k}"))))
    return out.select("inst_id", F.timestamp_micros("us").alias("window_start"), *[c for k in names for c in (value(k).alias(f"vwap_{k}"), F.col(f"trade_count_{k}"))])


def _partial_deltas(batches):
    """Signed sums and latest times by instrument and minute of a task's rows: what the shuffle carries."""
    for b in batches:
        t = pa.Table.from_batches([b]).group_by(["inst_id", "minute"]).aggregate([("signed", "sum"), ("us", "max")])
        signed = t.column("signed_sum").cast(pa.decimal128(38, 0))
        yield from pa.table({"inst_id": t.column("inst_id"), "minute": t.column("minute"), "signed": signed, "us": t.column("us_max")}).to_batches()


class Running(StatefulProcessor):
    """Partial deltas (minute, signed, us) of one instrument to closed minutes with the running sum.

    A minute is closed once a row ``delay`` later than its end was seen. A row for a closed minute still counts in the sum of
    the minutes that are closed after it, but the minute's own row has gone out and isn't changed."""

    def __init__(self, delay: int):
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", f"sum {UNITS}, closed long, latest long, late long")
        self.waiting = handle.getMapState("waiting", "minute long", f"signed {UNITS}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        total, closed, latest, late = self.total.get() if self.total.exists() else (0, -(2**62), -(2**62), 0)
        total = int(total)
        fresh: dict[int, int] = {}
        for f in rows:
            for minute, signed, us in zip(f.minute.tolist(), f.signed, f.us.tolist(), strict=True):
                latest = max(latest, us)
                if minute <= closed:
                    total, late = total + int(signed), late + 1
                else:
                    fresh[minute] = fresh.get(minute, 0) + int(signed)
        have = {k[0]: int(v[0]) for k, v in self.waiting.iterator()}
        for m, v in fresh.items():
            have[m] = have.get(m, 0) + v
        ready = sorted(m for m in have if m + MINUTE + self.delay <= latest)
        out = []
        for m in ready:
            total += have[m]
            out.append((key[0], m, Decimal(have[m]), Decimal(total)))
        for m in ready:
            if self.waiting.containsKey((m,)):
                self.waiting.removeKey((m,))
        for m in fresh.keys() - set(ready):
            self.waiting.updateValue((m,), (Decimal(have[m]),))
        self.total.update((Decimal(total), max(closed, ready[-1]) if ready else closed, latest, late))
        if out:
            yield pd.DataFrame(out, columns=["inst_id", "minute", "delta", "sum"])


def cvd(trades: DataFrame, delay: str = "1m") -> DataFrame:
    """The streaming form of ``operators.bars.cvd``: closed minutes with cvd_delta and the running cvd_value.

    Two steps: every task sums its trades by instrument and minute, then one state an instrument adds these few rows up. Late
    trades move the sum but not a closed bar (see :class:`Running`); the stream has no watermark, so none is dropped."""
    signed = F.when(F.col("side") == "buy", units(F.col("notional"))).otherwise(-units(F.col("notional"))).cast(UNITS)
    us = times.micros(F.col("ts"))
    rows = trades.where(F.col("side").isin("buy", "sell")).select("inst_id", (us - F.pmod(us, F.lit(MINUTE))).alias("minute"), signed.alias("signed"), us.alias("us"))
    parts = rows.mapInArrow(_partial_deltas, f"inst_id string, minute long, signed {UNITS}, us long")
    out = parts.groupBy("inst_id").transformWithStateInPandas(Running(times.duration(delay)), f"inst_id string, minute long, delta {UNITS}, sum {UNITS}", "Append", "None")
    return out.select("inst_id", F.timestamp_micros("minute").alias("window_start"), _amount(F.col("delta")).alias("cvd_delta"), _amount(F.col("sum")).alias("cvd_value"))


TICK = 10_000


class OpenWicks(StatefulProcessor):
    """Candles (end_us, open, high, low, close in whole ticks) of one series to changes of state of its wicks.

    State: the open wicks as two lists in order of price. A candle reaches the high wicks up to its high and the low wicks down to
    its low: one end of each list, found by a search, so the others aren't looked at. Every birth has a timer at its expiry, which
    takes the wicks of that birth that are still open, whether or not a candle comes."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "high array<long>, high_born array<long>, low array<long>, low_born array<long>")

    def _load(self) -> tuple[list, list]:
        """(price, birth) of the high wicks, and (-price, birth) of the low ones, both ascending."""
        h, hb, low, lb = self.open.get() if self.open.exists() else ([], [], [], [])
        return list(zip(h, hb, strict=True)), list(zip(low, lb, strict=True))

    def _save(self, highs: list, lows: list) -> None:
        self.open.update(tuple([x[i] for x in side] for side in (highs, lows) for i in (0, 1)))

    def _frame(self, key, out: list) -> pd.DataFrame:
        rows = pd.DataFrame(out, columns=["kind", "units", "born", "at_us", "status"])
        return rows.assign(inst_id=key[0], timeframe=key[1])[["inst_id", "timeframe", "kind", "units", "born", "at_us", "status"]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        highs, lows = self._load()
        out: list[tuple] = []
        for c in pd.concat(list(rows)).sort_values("end_us").itertuples():
            for kind, side, reach in ((1, highs, c.high), (-1, lows, -c.low)):
                hit = bisect_right(side, (reach, 2**62))
                for price, born in side[:hit]:
                    late = c.end_us >= born + self.limit
                    out.append((kind, kind * price, born, born + self.limit if late else c.end_us, "expired" if late else "touched"))
                del side[:hit]
            for kind, side, price, there in ((1, highs, c.high, c.high > max(c.open, c.close)), (-1, lows, -c.low, c.low < min(c.open, c.close))):
                if there:
                    insort(side, (price, c.end_us))
                    self.handle.registerTimer((c.end_us + self.limit) // 1000)
                    out.append((kind, kind * price, c.end_us, c.end_us, "untouched"))
        self._save(highs, lows)
        if out:
            yield self._frame(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        upto = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.limit
        sides, out = self._load(), []
        for kind, side in zip((1, -1), sides, strict=True):
            out += [(kind, kind * price, born, born + self.limit, "expired") for price, born in side if born <= upto]
            side[:] = [x for x in side if x[1] > upto]
        self._save(*sides)
        if out:
            yield self._frame(key, out)


def wick_log(candles: DataFrame, hours: int = 168, delay: str = "0 seconds") -> DataFrame:
    """Changes of state of wicks as candles close: untouched at birth, then touched or expired within ``hours``; the streaming
    form of ``operators.wicks.change_log``. An expiry goes out when the watermark passes it, also if no candle of its series
    comes, with ``at`` its own time. Candles of a series must arrive in order from batch to batch."""
    units_ = lambda c: F.round(F.col(c) * TICK).cast("long").alias(c)
    rows = candles.withWatermark("window_end", delay).select("inst_id", "timeframe", "window_end", times.micros(F.col("window_end")).alias("end_us"), *[units_(c) for c in ("open", "high", "low", "close")])
    kind = "inst_id string, timeframe string, kind long, units long, born long, at_us long, status string"
    log = rows.groupBy("inst_id", "timeframe").transformWithStateInPandas(OpenWicks(hours * 3_600_000_000), kind, "Append", "EventTime")
    side = F.when(F.col("kind") == 1, "high").otherwise("low")
    event = F.concat_ws("|", "inst_id", "timeframe", F.date_format(F.timestamp_micros("born"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), side)
    return log.select(event.alias("event_id"), "inst_id", "timeframe", side.alias("wick_type"), (F.col("units") / TICK).cast("decimal(16,4)").alias("price"), F.timestamp_micros("at_us").alias("at"), "status")


LEVELS = "array<struct<price:string,qty:string>>"


def checksum(bids: list[tuple[str, str]], asks: list[tuple[str, str]], depth: int = 25) -> int:
    """Signed CRC32 over price:size of the best levels, bid and ask by turns; a side that ends early is passed over."""
    parts = [f"{p}:{q}" for i in range(depth) for side in (bids, asks) for p, q in side[i : i + 1]]
    crc = zlib.crc32(":".join(parts).encode())
    return crc - (1 << 32) if crc >> 31 else crc


class Book(StatefulProcessor):
    """Messages of one instrument (us, action, seq, prev_seq, bids, asks, checksum) to book snapshots.

    State: a map from (side, price) to size, and the last sequence number. A ``snapshot`` replaces the book; an ``update`` sets
    sizes, 0 takes a level away. An update that doesn't follow the last number is a gap: the book as it was goes out with
    ``gap_detected``, is cleared, and nothing more is made until the next ``snapshot``. A checksum that doesn't agree is
    reported and changes nothing. Snapshots go out ``every`` so many microseconds of event time."""

    def __init__(self, every: int, depth: int):
        self.every, self.depth = every, depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "side string, price string", "qty string")
        self.last = handle.getValueState("last", "seq long, out long, ready boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        seq, shown, ready = self.last.get() if self.last.exists() else (None, None, False)
        was = {k: v[0] for k, v in self.levels.iterator()}
        book = dict(was)
        for r in sorted(rows, key=lambda r: (r.us, r.seq)):
            fresh, gap = r.action == "snapshot", False
            if not fresh and not ready:
                continue
            if fresh:
                book = {}
            elif r.prev_seq != seq:
                gap = True
            if gap:
                yield self._snapshot(key, r, book, True, None)
                book, ready, seq, shown = {}, False, None, None
                continue
            for side, levels in (("bid", r.bids), ("ask", r.asks)):
                for level in levels or []:
                    if Decimal(level["qty"]) == 0:
                        book.pop((side, level["price"]), None)
                    else:
                        book[(side, level["price"])] = level["qty"]
            seq, ready = r.seq, True
            good = None if r.checksum is None else checksum(*self._sides(book, 25)) == r.checksum
            if fresh or good is False or shown is None or r.us - shown >= self.every:
                shown = r.us
                yield self._snapshot(key, r, book, False, good)
        for k in was.keys() - book.keys():
            self.levels.removeKey(k)
        for k, q in book.items():
            if was.get(k) != q:
                self.levels.updateValue(k, (q,))
        self.last.update((seq, shown, ready))

    @staticmethod
    def _sides(book: dict, depth: int) -> tuple[list, list]:
        side = lambda name, sign: sorted(((p, q) for (s, p), q in book.items() if s == name), key=lambda x: sign * Decimal(x[0]))[:depth]
        return side("bid", -1), side("ask", 1)

    def _snapshot(self, key, r, book: dict, gap: bool, good) -> Row:
        bids, asks = self._sides(book, self.depth)
        return Row(inst_id=key[0], us=r.us, seq=r.seq, prev_seq=r.prev_seq, bids=[{"price": p, "qty": q} for p, q in bids], asks=[{"price": p, "qty": q} for p, q in asks], gap_detected=gap, checksum_ok=good)


def books(messages: DataFrame, every: str = "2s", depth: int = 400) -> DataFrame:
    """Snapshots (inst_id, ts, mid, bids, asks with typed levels, seqId, prevSeqId, gap_detected, checksum_ok) of book messages
    (inst_id, ts, action, seqId, prevSeqId, bids, asks, checksum), whose levels have price and qty as text. mid is null where a
    side is empty. Messages of an instrument must arrive in order from batch to batch."""
    rows = messages.select("inst_id", times.micros(F.col("ts")).alias("us"), "action", F.col("seqId").alias("seq"), F.col("prevSeqId").alias("prev_seq"), F.col("bids").cast(LEVELS).alias("bids"), F.col("asks").cast(LEVELS).alias("asks"), F.col("checksum").cast("long").alias("checksum"))
    kind = f"inst_id string, us long, seq long, prev_seq long, bids {LEVELS}, asks {LEVELS}, gap_detected boolean, checksum_ok boolean"
    out = rows.groupBy("inst_id").transformWithState(Book(times.duration(every), depth), kind, "Append", "None")
    typed = f"array<struct<price:{money.PRICE},qty:{money.QTY}>>"
    best = lambda c: F.get(F.col(c), F.lit(0))["price"]
    out = out.select("inst_id", F.timestamp_micros("us").alias("ts"), F.col("bids").cast(typed).alias("bids"), F.col("asks").cast(typed).alias("asks"), F.col("seq").alias("seqId"), F.col("prev_seq").alias("prevSeqId"), "gap_detected", "checksum_ok")
    return out.withColumn("mid", ((best("bids") + best("asks")) / 2).cast(money.PRICE))
