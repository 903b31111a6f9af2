"""Candles, volume bars and cumulative volume delta over canonical trades (inst_id, ts, trade_id, side, price, qty, notional, pv).

Windows without a trade give no bar. Ties in time go by trade_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, times
from .scale import in_blocks, previous, running

LADDER = ("5m", "15m", "1h", "4h")


def _bounds(df: DataFrame, timeframe: str) -> DataFrame:
    return df.withColumn("timeframe", F.lit(timeframe)).withColumn("window_end", times.shifted(F.col("window_start"), times.MICROS[timeframe]))


def candles(trades: DataFrame, timeframe: str = "1m") -> DataFrame:
    """Open, high, low, close, volume (contracts) and count per instrument and window."""
    at = F.struct("ts", "trade_id")
    out = trades.groupBy("inst_id", times.floor_to(F.col("ts"), timeframe).alias("window_start")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("qty").alias("volume"), F.count("*").alias("trade_count"),
    )
    return _bounds(out, timeframe)


def roll_up(fine: DataFrame, timeframe: str) -> DataFrame:
    """Coarser candles from finer ones, never from trades again."""
    out = fine.groupBy("inst_id", times.floor_to(F.col("window_start"), timeframe).alias("window_start")).agg(
        F.min_by("open", F.col("window_start")).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", F.col("window_start")).alias("close"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"),
    )
    return _bounds(out, timeframe)


def all_timeframes(minute: DataFrame, timeframes=LADDER) -> DataFrame:
    """The minute candles and every coarser timeframe, in one table from one aggregate."""
    frames = [t for t in timeframes if t != "1m"]
    start = lambda t: times.floor_to(F.col("window_start"), t)
    spread = minute.select("*", F.explode(F.array(*[F.struct(F.lit(t).alias("tf"), start(t).alias("start"), F.lit(times.MICROS[t]).alias("us")) for t in frames])).alias("to"))
    coarse = spread.groupBy("inst_id", F.col("to.tf").alias("timeframe"), F.col("to.start").alias("window_start"), F.col("to.us").alias("us")).agg(
        F.min_by("open", F.col("window_start")).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", F.col("window_start")).alias("close"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"),
    ).withColumn("window_end", F.timestamp_micros(times.micros(F.col("window_start")) + F.col("us"))).drop("us")
    return minute.unionByName(coarse.select(*minute.columns))


def volume_bars(trades: DataFrame, timeframe: str = "1m", whale: float = 100_000) -> DataFrame:
    """Notional bought, sold (any side but buy) and in all, by large trades, with price change and delta."""
    at, n = F.struct("ts", "trade_id"), F.col("notional")
    big = n >= F.lit(whale).cast(money.NOTIONAL)
    zero = F.lit(0).cast(money.NOTIONAL)
    out = trades.groupBy("inst_id", times.floor_to(F.col("ts"), timeframe).alias("window_start")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum(n).alias("total_volume"), F.sum(F.when(F.col("side") == "buy", n).otherwise(zero)).alias("buy_volume"), F.sum(F.when(F.col("side") == "buy", zero).otherwise(n)).alias("sell_volume"),
        F.sum(F.when(big, n).otherwise(zero)).alias("whale_volume"), F.count_if(big).alias("whale_count"), F.count("*").alias("trade_count"),
    )
    out = out.withColumn("delta", F.col("buy_volume") - F.col("sell_volume"))
    return _bounds(out.withColumn("price_change_pct", change_pct(F.col("open"), F.col("close"))), timeframe)


def change_pct(first: Column, last: Column) -> Column:
    return F.try_divide(((last - first) * 100).cast("double"), first.cast("double"))


def deltas(trades: DataFrame, timeframe: str = "1m") -> DataFrame:
    """Signed notional per window; other sides than buy and sell don't count."""
    known = trades.where(F.col("side").isin("buy", "sell"))
    signed = F.when(F.col("side") == "buy", F.col("notional")).otherwise(-F.col("notional"))
    return known.groupBy("inst_id", times.floor_to(F.col("ts"), timeframe).alias("window_start")).agg(F.sum(signed).cast("decimal(30,8)").alias("cvd_delta"))


def cvd(trades: DataFrame, timeframe: str = "1m") -> DataFrame:
    """``deltas`` and their running sum, which never resets."""
    bars = deltas(trades, timeframe).withColumn("day", times.day(F.col("window_start")))
    return running(bars, ["inst_id"], "day", ["window_start"], {"cvd_value": F.col("cvd_delta")}).drop("day")


def cvd_at_close(minute_cvd: DataFrame, timeframe: str) -> DataFrame:
    """The running value at the end of each coarser window, its net delta, and the gross flow: its minutes' deltas without sign."""
    start = times.floor_to(F.col("window_start"), timeframe).alias("start")
    return minute_cvd.groupBy("inst_id", start).agg(F.max_by("cvd_value", "window_start").alias("cvd_value"), F.sum("cvd_delta").alias("cvd_delta"), F.sum(F.abs("cvd_delta")).alias("gross")).withColumnRenamed("start", "window_start")


def delta_turns(minute_cvd: DataFrame) -> DataFrame:
    """Windows whose delta has the opposite sign of the one before, be it of an earlier day."""
    rows = previous(minute_cvd, ["inst_id"], times.day(F.col("window_start")), ["window_start"], F.col("cvd_delta"), "before")
    return rows.where(F.signum("cvd_delta") * F.signum("before") < 0)


def pivots(candles: DataFrame, n: int = 3, block: int = 5_000) -> DataFrame:
    """``candles`` with pivot_high and pivot_low: the highest high, or lowest low, of the ``n`` candles either side (of equal
    ones the first). A candle with fewer neighbours on a side is none yet, so a pivot is known ``n`` candles later."""
    rows = candles.withColumn("_day", times.day(F.col("window_start")))
    rows = running(rows, ["inst_id"], "_day", ["window_start"], {"_place": F.lit(1).cast("long")}).drop("_day")
    dealt = in_blocks(rows, ["inst_id"], "_place", max(block, n), before=n, after=n)
    w = Window.partitionBy("inst_id", "_block").orderBy("_place")
    back, ahead = w.rowsBetween(-n, -1), w.rowsBetween(1, n)
    full = (F.count("*").over(back) == n) & (F.count("*").over(ahead) == n)
    high = full & (F.col("high") > F.max("high").over(back)) & (F.col("high") >= F.max("high").over(ahead))
    low = full & (F.col("low") < F.min("low").over(back)) & (F.col("low") <= F.min("low").over(ahead))
    return dealt.withColumn("pivot_high", high).withColumn("pivot_low", low).where("_own").drop("_place", "_block", "_own")


def divergences(candles: DataFrame, flow: DataFrame, n: int = 3, flat_pct: float = 0.1, percent: int = 30, block: int = 5_000) -> DataFrame:
    """Where price and flow disagree: inst_id, window_start, pattern, direction. ``flow`` has cvd_value, cvd_delta and gross (the
    flow without sign) of the same windows.

    absorption: a pivot low below the pivot low before it, or no more than ``flat_pct`` percent above, while the running delta
    fell by ``percent`` of the gross flow between them: selling that didn't move the price. exhaustion: a pivot high above the
    one before it while the running delta fell as much. delta_turn: a falling window whose net delta is bought, by ``percent`` of its gross
    flow at least, or a rising one that is sold. A pivot's pattern is known ``n`` windows later."""
    rows = candles.select("inst_id", "window_start", "open", "high", "low", "close").join(flow.select("inst_id", "window_start", "cvd_value", "cvd_delta", "gross"), ["inst_id", "window_start"])
    rows = running(rows.withColumn("_day", times.day(F.col("window_start"))), ["inst_id"], "_day", ["window_start"], {"_flow": F.col("gross")}).drop("_day")
    rows = pivots(rows, n, block)

    def swings(kind: str, price: str) -> DataFrame:
        p = rows.where(f"pivot_{kind}")
        p = previous(p, ["inst_id"], times.day(F.col("window_start")), ["window_start"], F.struct(F.col(price).alias("price"), "cvd_value", "_flow"), "before")
        b = F.col("before")
        return p.where((b["cvd_value"] - F.col("cvd_value")) * 100 >= (F.col("_flow") - b["_flow"]) * percent).where(b["cvd_value"] > F.col("cvd_value"))

    named = lambda df, pattern, direction: df.select("inst_id", "window_start", F.lit(pattern).alias("pattern"), F.lit(direction).alias("direction") if isinstance(direction, str) else direction.alias("direction"))
    held = F.col("low") * 100 <= F.col("before.price") * F.lit(100 + flat_pct).cast("decimal(8,4)")
    against = F.signum((F.col("close") - F.col("open")).cast("double")) * F.signum(F.col("cvd_delta").cast("double")) < 0
    turned = rows.where(against & (F.abs("cvd_delta") * 100 >= F.col("gross") * percent))
    out = named(swings("low", "low").where(held), "absorption", "BULLISH").unionByName(named(swings("high", "high").where(F.col("high") > F.col("before.price")), "exhaustion", "BEARISH"))
    return out.unionByName(named(turned, "delta_turn", F.when(F.col("cvd_delta") > 0, "BEARISH").otherwise("BULLISH")))
