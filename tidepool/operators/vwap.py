"""Volume-weighted average prices: session, trailing and anchored, sampled at the first trade of every minute.

A trailing window is the difference of two prefix sums, so its cost doesn't depend on its width. Prefix sums are
looked up by probes: rows without weight that stand in the order of trades. Days are the grain, so an instrument's
whole history is never sorted in one task.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, times
from .scale import previous, running

LAST_ID = 9_223_372_036_854_775_807


def first_per_minute(trades: DataFrame) -> DataFrame:
    """The earliest trade (ts, trade_id) of each instrument and minute."""
    return trades.groupBy("inst_id", times.floor_to(F.col("ts"), "1m").alias("window_start")).agg(F.min(F.struct("ts", "trade_id")).alias("at")).select("inst_id", "window_start", "at.ts", "at.trade_id")


def prefix_sums(trades: DataFrame, probes: DataFrame) -> DataFrame:
    """``probes`` (inst_id, name, window_start, ts, trade_id) with n, pv and trade_count of all trades up to the probe."""
    rows = trades.select("inst_id", "ts", "trade_id", F.lit(0).alias("kind"), "notional", "pv", F.lit(1).cast("long").alias("one"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("timestamp").alias("window_start"))
    asks = probes.select("inst_id", "ts", "trade_id", F.lit(1).alias("kind"), F.lit(0).cast(money.NOTIONAL).alias("notional"), F.lit(0).cast(money.WEIGHTED).alias("pv"), F.lit(0).cast("long").alias("one"), "name", "window_start")
    both = rows.unionByName(asks).withColumn("day", times.day(F.col("ts")))
    summed = running(both, ["inst_id"], "day", ["ts", "trade_id", "kind"], {"n_sum": F.col("notional"), "pv_sum": F.col("pv"), "count_sum": F.col("one")})
    return summed.where("kind = 1").select("inst_id", "name", "window_start", "n_sum", "pv_sum", "count_sum")


def vwap(trades: DataFrame, windows: dict[str, int] | None = None, anchor=None) -> DataFrame:
    """Per instrument and minute: vwap_session, one vwap_<name> and trade_count_<name> per trailing window (seconds),
    vwap_anchored where an anchor is given; null where nothing was traded. Sampled at the minute's first trade."""
    windows = windows or {"1h": 3_600, "4h": 14_400}
    first = first_per_minute(trades)
    here = first.withColumn("name", F.lit("now"))
    probes = here
    for name, seconds in windows.items():
        probes = probes.unionByName(first.withColumn("ts", times.shifted(F.col("ts"), -seconds * 1_000_000 - 1)).withColumn("trade_id", F.lit(LAST_ID)).withColumn("name", F.lit(name)))
    starts = first.withColumn("ts", times.shifted(times.floor_to(F.col("ts"), "1d"), -1)).withColumn("trade_id", F.lit(LAST_ID)).withColumn("name", F.lit("session"))
    probes = probes.unionByName(starts)
    if anchor is not None:
        probes = probes.unionByName(first.withColumn("ts", times.shifted(F.lit(anchor).cast("timestamp"), -1)).withColumn("trade_id", F.lit(LAST_ID)).withColumn("name", F.lit("anchored")))
    sums = prefix_sums(trades, probes)
    names = ["session", *windows, *(["anchored"] if anchor is not None else [])]
    at = {k: {v: F.max(F.when(F.col("name") == k, F.col(v))) for v in ("n_sum", "pv_sum", "count_sum")} for k in ("now", *names)}
    wide = sums.groupBy("inst_id", "window_start").agg(*[c.alias(f"{k}_{v}") for k, cs in at.items() for v, c in cs.items()])
    out = ["inst_id", "window_start"]
    for k in names:
        less = {v: F.col(f"now_{v}") - F.col(f"{k}_{v}") for v in ("n_sum", "pv_sum", "count_sum")}
        value = F.when(less["n_sum"] > 0, money.ratio(less["pv_sum"], less["n_sum"]))
        out += [value.alias(f"vwap_{k}"), F.greatest(less["count_sum"], F.lit(0)).alias(f"trade_count_{k}")]
    return wide.select(*out)


def latest(trades: DataFrame, windows: dict[str, int] | None = None) -> DataFrame:
    """The row of ``vwap`` (without an anchor) of each instrument's last minute. There is one probe an instrument, so sums over the
    trades in reach of it do, and nothing is sorted."""
    windows = windows or {"1h": 3_600, "4h": 14_400}
    at = trades.groupBy("inst_id").agg(times.floor_to(F.max("ts"), "1m").alias("window_start"))
    in_minute = trades.select("inst_id", "ts", "trade_id").join(F.broadcast(at), "inst_id").where(F.col("ts") >= F.col("window_start"))
    probe = in_minute.groupBy("inst_id", "window_start").agg(F.min(F.struct("ts", "trade_id")).alias("_at"))
    us, now = times.micros(F.col("ts")), times.micros(F.col("_at.ts"))
    reach = {"session": us >= times.micros(times.floor_to(F.col("_at.ts"), "1d"))} | {k: us >= now - seconds * 1_000_000 for k, seconds in windows.items()}
    rows = trades.select("inst_id", "ts", "trade_id", "notional", "pv").join(F.broadcast(probe), "inst_id").where(F.struct("ts", "trade_id") <= F.col("_at"))
    rows = rows.where(functools.reduce(lambda a, b: a | b, reach.values()))
    sums = {k: {"n": F.sum(F.when(on, F.col("notional"))), "pv": F.sum(F.when(on, F.col("pv"))), "count": F.count_if(on)} for k, on in reach.items()}
    got = rows.groupBy("inst_id", "window_start").agg(*[c.alias(f"_{k}_{v}") for k, cs in sums.items() for v, c in cs.items()])
    return got.select("inst_id", "window_start", *[c for k in reach for c in (F.when(F.col(f"_{k}_n") > 0, money.ratio(F.col(f"_{k}_pv"), F.col(f"_{k}_n"))).alias(f"vwap_{k}"), F.col(f"_{k}_count").alias(f"trade_count_{k}"))])


def deviation(prices: DataFrame, value: str = "vwap_session") -> DataFrame:
    """Distance of close from a VWAP in basis points, and whether it changed sides since the row before."""
    side = F.signum(F.col("close").cast("double") - F.col(value))
    out = prices.withColumn("deviation_bps", F.round(F.try_divide(F.col("close").cast("double") - F.col(value), F.col(value)) * 10_000, 4)).withColumn("side_of", side)
    out = previous(out, ["inst_id"], times.day(F.col("window_start")), ["window_start"], F.col("side_of"), "side_before")
    return out.withColumn("crossed", F.coalesce(F.col("side_before") * F.col("side_of") < 0, F.lit(False))).drop("side_of", "side_before")
