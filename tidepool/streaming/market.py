"""Streaming forms of the market operators; run with ``trigger(availableNow=True)`` they equal a resumed batch job.

Late rows: every operator takes a watermark delay; windows are emitted once closed, and later rows are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import times
from ..operators.book import WALLS
from ..sources.sinks import append_new

SPANS = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "4h": "4 hours"}


def unique_trades(trades: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The first row of each trade id within the watermark."""
    keys = [c for c in ("exchange", "inst_id", "trade_id") if c in trades.columns]
    return trades.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


def candles(trades: DataFrame, timeframe: str = "1m", delay: str = "1 minute") -> DataFrame:
    """Closed candles only (append mode)."""
    at = F.struct("ts", "trade_id")
    out = trades.withWatermark("ts", delay).groupBy("inst_id", F.window("ts", SPANS[timeframe]).alias("w")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("qty").alias("volume"), F.count("*").alias("trade_count"),
    )
    return out.select("inst_id", F.col("w.start").alias("window_start"), "open", "high", "low", "close", "volume", "trade_count", F.lit(timeframe).alias("timeframe"), F.col("w.end").alias("window_end"))


def deltas(trades: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Signed notional of closed minutes; the running sum is taken where the result is read."""
    signed = F.when(F.col("side") == "buy", F.col("notional")).otherwise(-F.col("notional"))
    out = trades.where(F.col("side").isin("buy", "sell")).withWatermark("ts", delay).groupBy("inst_id", F.window("ts", "1 minute").alias("w")).agg(F.sum(signed).alias("cvd_delta"))
    return out.select("inst_id", F.col("w.start").alias("window_start"), "cvd_delta")


def _wall(least: dict[str, float], rest: int, longest: int):
    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        born = state.get[0] if state.exists else None
        f = pd.concat(list(frames)).sort_values("us")
        age = []
        for us, notional in zip(f["us"], f["notional"].astype(float), strict=True):
            a = None
            if notional < least[key[0]]:
                born = None
            elif born is None:
                born = us - us % 1_000_000
            elif us - born > longest:
                born = None
            elif us - born >= rest:
                a = (us - born) // 1_000_000
            age.append(a)
        if born is None:
            state.remove()
        else:
            state.update((int(born),))
        yield pd.DataFrame({"inst_id": key[0], "side": key[1], "band": key[2], "us": f["us"], "wall_age": pd.array(age, dtype="Int64"), "wall_active": [a is not None for a in age]})

    return run


def walls(long_rows: DataFrame, thresholds: dict[str, float] | None = None, rest_s: int = 30, longest_s: int = 3600) -> DataFrame:
    """Wall age and activity per snapshot, side and band; one number of state a key. Snapshots of a key must arrive in
    order from batch to batch."""
    run = _wall({k: float(v) for k, v in (thresholds or WALLS).items()}, rest_s * 1_000_000, longest_s * 1_000_000)
    rows = long_rows.withColumn("us", times.micros(F.col("ts")))
    return rows.groupBy("inst_id", "side", "band").applyInPandasWithState(run, "inst_id string, side string, band int, us long, wall_age long, wall_active boolean", "born long", "append", GroupStateTimeout.NoTimeout)


def write_once(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Append rows of new keys only, whatever is replayed; ends when all input there is has been read."""
    return stream.writeStream.foreachBatch(lambda df, _: append_new(df, path, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
