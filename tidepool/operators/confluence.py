"""Confluence score of untouched wicks against the latest row of each other stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from .book import BANDS, band_of

# Points of each layer; together 100.
POINTS = {"wick": 20, "tier": 15, "absorption": 15, "wall": 15, "imbalance": 10, "young": 10, "cvd": 10, "vwap": 5}


def latest_rows(df: DataFrame, ts: str, as_of=None, keys=("inst_id",)) -> DataFrame:
    """The last row per key by event time, at or before ``as_of``."""
    rows = df if as_of is None else df.where(F.col(ts) <= F.lit(as_of).cast("timestamp"))
    rest = [c for c in df.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), ts).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def near_price(price: Column, value: Column, pct: float) -> Column:
    return F.abs(price.cast("double") - value) <= value * pct / 100


def score(wicks: DataFrame, as_of, volume: DataFrame | None = None, book: DataFrame | None = None, cvd: DataFrame | None = None, vwap: DataFrame | None = None, max_age_minutes: int = 60, wall: float = 1_000_000, imbalance: float = 0.7, young_s: int = 300, vwap_pct: float = 0.5, least: int = 50, bands=BANDS) -> DataFrame:
    """Untouched ``wicks`` (latest state) of at most ``max_age_minutes`` with score, signals, signal_count, direction,
    entry_price and age_minutes; only scores of at least ``least``, highest first. A missing stream gives no points.

    volume: ts, volume_tier, absorption. book: ts, mid, bid_notional, ask_notional, imbalance, and bid_wall_age,
    ask_wall_age (arrays by band). cvd: ts, cvd_delta (the sign of the last window counts). vwap: ts, vwap_session."""
    when = F.lit(as_of).cast("timestamp")
    rows = wicks.where("status = 'untouched'").withColumn("age_minutes", times.age_minutes(when, F.col("created")))
    rows = rows.where((F.col("created") <= when) & (times.micros(F.col("created")) >= F.unix_micros(when) - max_age_minutes * 60_000_000))
    nothing = {"volume_tier": "string", "absorption": "boolean", "mid": "decimal(16,4)", "bid_notional": "array<decimal(30,8)>", "ask_notional": "array<decimal(30,8)>", "imbalance": "array<double>", "bid_wall_age": "array<bigint>", "ask_wall_age": "array<bigint>", "cvd_delta": "decimal(30,8)", "vwap_session": "double"}
    for df, names in ((volume, ("volume_tier", "absorption")), (book, ("mid", "bid_notional", "ask_notional", "imbalance", "bid_wall_age", "ask_wall_age")), (cvd, ("cvd_delta",)), (vwap, ("vwap_session",))):
        if df is None:
            rows = rows.withColumns({n: F.lit(None).cast(nothing[n]) for n in names})
            continue
        have = [n for n in names if n in df.columns]
        rows = rows.join(latest_rows(df.select("inst_id", "ts", *have), "ts", as_of).drop("ts"), "inst_id", "left")
        rows = rows.withColumns({n: F.lit(None).cast(nothing[n]) for n in names if n not in have})
    up = F.col("wick_type") == "high"
    band = band_of(F.col("price"), F.col("mid"), bands)
    at = lambda c: F.get(c, band)
    rows = rows.withColumn("wall_notional", at(F.when(up, F.col("ask_notional")).otherwise(F.col("bid_notional")))).withColumn("skew", F.abs(at(F.col("imbalance")))).withColumn("wall_age", at(F.when(up, F.col("ask_wall_age")).otherwise(F.col("bid_wall_age"))))
    million = F.bround(F.col("wall_notional").cast("double") / 1_000_000, 1)
    layers = [
        (F.lit(True), "wick", F.lit("WICK")),
        (F.col("volume_tier") == "T4", "tier", F.lit("VOL_T4")),
        (F.col("absorption"), "absorption", F.lit("ABSORPTION")),
        (F.col("wall_notional") > F.lit(wall).cast("decimal(20,2)"), "wall", F.concat(F.lit("WALL_"), F.format_string("%.1f", million), F.lit("M"))),
        (F.col("skew") > imbalance, "imbalance", F.concat(F.lit("IMB_"), F.format_string("%.2f", F.col("skew")))),
        ((F.col("wall_age") > 0) & (F.col("wall_age") < young_s), "young", F.concat(F.lit("YOUNG_"), F.col("wall_age").cast("string"), F.lit("s"))),
        (F.when(up, F.col("cvd_delta") < 0).otherwise(F.col("cvd_delta") > 0), "cvd", F.lit("CVD_ALIGNED")),
        (near_price(F.col("price"), F.col("vwap_session"), vwap_pct), "vwap", F.lit("VWAP_SESSION")),
    ]
    total = sum((F.when(F.coalesce(on, F.lit(False)), POINTS[k]).otherwise(0) for on, k, _ in layers), F.lit(0))
    labels = F.array_compact(F.array(*[F.when(on, text) for on, _, text in layers]))
    out = rows.withColumn("score", F.least(total, F.lit(100))).withColumn("signals", labels).where(F.col("score") >= least)
    out = out.select("inst_id", "timeframe", "event_id", "wick_type", "score", "signals", F.size("signals").alias("signal_count"), F.when(up, "SHORT").otherwise("LONG").alias("direction"), F.col("price").alias("entry_price"), "age_minutes")
    return out.orderBy(F.desc("score"), "event_id")
