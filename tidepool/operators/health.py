"""Freshness and status of the derived streams, and the overall state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def component(df: DataFrame, name: str, ts: str, as_of, fresh_minutes: int = 15, **metrics) -> DataFrame:
    """One row: component, status (FRESH, STALE, MISSING), age_minutes, n_rows, attrs (metrics as text)."""
    got = df.agg(F.max(ts).alias("last"), F.count("*").alias("n_rows"), *[c.cast("string").alias(f"_{k}") for k, c in metrics.items()])
    age = ((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("last")) / 60_000_000).cast("long")
    status = F.when(F.col("last").isNull(), "MISSING").when(age < fresh_minutes, "FRESH").otherwise("STALE")
    attrs = F.create_map(*[x for k in metrics for x in (F.lit(k), F.col(f"_{k}"))]) if metrics else F.create_map().cast("map<string,string>")
    return got.select(F.lit(name).alias("component"), status.alias("status"), age.alias("age_minutes"), "n_rows", attrs.alias("attrs"))


def dashboard(parts: list[DataFrame]) -> DataFrame:
    """All components and the overall row; a missing one outweighs a stale one."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    missing, stale = F.count_if(F.col("status") == "MISSING"), F.count_if(F.col("status") == "STALE")
    overall = rows.agg(F.when(missing > 0, "DEGRADED").when(stale > 0, "STALE").otherwise("HEALTHY").alias("status"), F.min("age_minutes").alias("age_minutes"), F.sum("n_rows").alias("n_rows"))
    return rows.unionByName(overall.select(F.lit("overall").alias("component"), "status", "age_minutes", "n_rows", F.create_map().cast("map<string,string>").alias("attrs")))


def per_instrument(df: DataFrame, name: str, ts: str, as_of, instruments: DataFrame, fresh_minutes: int = 15, **metrics) -> DataFrame:
    """``component`` for every row of ``instruments`` (inst_id); one without rows is MISSING, its metrics are left out."""
    got = df.groupBy("inst_id").agg(F.max(ts).alias("last"), *[c.cast("string").alias(f"_{k}") for k, c in metrics.items()])
    rows = instruments.select("inst_id").join(got, "inst_id", "left")
    age = ((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("last")) / 60_000_000).cast("long")
    status = F.when(F.col("last").isNull(), "MISSING").when(age < fresh_minutes, "FRESH").otherwise("STALE")
    attrs = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(f"_{k}")) for k in metrics])
    return rows.select("inst_id", F.lit(name).alias("component"), status.alias("status"), age.alias("age_minutes"), attrs.alias("attrs"))


def five_components(as_of, instruments: DataFrame, wicks: DataFrame, volume: DataFrame, walls: DataFrame, cvd: DataFrame, vwap: DataFrame, recent_minutes: int = 60, young_s: int = 300) -> DataFrame:
    """Per instrument the state of wicks, volume bars, book walls, CVD and VWAP, each with the metrics of its latest row, and of
    all together.

    wicks: created, status. volume: window_start, volume_tier, absorption, divergence. walls: ts, side, wall_age. cvd:
    window_start, cvd_delta. vwap: window_start, vwap_session, vwap_1h. Of walls, CVD and VWAP the last rows of each instrument are
    enough (``book.last_walls``, ``bars.deltas``, ``vwap.latest``). A wick counts while untouched, and as recent
    within ``recent_minutes``; a wall is young below ``young_s`` seconds."""
    end = F.unix_micros(F.lit(as_of).cast("timestamp"))
    open_ = F.col("status") == "untouched"
    at = lambda c: F.max_by(c, "window_start")
    delta = at("cvd_delta")
    last = walls.groupBy("inst_id", "ts").agg(*[F.count_if((F.col("side") == s) & (F.col("wall_age") > 0) & (F.col("wall_age") < young_s)).alias(s) for s in ("bid", "ask")])
    money = lambda c: F.round(F.max_by(c, "window_start"), 2).cast("decimal(18,2)")
    parts = [
        per_instrument(wicks, "wicks", "created", as_of, instruments, untouched=F.count_if(open_), recent=F.count_if(open_ & (F.unix_micros("created") >= end - recent_minutes * 60_000_000))),
        per_instrument(volume, "volume", "window_start", as_of, instruments, tier=at("volume_tier"), absorption=at("absorption"), divergence=at("divergence")),
        per_instrument(last, "walls", "ts", as_of, instruments, young_bid=F.max_by("bid", "ts"), young_ask=F.max_by("ask", "ts")),
        per_instrument(cvd, "cvd", "window_start", as_of, instruments, direction=F.when(delta > 0, "BULLISH").when(delta < 0, "BEARISH").otherwise("NEUTRAL"), delta=money("cvd_delta")),
        per_instrument(vwap, "vwap", "window_start", as_of, instruments, session=money("vwap_session"), hour=money("vwap_1h")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_overall(out)


def with_overall(rows: DataFrame) -> DataFrame:
    """``rows`` of components and one more an instrument: HEALTHY if all are fresh, DEGRADED if one is missing, else STALE, with
    how many are what and the greatest age."""
    n = {s: F.count_if(F.col("status") == s) for s in ("FRESH", "STALE", "MISSING")}
    status = F.when(n["MISSING"] > 0, "DEGRADED").when(n["STALE"] > 0, "STALE").otherwise("HEALTHY")
    attrs = F.concat_ws(", ", *[F.concat(F.lit(f"{s.lower()}="), c.cast("string")) for s, c in n.items()])
    return rows.unionByName(rows.groupBy("inst_id").agg(F.lit("overall").alias("component"), status.alias("status"), F.max("age_minutes").alias("age_minutes"), attrs.alias("attrs")))


def counters(ts: str, bad=None) -> list:
    """Aggregates of one run: rows, rows with ``bad`` true, first and last event time."""
    return [F.count("*").alias("n_rows"), F.count_if(F.lit(False) if bad is None else bad).alias("n_bad"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]


def observed(df: DataFrame, name: str, ts: str, bad=None) -> tuple[DataFrame, Observation]:
    """``df`` and its counters, filled in by whichever action runs it first; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, *counters(ts, bad)), seen
