"""Wicks of candles: detection, first touch, life cycle, latest state, neighbourhood.

The first touch of a wick is the next candle that reaches its price within ``hours``. It is found by equality joins
over buckets of candles: a bucket keeps its highest high and lowest low; the wick's own bucket is searched candle by
candle, of the later ones only the first whose extremum reaches the price. The work per wick is the number of buckets
in ``hours`` plus two buckets of candles, whatever the length of history, and no group is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times
from .scale import in_blocks

HOURS = 168
KEYS = ["inst_id", "timeframe"]


def detect(candles: DataFrame) -> DataFrame:
    """One row per wick (none, one or two a candle): event_id, wick_type, price, size, body, created."""
    top, bottom = F.greatest("open", "close"), F.least("open", "close")
    wick = lambda kind, on, price, size: F.when(on, F.struct(F.lit(kind).alias("wick_type"), price.alias("price"), size.alias("wick_size")))
    both = F.array_compact(F.array(wick("high", F.col("high") > top, F.col("high"), F.col("high") - top), wick("low", F.col("low") < bottom, F.col("low"), bottom - F.col("low"))))
    rows = candles.select(*KEYS, F.col("window_end").alias("created"), F.abs(F.col("close") - F.col("open")).alias("body_size"), F.explode(both).alias("w")).select(*KEYS, "created", "body_size", "w.*")
    return rows.withColumn("event_id", F.concat_ws("|", "inst_id", "timeframe", F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "wick_type"))


def _reached(kind: Column, price: Column, high: Column, low: Column) -> Column:
    return F.when(kind == "high", high >= price).otherwise(low <= price)


def first_touch(wicks: DataFrame, candles: DataFrame, hours: int = HOURS, bucket_us: int = times.MICROS["4h"]) -> DataFrame:
    """``wicks`` with ``touch``, the first later candle that reaches the price within ``hours``, or null."""
    limit = hours * 3_600_000_000
    end = times.micros(F.col("window_end"))
    bars = candles.select(*KEYS, F.floor(end / bucket_us).alias("bucket"), end.alias("end_us"), "open", "high", "low", "close")
    tops = bars.groupBy(*KEYS, "bucket").agg(F.max("high").alias("top"), F.min("low").alias("bottom"))
    w = wicks.select(*KEYS, "event_id", "wick_type", "price", times.micros(F.col("created")).alias("born"))
    own = F.floor(F.col("born") / bucket_us)
    later = w.withColumn("bucket", F.explode(F.sequence(own + 1, F.floor((F.col("born") + limit) / bucket_us))))
    hit = later.join(tops, [*KEYS, "bucket"]).where(_reached(F.col("wick_type"), F.col("price"), F.col("top"), F.col("bottom")))
    hit = hit.groupBy("event_id").agg(F.min("bucket").alias("bucket"))
    search = w.withColumn("bucket", own).unionByName(w.join(hit, "event_id").select(*w.columns, "bucket"))
    found = search.join(bars, [*KEYS, "bucket"]).where((F.col("end_us") > F.col("born")) & (F.col("end_us") < F.col("born") + limit)).where(_reached(F.col("wick_type"), F.col("price"), F.col("high"), F.col("low")))
    touch = found.groupBy("event_id").agg(F.min_by(F.struct(F.timestamp_micros("end_us").alias("ts"), "open", "high", "low", "close"), F.col("end_us")).alias("touch"))
    return wicks.join(touch, "event_id", "left")


def lifecycle(wicks: DataFrame, candles: DataFrame, ticks: DataFrame | None = None, hours: int = HOURS, near: int = 1, close: int = 3, batch_expiry: bool = False) -> DataFrame:
    """Status of every wick as of its series' last candle, and how it was touched.

    touched: a touch within ``hours``; else expired: as old as ``hours``; else untouched. ``batch_expiry`` tests the age
    first, as a run over a whole batch does. ``ticks`` (inst_id, tick) gives distances in ticks; without one they're null."""
    as_of = candles.groupBy(*KEYS).agg(F.max("window_end").alias("as_of"))
    rows = first_touch(wicks, candles, hours).join(as_of, KEYS)
    rows = rows.join(F.broadcast(ticks.select("inst_id", F.col("tick").cast("decimal(16,8)").alias("tick"))), "inst_id", "left") if ticks is not None else rows.withColumn("tick", F.lit(None).cast("decimal(16,8)"))
    old = times.micros(F.col("as_of")) >= times.micros(F.col("created")) + hours * 3_600_000_000
    t, p = F.col("touch"), F.col("price")
    touched = t.isNotNull() & (~old if batch_expiry else F.lit(True))
    rows = rows.withColumn("status", F.when(touched, "touched").when(old, "expired").otherwise("untouched")).withColumn("touch", F.when(touched, t))
    body = (F.least(t["open"], t["close"]) <= p) & (p <= F.greatest(t["open"], t["close"]))
    reach = F.when(F.col("wick_type") == "high", t["high"]).otherwise(t["low"])
    gap = F.abs(reach - p)
    steps = F.when(F.col("tick") > 0, F.floor(gap / F.col("tick")).cast("long"))
    strength = F.when(steps == 0, "EXACT").when(steps <= near, "NEAR").when(steps <= close, "CLOSE").when(steps.isNotNull(), "TOUCHED")
    return rows.select(
        *KEYS, "event_id", "wick_type", "price", "wick_size", "body_size", "created", "as_of", "status", t["ts"].alias("touch_ts"),
        F.when(t.isNotNull(), body).alias("touch_by_body"), F.when(t.isNotNull(), F.when(body, "both").otherwise("wick")).alias("touch_class"),
        steps.alias("tip_distance_ticks"), steps.alias("penetration_ticks"), strength.alias("signal_strength"), F.when(t.isNotNull(), times.age_minutes(t["ts"], F.col("created"))).alias("touch_age_minutes"),
    )


def change_log(states: DataFrame) -> DataFrame:
    """Append-only events: every wick untouched at birth, then its end, in order ``seq``."""
    born = states.select("event_id", *KEYS, "wick_type", "price", F.col("created").alias("at"), F.lit("untouched").alias("status"), F.lit(0).alias("seq"))
    over = states.where("status <> 'untouched'").select("event_id", *KEYS, "wick_type", "price", F.coalesce("touch_ts", "as_of").alias("at"), "status", F.lit(1).alias("seq"))
    return born.unionByName(over)


def latest(log: DataFrame) -> DataFrame:
    """The last entry of each event."""
    rest = [c for c in log.columns if c != "event_id"]
    return log.groupBy("event_id").agg(F.max_by(F.struct(*rest), "seq").alias("r")).select("event_id", "r.*")


def neighbours(states: DataFrame, minutes: int = 10) -> DataFrame:
    """Counts of other wicks, touched and not, created within ``minutes`` either side, in linear time."""
    us = minutes * 60_000_000
    rows = states.withColumn("_us", times.micros(F.col("created")))
    dealt = in_blocks(rows, KEYS, "_us", max(us, times.MICROS["1d"]), before=us, after=us)
    w = Window.partitionBy(*KEYS, "_block").orderBy("_us").rangeBetween(-us, us)
    is_touched = (F.col("status") == "touched").cast("long")
    out = dealt.withColumn("nearby", F.count("*").over(w) - 1).withColumn("nearby_touched", F.sum(is_touched).over(w) - is_touched)
    return out.where("_own").drop("_us", "_block", "_own")


def hidden(states: DataFrame, as_of, age_min: int = 20, age_max: int = 40, least: int = 10, minutes: int = 10) -> DataFrame:
    """Untouched wicks of a certain age with many touched neighbours: HIGH, or VERY_HIGH from half as many more."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - times.micros(F.col("created"))) / 60_000_000
    rows = neighbours(states, minutes).withColumn("age_minutes", age)
    rows = rows.where("status = 'untouched'").where(F.col("age_minutes").between(age_min, age_max) & (F.col("nearby_touched") >= least))
    return rows.withColumn("confidence", F.when(F.col("nearby_touched") >= least + least // 2, "VERY_HIGH").otherwise("HIGH")).orderBy(F.desc("nearby_touched"), "event_id")
