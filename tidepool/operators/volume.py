"""Volume signals over bars: tier, modified z-score, absorption, divergence against the previous bars.

The history is the last ``lookback`` bars of the instrument before the current one. Bars are numbered (a running
count) and dealt to blocks, each with an ordered window of its history (``medians.before``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from .medians import before
from .scale import running

LOOKBACK, BLOCK = 100, 5_000


def signals(bars: DataFrame, lookback: int | None = LOOKBACK, flat_pct: float = 0.1, anomaly: float = 3.5, block: int = BLOCK) -> DataFrame:
    """``bars`` with volume_tier, median_volume, modified_z_score, volume_anomaly, absorption, divergence.

    ``lookback`` None takes the whole history, as its definition asks."""
    v = F.col("total_volume").cast("decimal(28,8)")
    rows = bars.withColumn("_v", v).withColumn("_day", times.day(F.col("window_start")))
    rows = running(rows, ["inst_id"], "_day", ["window_start"], {"_place": F.lit(1).cast("long")})
    got = before(rows.select(F.col("inst_id").alias("key"), F.col("_place").alias("place"), (F.col("_v") * 100_000_000).alias("value")), lookback, block)
    got = got.select(F.col("key").alias("inst_id"), F.col("place").alias("_place"), F.col("n").alias("_n"), (F.col("twice") * F.lit("0.000000005").cast("decimal(9,9)")).cast("decimal(30,9)").alias("median_volume"), (F.col("upper") * F.lit("0.00000001").cast("decimal(9,8)")).cast("decimal(30,8)").alias("_up"), (F.col("four").cast("double") / 400_000_000).alias("_mad"))
    rows = rows.join(got, ["inst_id", "_place"])
    m, pct, d = F.col("median_volume"), F.col("price_change_pct"), F.col("delta")
    flat = F.when(m.isNull() | (m == 0), "T2").when(F.col("_v") > 2 * m, "T4").when(F.col("_v") > m, "T3").when(2 * F.col("_v") > m, "T2").otherwise("T1")
    z = F.when((F.col("_n") >= 3) & (F.col("_mad") != 0), 0.6745 * (F.col("_v").cast("double") - m.cast("double")) / F.col("_mad"))
    absorbed = (F.col("_n") > 0) & (F.col("_up") != 0) & (F.abs(pct) <= flat_pct) & (F.col("_v") > 2 * F.col("_up"))
    out = rows.withColumn("volume_tier", flat).withColumn("volume_anomaly", F.coalesce(F.abs(z) > anomaly, F.lit(False))).withColumn("modified_z_score", F.round(z, 6))
    out = out.withColumn("absorption", F.coalesce(absorbed, F.lit(False))).withColumn("divergence", F.coalesce(F.signum(pct) * F.signum(d.cast("double")) < 0, F.lit(False)))
    return out.drop("_v", "_day", "_place", "_n", "_up", "_mad")
