"""Joins that Spark has no operator for: as-of, interval, and point in band."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times


def as_of(left: DataFrame, right: DataFrame, keys: list[str], ts: str, columns: list[str]) -> DataFrame:
    """``left`` with ``columns`` of the last ``right`` row per key at or before its time, or nulls.

    Both sides go through one window by key and day; the last values of earlier days are carried over, so a key's
    history isn't sorted in one task. Equal times on the right: the larger struct of columns counts."""
    value = F.struct(*columns)
    a = left.withColumn("_row", F.struct(*left.columns)).select(*keys, F.col(ts).alias("_ts"), F.lit(1).alias("_kind"), "_row", F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("_v"))
    b = right.select(*keys, F.col(ts).alias("_ts"), F.lit(0).alias("_kind"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), value.alias("_v"))
    both = a.unionByName(b).withColumn("_day", times.day(F.col("_ts")))
    per = both.groupBy(*keys, "_day").agg(F.max_by("_v", F.when(F.col("_kind") == 0, F.struct("_ts", "_v"))).alias("_last"))
    carry = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_carry", F.last("_last", ignorenulls=True).over(carry)).drop("_last")
    inside = Window.partitionBy(*keys, "_day").orderBy("_ts", "_kind", "_v").rowsBetween(Window.unboundedPreceding, 0)
    got = both.withColumn("_in", F.last("_v", ignorenulls=True).over(inside)).where("_kind = 1").join(per, [*keys, "_day"])
    found = F.coalesce("_in", "_carry")
    return got.select("_row.*", *[found[c].alias(c) for c in columns])


def interval(left: DataFrame, right: DataFrame, keys: list[str], low: str, high: str, point: str, width: int) -> DataFrame:
    """Pairs with low <= point <= high, by an equality join on buckets of ``width`` (all columns are longs); ``width``
    should be near the usual length of an interval. Columns of the sides must have different names but for the keys."""
    cut = left.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    spots = right.withColumn("_bucket", F.floor(F.col(point) / width))
    return cut.join(spots, [*keys, "_bucket"]).where((F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))).drop("_bucket")
