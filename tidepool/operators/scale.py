"""Ordered analytics without one task per key.

A key such as an instrument may hold a third of all rows, so a window over the key alone is one task. These helpers
cut a key's rows into grains (days, blocks), work inside the grains, and carry small per-grain values across: the only
window over the whole key runs over one row per grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parts_for(rows: int, each: int, least: int = 1) -> int:
    """How many tasks share ``rows``, so that none has more than about ``each``, whatever the input's size."""
    return max(least, -(-rows // each))


def spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` dealt to ``parts`` tasks by its keys; as the session's number of shuffle partitions has it without ``parts``."""
    return df.repartition(parts, *keys) if parts else df


def running(df: DataFrame, keys: list[str], grain: str, order: list, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with running sums and maxima per key, up to and including each row in (grain, order), in ``parts`` tasks."""
    sums, maxima = sums or {}, maxima or {}
    values = {f"_v_{n}": c for n, c in (sums | maxima).items()}
    rows = df.withColumns(values)
    per = rows.groupBy(*keys, grain).agg(*[(F.sum if n in sums else F.max)(f"_v_{n}").alias(f"_g_{n}") for n in sums | maxima])
    before = Window.partitionBy(*keys).orderBy(grain).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, grain, *[(F.sum if n in sums else F.max)(f"_g_{n}").over(before).alias(f"_b_{n}") for n in sums | maxima])
    inside = Window.partitionBy(*keys, grain).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = spread(rows, parts, *keys, grain).withColumns({f"_r_{n}": (F.sum if n in sums else F.max)(f"_v_{n}").over(inside) for n in sums | maxima})
    rows = rows.join(per, [*keys, grain])
    out = {n: F.coalesce(f"_b_{n}", F.lit(0)) + F.coalesce(f"_r_{n}", F.lit(0)) for n in sums} | {n: F.greatest(f"_b_{n}", f"_r_{n}") for n in maxima}
    return rows.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def previous(df: DataFrame, keys: list[str], grain: Column, order: list[str], value: Column, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with ``value`` of the row before, by (grain, order) within the keys, in ``parts`` tasks; null for a key's first row.
    What is carried over, one row a key and grain, is broadcast if ``parts`` is given, so that the rows are dealt once."""
    rows = df.withColumns({"_grain": grain, "_value": F.struct(value.alias("v"))})
    last = rows.groupBy(*keys, "_grain").agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    carry = last.select(*keys, "_grain", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_grain")).alias("_carry"))
    carry = F.broadcast(carry) if parts else carry
    rows = spread(rows, parts, *keys, "_grain").withColumn("_in", F.lag("_value").over(Window.partitionBy(*keys, "_grain").orderBy(*order)))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*keys, "_grain")]
    return rows.alias("r").join(carry.alias("c"), same, "left").select(*[F.col(f"r.{c}") for c in df.columns], F.coalesce("r._in", "c._carry")["v"].alias(name))


def in_blocks(df: DataFrame, keys: list[str], place: str, block: int, before: int, after: int = 0) -> DataFrame:
    """``df`` dealt to blocks of the long column ``place``, with the rows up to ``before`` below and ``after`` above
    each block copied into it; ``_block`` and ``_own`` (False for copies) are added. ``before``, ``after`` <= ``block``."""
    at = F.floor(F.col(place) / block)
    low, high = F.floor((F.col(place) - after) / block), F.floor((F.col(place) + before) / block)
    dealt = df.withColumn("_at", at).withColumn("_block", F.explode(F.sequence(low, high)))
    return dealt.withColumn("_own", F.col("_block") == F.col("_at")).drop("_at")
