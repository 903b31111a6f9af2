"""Deduplication and idempotent writes by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; an aggregate, so equal keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    at = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), at).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def unique_trades(trades: DataFrame) -> DataFrame:
    """One row per exchange, instrument and trade id: the earliest."""
    keys = [c for c in ("exchange", "inst_id", "trade_id") if c in trades.columns]
    return first_of(trades, keys, ["ts"])


def unseen(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in ``existing``."""
    return df.join(existing.select(*keys), keys, "left_anti")


def unique_snapshots(snapshots: DataFrame, order: list[str]) -> DataFrame:
    """One book snapshot per instrument and time: the first in ``order``."""
    return first_of(snapshots, ["inst_id", "ts"], order)
