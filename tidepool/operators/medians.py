"""Median, upper middle and median deviation of the values before each row, over the last so many or over all.

A window is kept in order: a value is inserted where it belongs and the oldest is dropped, so a row costs a search and no sort.
The median deviation is read off the same order: the k values nearest to the median stand together in it, and a binary search
finds where they begin. Rows are dealt to blocks with what stands before them:

* over the last ``lookback`` rows, as many rows in front of each block;
* over all rows, everything in front (place and value only). A key is cut into ``parts`` blocks at most, so it is copied
  parts / 2 times; rows are bars, whose number is bounded by the time they cover, not by the trades in them.

Values are whole units, so everything is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import in_blocks

UNITS = "decimal(28,0)"
PARTS, LOAD = 16, 2_000


class Ordered:
    """A growing sorted list in buckets, so that inserting doesn't move all of it."""

    def __init__(self, values: list[int], load: int = LOAD):
        self.load = load
        self._deal(sorted(values))

    def _deal(self, values: list[int]) -> None:
        self.parts = [values[i : i + self.load] for i in range(0, len(values), self.load)] or [[]]
        self._count()

    def _count(self) -> None:
        self.first = [p[0] for p in self.parts if p]
        self.ends = np.cumsum([len(p) for p in self.parts])

    def __len__(self) -> int:
        return int(self.ends[-1])

    def __getitem__(self, i: int) -> int:
        k = int(self.ends.searchsorted(i, "right"))
        return self.parts[k][i - (int(self.ends[k - 1]) if k else 0)]

    def add(self, value: int) -> None:
        k = max(bisect_right(self.first, value) - 1, 0)
        part = self.parts[k]
        insort(part, value)
        if len(part) > 2 * self.load:
            self.parts[k : k + 1] = [part[: self.load], part[self.load :]]
            self._count()
        else:
            self.first[k : k + 1] = [part[0]]
            self.ends[k:] += 1


def middle(w) -> tuple[int, int, int]:
    """Of an ordered sequence: twice its median, its element at half the length, four times its median deviation."""
    n = len(w)
    upper = w[n // 2]
    twice = upper + w[(n - 1) // 2]
    # the n // 2 + 1 values nearest to the median are w[low : low + n // 2 + 1]
    low, high, k = 0, n - n // 2 - 1, n // 2 + 1
    while low < high:
        at = (low + high) // 2
        if twice - 2 * w[at] > 2 * w[at + k] - twice:
            low = at + 1
        else:
            high = at
    a, z = twice - 2 * w[low], 2 * w[low + k - 1] - twice
    far = max(a, z)
    if n % 2:
        return twice, upper, 2 * far
    # the next nearest: without the farthest one
    less = max(twice - 2 * w[low + 1], z) if a >= z else max(a, 2 * w[low + k - 2] - twice)
    return twice, upper, far + less


def _ints(column: pa.ChunkedArray) -> list[int]:
    try:
        return column.cast(pa.int64()).to_pylist()
    except pa.ArrowInvalid:  # beyond 64 bits
        return [int(x) for x in column.to_pylist()]


def _units(values) -> pa.Array:
    kind = pa.decimal128(28, 0)
    try:
        return pa.array(values, pa.int64()).cast(pa.decimal128(19, 0)).cast(kind)
    except (OverflowError, pa.ArrowInvalid):
        return pa.array([None if v is None else Decimal(v) for v in values], kind)


def _rolling(lookback: int | None):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("place")
        values, own, places = _ints(t.column("value")), t.column("_own").to_pylist(), t.column("place").to_pylist()
        begin = own.index(True) if True in own else len(own)
        out: list[tuple] = []
        if lookback is None:
            w = Ordered(values[:begin])
            for v in values[begin:]:
                out.append((len(w), *middle(w)) if len(w) else (0, None, None, None))
                w.add(v)
        else:
            at = max(begin - lookback, 0)
            w = sorted(values[at:begin])
            for i in range(begin, len(values)):
                out.append((len(w), *middle(w)) if w else (0, None, None, None))
                insort(w, values[i])
                if len(w) > lookback:
                    del w[bisect_left(w, values[i - lookback])]
        n, twice, upper, four = zip(*out, strict=True) if out else ((), (), (), ())
        key = t.column("key").slice(begin)
        return pa.table({"key": key, "place": pa.array(places[begin:], pa.int64()), "n": pa.array(n, pa.int64()), "twice": _units(twice), "upper": _units(upper), "four": _units(four)})

    return run


def before(rows: DataFrame, lookback: int | None, block: int, parts: int = PARTS) -> DataFrame:
    """For ``rows`` (key, place, value): key, place, and of the values before it n, twice (the median), upper, four (times the
    median deviation). ``place`` counts the rows of a key from 1; ``value`` is in whole units; ``lookback`` None is all."""
    rows = rows.select("key", "place", F.col("value").cast(UNITS).alias("value"))
    if lookback is None:
        size = rows.groupBy("key").agg(F.greatest(F.ceil(F.max("place") / parts), F.lit(block)).alias("_size"), F.max("place").alias("_last"))
        at = F.floor((F.col("place") - 1) / F.col("_size"))
        rows = rows.join(size, "key").withColumn("_block", F.explode(F.sequence(at, F.floor((F.col("_last") - 1) / F.col("_size"))))).withColumn("_own", F.col("_block") == at).drop("_size", "_last")
    else:
        rows = in_blocks(rows, ["key"], "place", max(block, lookback), before=lookback)
    kind = f"key string, place long, n long, twice {UNITS}, upper {UNITS}, four {UNITS}"
    return rows.groupBy("key", "_block").applyInArrow(_rolling(lookback), kind)
