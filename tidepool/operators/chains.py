"""Greedy chains: starts that follow from each other, found without working through a series in one task.

In a series each row, taken as a start, decides the next one: the row behind all that its ``limit`` holds, or ``skip`` rows
later. Chunks of bounded size and walls that start anew after an hour are such chains. Only the first start is known, so the
others seem to need a walk from row to row. But what a start leads to doesn't depend on how it was reached, so pieces of the
series can be worked out before their entry is known:

1. Rows are dealt to blocks by their position, with the rows that a limit can reach behind each block. In a block, pointers to
   the next start are doubled until they leave the block, which gives the exit for every row where a chain can enter.
2. ``fan`` blocks are composed to one with the same kind of map, level after level.
3. From the top down, each block is told its entry, and at last the rows of a block are walked from theirs.

A chain enters a block within ``reach`` of its beginning, so the maps hold a share of reach / width of the rows, and no group is
larger than the rows of one block and what is behind it, or ``fan`` maps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import in_blocks
from .written import written

FAN = 64
MAP = "series string, block long, lo long, hi long, exits array<long>"
ENTRY = "series string, block long, entry long"


def _pointers(t: pa.Table, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's rows and those behind it: places and positions of its own rows, and the next start of each, counted from
    the block's first row."""
    place, at, end, limit, own = (t.column(c).to_numpy() for c in ("place", "at", "end", "limit", "_own"))
    order = np.argsort(place)
    n = int(own.sum())
    mine = order[:n]
    held = np.searchsorted(end[order], limit[mine], "right") - 1
    return place[mine], at[mine], np.maximum(held, np.arange(n)) + 1 + skip


def _mapped(width: int, reach: int, skip: int):
    def run(t: pa.Table) -> pa.Table:
        place, at, to = _pointers(t, skip)
        n = len(place)
        if not n:
            return pa.table({"series": t.column("series")[:0], "block": t.column("_block")[:0], "lo": pa.array([], pa.int64()), "hi": pa.array([], pa.int64()), "exits": pa.array([], pa.list_(pa.int64()))})
        while (inside := to < n).any():
            to = np.where(inside, to[np.minimum(to, n - 1)], to)
        block = t.column("_block")[0].as_py()
        heads = min(n, int(np.searchsorted(at, block * width + reach, "left")) + 1 + skip)
        return pa.table({"series": t.column("series")[:1], "block": t.column("_block")[:1], "lo": pa.array([place[0]]), "hi": pa.array([place[-1]]), "exits": pa.array([place[0] + to[:heads]], pa.list_(pa.int64()))})

    return run


def _maps(t: pa.Table) -> list[tuple[int, int, int, np.ndarray]]:
    return sorted(zip(t.column("block").to_pylist(), t.column("lo").to_pylist(), t.column("hi").to_pylist(), map(np.array, t.column("exits").to_pylist()), strict=True), key=lambda m: m[0])


def _composed(fan: int, skip: int):
    def run(t: pa.Table) -> pa.Table:
        maps = _maps(t)
        block, lo, hi, first = maps[0]
        more = 1 + skip if len(first) == hi - lo + 1 else 0  # the last places where a chain can enter may lie in the next blocks
        last = maps[-1][2]
        at = lo + np.arange(min(len(first) + more, last - lo + 1))
        for _, low, high, exits in maps:
            here = (at >= low) & (at <= high)
            at[here] = exits[at[here] - low]
        return pa.table({"series": t.column("series")[:1], "block": pa.array([block // fan]), "lo": pa.array([lo]), "hi": pa.array([last]), "exits": pa.array([at], pa.list_(pa.int64()))})

    return run


def _entered(t: pa.Table, above: pa.Table) -> pa.Table:
    """The entries of a group's blocks, from the group's own."""
    out = []
    if t.num_rows and above.num_rows:
        at = above.column("entry")[0].as_py()
        for block, low, high, exits in _maps(t):
            if low <= at <= high:
                out.append((block, at))
                at = int(exits[at - low])
    series = t.column("series")[0].as_py() if t.num_rows else None
    return pa.table({"series": pa.array([series] * len(out), pa.string()), "block": pa.array([b for b, _ in out], pa.int64()), "entry": pa.array([e for _, e in out], pa.int64())})


def _walked(skip: int):
    def run(t: pa.Table, above: pa.Table) -> pa.Table:
        got = []
        if t.num_rows and above.num_rows:
            place, _, to = _pointers(t, skip)
            at, to = above.column("entry")[0].as_py() - int(place[0]), to.tolist()
            while at < len(to):
                got.append(int(place[0]) + at)
                at = to[at]
        series = t.column("series")[0].as_py() if t.num_rows else None
        return pa.table({"series": pa.array([series] * len(got), pa.string()), "place": pa.array(got, pa.int64())})

    return run


def starts(rows: DataFrame, reach: int, skip: int = 0, width: int | None = None, fan: int = FAN) -> DataFrame:
    """The starts (series, place) of the chains that begin at place 0 of every series.

    rows: series (text), place (0, 1, .. in the series), at, end, limit (longs that don't fall with place; at <= limit <= at +
    ``reach``). The start after one at row i is the first row behind i whose end is above i's limit, and ``skip`` rows later.
    ``width`` of a block, at least ``reach``, and ``fan`` change the work only. The rows and the maps are written once."""
    width = max(width or 16 * reach, reach)
    rows = written(rows.select("series", "place", "at", "end", "limit"), "chain-rows")
    dealt = in_blocks(rows, ["series"], "at", width, before=0, after=reach)
    maps = [written(dealt.groupBy("series", "_block").applyInArrow(_mapped(width, reach, skip), MAP), "chain-maps")]
    last = maps[0].agg(F.max("block")).first()[0]
    if last is None:
        return rows.select("series", "place")
    while last >= fan:
        maps.append(written(maps[-1].groupBy("series", F.floor(F.col("block") / fan).alias("_up")).applyInArrow(_composed(fan, skip), MAP), "chain-maps"))
        last //= fan
    entries = maps[-1].groupBy("series").agg(F.min("lo").alias("entry")).select(F.concat("series").alias("series"), F.lit(0).cast("long").alias("block"), "entry")
    for k, level in enumerate(reversed(maps)):
        up = F.floor(F.col("block") / fan) if k else F.lit(0).cast("long")
        entries = level.groupBy("series", up.alias("_up")).cogroup(entries.groupBy("series", "block")).applyInArrow(_entered, ENTRY)
    return dealt.groupBy("series", "_block").cogroup(entries.groupBy("series", "block")).applyInArrow(_walked(skip), "series string, place long")
