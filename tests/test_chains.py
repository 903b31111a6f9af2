"""Greedy chains against a walk from row to row, over blocks of many sizes."""

import random

import pytest

from tidepool.operators import chains


def walk(rows, skip):
    out, i = [], 0
    while i < len(rows):
        out.append(i)
        j = i + 1
        while j < len(rows) and rows[j][1] <= rows[i][2]:
            j += 1
        i = j + skip
    return out


@pytest.mark.parametrize(("skip", "width", "fan"), [(0, 100, 2), (1, 150, 3), (0, 1600, 64), (1, 100, 8)])
def test_starts(spark, skip, width, fan):
    r = random.Random(skip + width)
    series = {}
    for name, n in (("a", 400), ("b", 1), ("c", 60), ("wide", 120)):
        at, rows = 0, []
        for _ in range(n):
            size = r.choice([1, 5, 30, 99, 100, 101, 700] if name == "wide" else [1, 2, 7, 20, 60])
            if skip:  # positions with gaps; a limit counts from the position rounded down
                rows.append((at, at, at - at % 3 + 100 if at - at % 3 + 100 > at else at))
                at += size * r.choice([0, 1, 1, 9])
            else:
                rows.append((at, at + size, at + 100))
                at += size
        series[name] = rows
    flat = [(k, i, *x) for k, rows in series.items() for i, x in enumerate(rows)]
    df = spark.createDataFrame(flat, "series string, place long, at long, end long, limit long").repartition(5)
    got = {}
    for x in chains.starts(df, 100, skip, width, fan).collect():
        got.setdefault(x.series, []).append(x.place)
    assert {k: sorted(v) for k, v in got.items()} == {k: walk(v, skip) for k, v in series.items()}
    assert chains.starts(df.limit(0), 100, skip, width, fan).count() == 0
