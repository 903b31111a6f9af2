"""Medians and median deviations of ordered windows against sorting."""

import random

import pytest

from tidepool.operators import medians


def plain(values):
    s = sorted(values)
    n = len(s)
    twice = s[n // 2] + s[(n - 1) // 2]
    d = sorted(abs(2 * x - twice) for x in s)
    return twice, s[n // 2], d[n // 2] + d[(n - 1) // 2]


def test_middle():
    r = random.Random(1)
    for n in range(1, 40):
        for top in (1, 3, 1000, 10**25):
            w = [r.randint(0, top) for _ in range(n)]
            assert medians.middle(sorted(w)) == plain(w)


def test_ordered():
    r = random.Random(2)
    values = [r.randint(0, 50) for _ in range(30)]
    w = medians.Ordered(values, load=4)
    for _ in range(200):
        values.append(r.randint(-20, 70))
        w.add(values[-1])
        assert [w[i] for i in range(len(w))] == sorted(values)
    empty = medians.Ordered([])
    assert len(empty) == 0
    empty.add(3)
    assert empty[0] == 3 and medians.middle(empty) == (6, 3, 0)


@pytest.mark.parametrize("lookback", [4, None])
@pytest.mark.parametrize("large", [1, 10**20])
def test_before(spark, lookback, large):
    r = random.Random(3)
    data = {k: [r.choice([0, 1, 5, 5, 9, 40]) * large for _ in range(n)] for k, n in (("a", 90), ("b", 1), ("c", 11))}
    df = spark.createDataFrame([(k, i + 1, str(v)) for k, vs in data.items() for i, v in enumerate(vs)], "key string, place long, value string").repartition(3)
    got = {(x.key, x.place): x for x in medians.before(df, lookback, 7, parts=5).collect()}
    assert len(got) == 102
    for k, vs in data.items():
        for i in range(len(vs)):
            h = vs[max(0, i - lookback) if lookback else 0 : i]
            x = got[k, i + 1]
            assert (x.n, x.twice, x.upper, x.four) == ((len(h), *plain(h)) if h else (0, None, None, None))
    assert medians.before(df.limit(0), lookback, 7).count() == 0
