"""Every query with a SQL twin against DuckDB, at the smallest scale."""

import pytest

from tests.conftest import SF
from tidepool.plans import catalog


def rows(df):
    def plain(v):
        if isinstance(v, float) and v == int(v):
            v = int(v)
        return str(v)

    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(plain(v) for v in r) for r in df.where(df.notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_twin(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.execute(catalog.ORACLE_SQL[name]).df()
    assert set(got.columns) == set(want.columns)
    assert rows(got) == rows(want)


def test_registration():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
