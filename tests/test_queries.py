"""Every query at the smallest size, against its SQL in DuckDB where there is one."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tarifa import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(frame: pd.DataFrame) -> list:
    def value(v):
        if v is None or v is pd.NaT or v != v:
            return None
        return round(float(v), 6) if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(([value(v) for v in r] for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = entry.queries()[name](spark, sf_dir)
    rows = frame.toPandas()
    if name in own.ORACLES:
        want = duck.execute(own.ORACLES[name]).df()
        assert sorted(rows.columns) == sorted(want.columns)
        assert plain(rows) == plain(want)
    else:
        assert len(rows) > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "cheapest_site" in rows.columns


def test_names_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
