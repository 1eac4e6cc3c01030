"""Every query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from ratingloom.plans import registry


def tidy(frame: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or v is pd.NaT:
            return "None"
        return repr(round(v, 9)) if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(text(v) for v in row) for row in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, small, duck, name):
    got = registry.QUERIES[name](spark, small).toArrow().to_pandas()
    want = duck.sql(registry.ORACLES[name]).to_arrow_table().to_pandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert tidy(got) == tidy(want)


def test_every_query_is_listed():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
