"""Spark against DuckDB at the smallest size: every registered query that has SQL."""

import functools
import os

import duckdb
import pandas as pd
import pytest

from tidemark.plans import all_oracles, all_queries, registry

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_oracles())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.fixture(scope="module", autouse=True)
def shared_tables():
    """The queries of this module share their stored tables."""
    own = registry.Data
    registry.Data = functools.cache(own)
    yield
    registry.Data = own


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        df[c] = df[c].map(lambda x: "-" if x is None or x is pd.NaT or x is pd.NA or x != x else repr(round(float(x), 6) + 0.0) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x))
    return df.replace({"NaT": "-"}).sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, con, name):
    got, want = plain(all_queries()[name](spark, SF).toPandas()), plain(con.execute(all_oracles()[name]).df())
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
