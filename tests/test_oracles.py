"""Every query with a SQL twin gives DuckDB's rows on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from cinderframe.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{sf}/{name}'")
    return con


def rows(df):
    def plain(v):
        if isinstance(v, (bool, np.bool_)) or v is None or not pd.isna(v) and isinstance(v, str):
            return v
        if pd.isna(v):
            return None
        return float(v) if isinstance(v, (int, float, np.number)) else str(v)

    return sorted(map(repr, ([plain(v) for v in r] for r in df[sorted(df.columns)].astype(object).itertuples(index=False))))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in SQL:
        want = db.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert name in {"j19_touched_cells", "a15_barrier_raster"} and len(got)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
