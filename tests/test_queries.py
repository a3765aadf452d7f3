"""Every registered query of the session analytics against its SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidewright.plans import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "null"
    return f"{float(v):.9g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)


def canonical(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    got = queries()[name](spark, SF).toPandas()
    if name in oracle_sql():
        want = db.execute(oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)
