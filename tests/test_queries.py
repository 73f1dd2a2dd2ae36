"""Every registered query against its SQL."""

import math

import duckdb
import pandas as pd
import pytest

from wirelens.plans.oracles import ORACLES
from wirelens.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return ""
        if isinstance(v, float) and v.is_integer():
            return str(int(v))
        return str(v)

    return sorted(tuple(value(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    got, want = QUERIES[name](spark, sf).toPandas(), con.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert plain(got) == plain(want)
