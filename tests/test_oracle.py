"""Every registered query against its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = E.oracle_sql()
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, duck, name):
    sdf = E.queries()[name](spark, sf_small).toPandas()
    ddf = duck.execute(ORACLE[name]).df()
    sc, srows = _rows(sdf)
    dc, drows = _rows(ddf)
    assert sc == dc
    assert len(srows) == len(drows)
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 3250
