"""Every registered query runs; those with a SQL twin agree with DuckDB row by row."""

import math

import duckdb
import pandas as pd
import pytest

from urlgauge import catalog
from urlgauge.catalog import registry

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in ("lineitem", "pages", "labels", "events", "embeddings", "supplier"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return ""
    value = value.item() if hasattr(value, "item") else value
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False, name=None))


def test_no_orphan_sql():
    assert set(catalog.oracles()) <= set(catalog.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, db, name):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    if name not in registry.ORACLES:
        assert len(got.columns) == len(set(got.columns))
        return
    wanted = db.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)
