"""Driver contract: entry(), and every registered query against its DuckDB oracle."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "events documents embeddings pages benchmark labels conversations".split()
SLOW = {"svm_predictions", "svm_metrics", "model_roundtrip", "rbf_svm_predictions"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "reliability" in df.columns


def test_oracles_are_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if v is None:
        return None
    try:
        if not isinstance(v, (list, dict, str)) and pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return v.item()
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, sf, con, name):
    sdf = entry.queries()[name](spark, sf)
    sp = sdf.toPandas()
    od = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(sp.columns) == sorted(od.columns)
    cols = sorted(sp.columns)
    key = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    a = sorted((tuple(_norm(v) for v in r)
                for r in sp[cols].astype(object).itertuples(index=False)), key=key)
    b = sorted((tuple(_norm(v) for v in r)
                for r in od[cols].astype(object).itertuples(index=False)), key=key)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, sf, name):
    rows = entry.queries()[name](spark, sf).collect()
    assert rows and any(v is not None for v in rows[0])
