"""Driver contract: entry(), queries() and oracle_sql(); every oracle query is
compared with DuckDB on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from colonnade.plans import registry
from colonnade.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {  # model fits and a random sample: no SQL oracle
    "sample_bernoulli", "ml_gbt_classify", "ml_rf_classify", "ml_rf_regression", "ml_feature_importance",
    "job_classification_drivers", "job_weekly_forecast", "metric_report", "job_ewma_forecast", "ml_walk_forward",
}


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 12 and df.columns == ["month", "avg_count"]


def test_registry_is_consistent():
    qs, sqls = registry.queries(), registry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(qs) - set(sqls) == ROWS_ONLY
    assert not any(n.startswith("op") for n in qs)
    assert set(qs) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6)
    return str(v) if not isinstance(v, (int, str, bool)) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    spark_rows = sdf.collect()
    cols = sorted(sdf.columns)
    odf = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(odf.columns) == cols
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in spark_rows), key=repr)
    b = sorted((tuple(_norm(v) for v in row) for row in odf[cols].itertuples(index=False, name=None)), key=repr)
    assert a == b
