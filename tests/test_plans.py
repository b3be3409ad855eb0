"""Plan shape of every registered query: no cartesian or nested-loop joins, no
row-at-a-time Python, filters pushed into the parquet scan."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ARROW_UDF_OK = {"udf_vs_native"}  # the pandas-UDF twin exists only to be compared


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_no_python_rows(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in ARROW_UDF_OK:
        assert "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name,pushed", [
    ("filter_ts_range", "GreaterThanOrEqual(ts"),
    ("filter_sql_text", "LessThanOrEqual(l_quantity"),
    ("filter_nonzero", "Not(EqualTo(l_discount"),
    ("join_left", "EqualTo(o_orderstatus,F)"),
    ("join_left", "GreaterThanOrEqual(o_orderdate,2001-01-01"),
    ("join_left", "LessThan(o_orderdate,2002-01-01"),
    ("filter_in_set", "LessThan(o_orderdate,1997-01-01"),
    ("filter_year_range", "GreaterThanOrEqual(o_orderdate,1997-01-01"),
    ("filter_year_range", "LessThan(o_orderdate,2000-01-01"),
    ("filter_complete_series", "GreaterThanOrEqual(l_shipdate,1997-01-01"),
    ("filter_complete_series", "LessThan(l_shipdate,2002-01-01"),
    ("filter_key_set", "In(l_linenumber, [1,3,5])"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plans are printed whole
    assert pushed in _plan(entry.queries()[name](spark, SF))


def test_projection_prunes_columns(spark):
    plan = _plan(entry.queries()["project_select"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_ewma_exchanges_do_not_grow_with_bars(spark):
    # No per-bar sub-plans: ten times the bars give the same plan; what runs shuffles the bars once to number them.
    static = {sf: _plan(entry.queries()["ewma_block_delayed"](spark, sf)).count("Exchange hashpartitioning")
              for sf in (SF, SF.replace("0.001", "0.01"))}
    assert len(set(static.values())) == 1
    df = entry.queries()["ewma_block_delayed"](spark, SF)
    df.collect()
    final = _plan(df).split("+- == Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") <= 8
