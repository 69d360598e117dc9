"""Every query beside its SQL, and the shape of the plans."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as entry
from tools import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        told = compare.check(spark, con, QUERIES[name], ORACLES[name], FOLDER)
        assert told in ("", "no rows"), told
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["s3_parquet_scan"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_partitions_are_pruned(spark):
    assert "PartitionFilters: [isnotnull(year" in plan(QUERIES["s5_partitioned_parquet"](spark, FOLDER))


def test_history_sorts_once(spark):
    text = plan(QUERIES["w1_rolling_rates"](spark, FOLDER)).split("(1) ")[0]
    assert text.count("Window") <= 2 and text.count("Sort") <= 4


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "adfhjprtuw" and n[:2] != "a8"))
def test_no_python_rows_and_no_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text
