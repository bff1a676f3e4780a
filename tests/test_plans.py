"""Plan checks: no Python UDF evaluation, no Cartesian or
nested-loop joins, dictionary join broadcast, scans pruned."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("MapInArrow", "MapInPandas", "FlatMapGroups", "PythonUDF")
# The sweep over the spans of a document is the only Python code outside kenning/llm.
SWEEPS = ("longest_spans", "document_interests")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_udf_no_pairs(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for bad in BAD:
        assert bad not in p, f"{name}: {bad}"
    if name not in SWEEPS and not re.match(r"op\d+_|pipeline$", name):
        assert not [x for x in PYTHON if x in p], name


def test_gazetteer_join_is_broadcast(spark):
    p = plan(E.queries()["gazetteer_matches"](spark, SF))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["mention_counts"](spark, SF))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "event_id" not in scan and "value" not in scan.split("ReadSchema")[1]


def test_filter_pushed_to_scan(spark):
    p = plan(E.queries()["profile_merge"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in p or "LessThan(ts" in p
