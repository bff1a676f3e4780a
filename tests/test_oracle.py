"""Every registered query against its DuckDB SQL at sf0.01 (the driver's check):
row count, column names and an order-insensitive value hash."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert info["ok"], info


def test_every_query_has_oracle():
    assert set(E.queries()) - set(E.oracle_sql()) - set(E._llm()[0]) == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "weight" in df.columns


DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
              "DATE": "date"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_column_types_match_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    spark_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    duck_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
