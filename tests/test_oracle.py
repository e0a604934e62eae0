"""Every registered query with SQL against DuckDB on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from conftest import DATA

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def comparable(df):
    def cell(value):
        if value is None or pd.isna(value):
            return ""
        if isinstance(value, str):
            return value
        if hasattr(value, "year"):
            return str(pd.Timestamp(value))
        return repr(float(value))

    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, row)) for row in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


# DuckDB's names for the types that results have in Spark.
TYPES = {"bigint": {"BIGINT", "HUGEINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
         "boolean": {"BOOLEAN"}, "timestamp": {"TIMESTAMP", "TIMESTAMP_NS"}, "timestamp_ntz": {"TIMESTAMP", "TIMESTAMP_NS"},
         "date": {"DATE"}, "float": {"FLOAT"}}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, DATA)
    ours = result.toPandas()
    relation = duck.sql(ORACLES[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert [c for c, t in result.dtypes if types[c] not in TYPES[t]] == []
    theirs = relation.df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert comparable(ours) == comparable(theirs)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
