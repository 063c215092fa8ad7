"""Every registered query against its SQL twin."""

import os

import pytest
from support import SF_DIR, oracle_rows, rows_of

from __spark_entry__ import entry, oracle_sql, queries

DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
              "double": "DOUBLE", "date": "DATE"}
DIR = os.environ.get("ORACLE_SF_DIR", SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    got = queries()[name](spark, DIR)
    types, expected = oracle_rows(oracle_sql()[name], DIR)
    assert sorted(got.columns) == sorted(types)
    for column, spark_type in got.dtypes:
        if spark_type.startswith("timestamp"):
            assert types[column].startswith("TIMESTAMP")
        else:
            assert types[column] == DUCK_TYPES.get(spark_type, spark_type.upper()), column
    rows = rows_of(got)
    assert sum(expected.values()) > 0
    assert rows == expected


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0
