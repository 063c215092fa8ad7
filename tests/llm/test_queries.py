"""Every registered text query that SQL can express against its SQL twin."""

import pytest
from support import SF_DIR, oracle_rows, rows_of

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    types, expected = oracle_rows(ORACLE[name], SF_DIR)
    assert sorted(got.columns) == sorted(types)
    assert sum(expected.values()) > 0
    assert rows_of(got) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_gives_a_row_per_document(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = QUERIES[name](spark, SF_DIR).select("doc_id").collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in documents.select("doc_id").collect())
