"""Every SQL text of the dealt operators parses and gives its query's columns on the smallest tables."""

import duckdb
import pytest

from conftest import SF_SMALL
from snapdiff.llm.oracle import ORACLE
from snapdiff.llm.queries import QUERIES


def rows_of(records, columns):
    return sorted((tuple(r[c] for c in columns) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_runs_and_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    told = con.sql(ORACLE[name])
    found = QUERIES[name](spark, SF_SMALL)
    columns = sorted(told.columns)
    assert columns == sorted(found.columns)
    expected = rows_of([dict(zip(told.columns, r)) for r in told.fetchall()], columns)
    assert rows_of([r.asDict() for r in found.collect()], columns) == expected
