"""Driver contract: entry runs on sf0.001, every query has a matching oracle."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["change_type", "node_id"]
    assert len(rows) > 0


def test_every_query_has_an_oracle():
    # every query of the engine has SQL; operators that SQL cannot express have none
    from snapdiff.plans.catalog import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _duck():
    con = duckdb.connect()
    for t in ("customer", "orders", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_flagship_matches_oracle(spark):
    con = _duck()
    for name in ("detect_changes", "best_match", "confusion_scores"):
        df = E.queries()[name](spark, SF_SMALL)
        got = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
        rel = con.sql(E.oracle_sql()[name])
        cols = rel.columns
        exp = sorted(tuple(dict(zip(cols, r))[c] for c in sorted(cols)) for r in rel.fetchall())
        assert got == exp, name
