"""Rounds of k-hop and row numbers are written tables, not checkpoints; their rows stay right."""

from snapdiff.operators import graph as G


def test_hops_and_numbers_read_tables(spark):
    adj = G.undirected(spark.createDataFrame([(i, i + 1) for i in range(1, 9)] + [(20, 21)], "src long, dst long"))
    parts = G.partition_nodes(adj, 3, symmetric=True)
    near = G.khop(adj, parts, 1, 3)
    for df in (parts, near):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" in plan and "ExistingRDD" not in plan
    want = {0: [1, 2, 3, 4], 1: [5, 6, 7, 8], 2: [9, 20, 21]}
    found = {p: sorted(r["node_id"] for r in parts.collect() if r["part"] == p) for p in range(3)}
    assert found == want
    around = {0: [1, 2, 3, 4, 5], 1: [4, 5, 6, 7, 8, 9], 2: [8, 9, 20, 21]}
    assert {p: sorted(r["node_id"] for r in near.collect() if r["part"] == p) for p in range(3)} == around
