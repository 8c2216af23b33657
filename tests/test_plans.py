"""Plan shape: pruned scans, and no cartesian products in the pair joins."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from snapdiff.operators import similarity as S
from snapdiff.plans.fixtures import load_table, original_edges, original_nodes, perturbed_nodes, snapshots


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixture_scans_are_pruned(spark):
    # the snapshots store the original edges, so the scans are looked at where they are made
    edges = plan(original_edges(load_table(spark, SF_SMALL, "orders")))
    nodes = plan(perturbed_nodes(original_nodes(load_table(spark, SF_SMALL, "customer"))))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in edges
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in nodes
    assert "o_totalprice" not in edges and "c_name" not in nodes


def test_pair_levels_have_no_cross_join(spark):
    snap = snapshots(spark, SF_SMALL)
    go = S.whole_graph(snap.nodes_o, snap.edges_o)
    gp = S.whole_graph(snap.nodes_p, snap.edges_p)
    lm = S.label_match(go, gp)
    un_o = lm.where((F.col("side") == "original") & (F.col("n_equal") == 0)).select("node_id")
    prev = S._level(go, gp, None, 0.63)
    plans = [
        plan(S._level(go, gp, None, 0.63, restrict_o=un_o, drop_equal=False, best_for="o")),
        plan(prev),
        plan(S._level(go, gp, prev, 0.63)),
        plan(S.value_equal_pairs(go, gp)),
    ]
    for p in plans:
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
