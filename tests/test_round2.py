"""Cases in which earlier versions were wrong, and the plans of skewed joins."""

import random

import pytest
from pyspark.sql import functions as F

from snapdiff.operators import graph as G
from snapdiff.operators import similarity as S
from snapdiff.operators.classify import split_scores
from snapdiff.plans.change_detection import detect_changes
from snapdiff.sources.changes import change_docs, flatten_change_docs


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def components(spark, edges):
    rows = edges + [(b, a) for a, b in edges]
    return {r["node_id"]: r["component"] for r in G.connected_components(spark.createDataFrame(rows, "src long, dst long")).collect()}


def test_short_path_with_unlucky_labels(spark):
    assert components(spark, [(1, 4), (4, 3), (3, 5), (5, 2)]) == {i: 1 for i in range(1, 6)}


def test_hundreds_of_small_graphs_and_a_long_path(spark):
    """Paths, trees and random graphs side by side; none touches another's ids."""
    rng = random.Random(8)
    edges = []
    for g in range(300):
        ids = [g * 100 + i for i in rng.sample(range(100), rng.randrange(2, 12))]
        kind = g % 3
        for i in range(1, len(ids)):
            edges.append((ids[i], ids[i - 1] if kind == 0 else rng.choice(ids[:i])))
        if kind == 2:
            edges += [(rng.choice(ids), rng.choice(ids)) for _ in range(3)]
    edges += [(10**6 + i, 10**6 + i + 1) for i in range(300)]
    assert components(spark, edges) == union_find(edges)


def test_hub_takes_its_best_partner(spark):
    """Degrees in the millions (given, not built): scores near 1e-13 keep their order."""
    vals_o = spark.createDataFrame([(1, "x"), (2, "s")], "node_id long, stored_value string")
    adj_o = spark.createDataFrame([(1, 2, 2_000_000)], "src long, dst long, sdeg long")
    vals_p = spark.createDataFrame([(100, "p"), (101, "q"), (102, "r"), (9, "s")], "node_id long, stored_value string")
    adj_p = spark.createDataFrame([(100, 9, 1_500_000), (101, 9, 1_000_000), (102, 9, 700_000)], "src long, dst long, sdeg long")
    out = S.match_from_graphs(S.SideGraph(vals_o, adj_o), S.SideGraph(vals_p, adj_p)).where("side = 'original' AND node_id = 1").first()
    assert out["match_id"] == 102 and out["score"] == pytest.approx(0.63 / (2e6 * 7e5))


def test_small_scores_are_split_like_large_ones(spark):
    scores = [(1, 2.0), (2, 2.1), (3, 9.0), (4, 9.5)]
    for method in ("two_means", "two_seeds"):
        want = sorted(map(tuple, split_scores(spark.createDataFrame(scores, "node_id long, score double"), method).collect()))
        tiny = [(i, s * 2.0**-60) for i, s in scores]
        assert sorted(map(tuple, split_scores(spark.createDataFrame(tiny, "node_id long, score double"), method).collect())) == want


def test_directed_adjacency_as_given(spark):
    """T1 through the public function; 9 lists 8, but 8 does not list 9."""
    adj_o = {1: [2, 3], 2: [1, 3, 4], 3: [1, 2], 4: [2]}
    adj_p = {5: [6, 7], 6: [5, 7, 8], 7: [5, 6], 8: [6], 9: [8]}
    frame = lambda adj: spark.createDataFrame([(a, b) for a, v in adj.items() for b in v], "src long, dst long")
    values = lambda v: spark.createDataFrame(list(v.items()), "node_id long, stored_value string")
    got = {(r["a"], r["b"]): r["score"] for r in S.simrank(
        values({1: "A", 2: "B", 3: "C", 4: "D"}), frame(adj_o),
        values({5: "A", 6: "Y", 7: "C", 8: "D", 9: "Z"}), frame(adj_p), directed=True).collect()}
    want = {(1, 5): 1, (3, 7): 1, (4, 8): 1, (2, 5): 0.105, (2, 6): 0.21, (2, 7): 0.105, (2, 9): 0.21, (1, 6): 0.105, (3, 6): 0.105}
    assert got == pytest.approx(want)


def test_isolated_nodes_on_request(spark):
    nodes = lambda v: spark.createDataFrame(v, "node_id long, stored_value string")
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    args = (nodes([(1, "a"), (2, "b"), (3, "c")]), edges, nodes([(1, "a"), (2, "b"), (3, "c"), (4, "d")]), edges)
    assert detect_changes(*args).count() == 0
    assert [tuple(r) for r in detect_changes(*args, drop_isolated=False).collect()] == [("Added", 4)]


def test_repeated_node_rows_change_nothing(spark):
    nodes = [(1, "a"), (2, "b"), (3, "c")]
    edges = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    frame = lambda v: spark.createDataFrame(v, "node_id long, stored_value string")
    once = S.simrank(frame(nodes), edges, frame(nodes), edges).collect()
    twice = S.simrank(frame(nodes + nodes), edges, frame(nodes + nodes), edges).collect()
    assert sorted(once) == sorted(twice)


def test_repeated_changes_are_a_set(spark):
    df = spark.createDataFrame([("Added", 7), ("Added", 7), ("Modified", 8), ("Modified", 8)], "change_type string, node_id long")
    assert sorted(map(tuple, flatten_change_docs(change_docs(df)).collect())) == [("Added", 7), ("Modified", 8)]


# ------------------------------------------------------------------ skewed joins

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0], rows


def star(spark, n=40_000):
    """Half of all rows on node 0."""
    ids = spark.range(1, n + 1, 1, 8)
    hub = ids.select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    return hub.union(ids.select(F.col("id").alias("src"), (F.col("id") % 977 + 1).alias("dst")))


def test_degrees_join_splits_a_hub(skewed):
    plan, rows = final_plan(S.with_degrees(star(skewed), []))
    assert "skew=true" in plan and len(rows) == 80_000


def test_label_match_splits_a_hot_value(skewed):
    ids = skewed.range(0, 60_000, 1, 8)
    vals = ids.select(F.col("id").alias("node_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("stored_value"))
    g = S.SideGraph(vals=vals, adj=None)
    plan, rows = final_plan(S.label_match(g, g))
    assert "skew=true" in plan and len(rows) == 120_000


def test_neighbour_lists_split_a_hub(skewed):
    plan, rows = final_plan(G.chunked_lists(star(skewed), "src", "dst"))
    assert "skew=true" in plan
    assert sum(len(r["neighbors"]) for r in rows if r["src"] == 0) == 40_000


def test_components_of_a_hub(skewed):
    got = G.connected_components(star(skewed, 20_000))
    assert got.where("component <> 0").count() == 0 and got.count() == 20_001
