"""Sources and sinks: match text codec, shards, change documents, scores."""

import json
import os

from pyspark.sql import functions as F

from snapdiff.operators import graph as G
from snapdiff.operators.similarity import match_from_graphs, sharded_match
from snapdiff.session import scratch_path
from snapdiff.sources.changes import change_docs, flatten_change_docs, read_changes, write_change_docs
from snapdiff.sources.graph_io import read_edges, read_nodes, split_components, stack_components
from snapdiff.sources.matches import decode_matches, read_matches, write_matches
from snapdiff.sources.scores import write_scores
from snapdiff.sources.shards import read_shards, side_of, write_shards


def test_malformed_match_lines_are_skipped(spark):
    lines = spark.createDataFrame(
        [("original_7\t12_0.315",), ("perturbed_3\t-1_0.0",), ("original_1",), ("a\tb\tc",),
         ("original_1_2\t3_0.5",), ("original_1\t3",), ("original_x\t3_0.5",), ("original_\t3_0.5",),
         ("\t3_0.5",), ("original_4\t",)],
        "value string",
    )
    got = sorted(tuple(r) for r in decode_matches(lines).collect())
    assert got == [("original", 7, 12, 0.315), ("perturbed", 3, None, 0.0)]


def test_match_text_round_trip(spark):
    m = spark.createDataFrame(
        [("original", 7, 12, 0.315), ("perturbed", 3, None, 0.0), ("original", 10, 4, 1.0e-5)],
        "side string, node_id long, match_id long, score double",
    )
    for text in (True, False):
        path = scratch_path(spark, "m")
        write_matches(m, path, text=text)
        assert sorted(map(tuple, read_matches(spark, path, text=text).collect())) == sorted(map(tuple, m.collect()))


def test_node_edge_scans_and_components(spark, tmp_path):
    nodes = spark.createDataFrame([(1, 3.5), (2, 7.0)], "id long, val double")
    edges = spark.createDataFrame([(1, 2, "x")], "s long, d long, action string")
    nodes.write.parquet(str(tmp_path / "n"))
    edges.write.parquet(str(tmp_path / "e"))
    n = read_nodes(spark, str(tmp_path / "n"), id_col="id", value_col="val")
    e = read_edges(spark, str(tmp_path / "e"), src_col="s", dst_col="d")
    assert sorted(map(tuple, n.collect())) == [(1, "3.5"), (2, "7.0")]
    assert e.columns == ["src", "dst"]
    mixed = stack_components(n, e).unionByName(
        spark.createDataFrame([("other", 9, "z", None, None)], "kind string, node_id long, stored_value string, src long, dst long")
    )
    n2, e2 = split_components(mixed)
    assert n2.count() == 2 and e2.count() == 1


def test_change_documents_round_trip(spark):
    truth = spark.createDataFrame(
        [("Removed", 3), ("Modified", 5), ("Added", 1_000_000_000_007), ("Removed", 5000)], "change_type string, node_id long"
    )
    path = scratch_path(spark, "docs")
    write_change_docs(truth, path)
    assert sorted(map(tuple, read_changes(spark, path).collect())) == sorted(map(tuple, truth.collect()))
    # the nested document form with tabs, and a malformed line
    doc = '{"Nodes":\t{"Modified": [1, 2], "Removed": [3], "Added": {"n1": 40, "n2": 41}}}'
    lines = spark.createDataFrame([(doc,), ("not json",)], "value string")
    got = sorted(map(tuple, flatten_change_docs(lines).collect()))
    assert got == [("Added", 40), ("Added", 41), ("Modified", 1), ("Modified", 2), ("Removed", 3)]
    assert all(len(json.loads(r["value"])["Nodes"]["Removed"]) <= 1024 for r in change_docs(truth).collect())


def test_shards_round_trip_and_sharded_equals_whole(spark):
    nodes = spark.createDataFrame([(i, f"v{i % 5}") for i in range(1, 30)], "node_id long, stored_value string")
    rows = [(i, i + 1) for i in range(1, 28)] + [(1, 15), (4, 22)]
    e = spark.createDataFrame(rows, "src long, dst long")
    so = G.build_shards(nodes, e, k=3, hops=2)
    nodes_p = nodes.withColumn("stored_value", F.when(F.col("node_id") % 4 == 0, F.lit("changed")).otherwise(F.col("stored_value")))
    sp = G.build_shards(nodes_p, e, k=3, hops=2)
    path = scratch_path(spark, "shards")
    write_shards(so, sp, path)
    rn, ra = read_shards(spark, path)
    orig_nodes = sorted(map(tuple, so[0].select("part", "node_id", "stored_value", "is_subject").collect()))
    assert sorted(map(tuple, side_of(rn, "original").select("part", "node_id", "stored_value", "is_subject").collect())) == orig_nodes
    assert sorted(map(tuple, side_of(ra, "original").collect())) == sorted(map(tuple, so[1].collect()))
    # one part: every shard is the whole graph, so the sharded definition is exact
    one_o = G.build_shards(nodes, e, k=1, hops=2)
    one_p = G.build_shards(nodes_p, e, k=1, hops=2)
    from snapdiff.operators.similarity import whole_graph

    whole = sorted(map(tuple, match_from_graphs(whole_graph(nodes, e), whole_graph(nodes_p, e)).collect()))
    shard = sorted(map(tuple, sharded_match(*one_o, *one_p).collect()))
    assert shard == whole


def test_legacy_shard_documents(spark, tmp_path):
    half_o = {"subjectNodes": [1, 2, 3, 4], "adjList": {"1": [2, 3], "2": [1, 3, 4], "3": [1, 2], "4": [2]},
              "storedValues": {"1": "A", "2": "B", "3": "C", "4": "D"}}
    half_p = {"subjectNodes": [5, 6, 7, 8], "adjList": {"5": [6, 7], "6": [5, 7, 8], "7": [5, 6], "8": [6], "9": [8]},
              "storedValues": {"5": "A", "6": "Y", "7": "C", "8": "D", "9": "Z"}}
    d = tmp_path / "shards"
    d.mkdir()
    (d / "subgraph_shard_0-0.json").write_text(json.dumps({"originalGraph": half_o, "perturbedGraph": half_p}) + "\n")
    (d / "subgraph_shard_0-1.json").write_text("{broken\n")
    nodes, adj = read_shards(spark, str(d), nested=True)
    so = side_of(nodes, "original")
    sp = side_of(nodes, "perturbed")
    assert so.count() == 4 and sp.count() == 5
    assert sp.where("node_id = 9 AND NOT is_subject").count() == 1
    m = {(r["side"], r["node_id"]): r["score"] for r in sharded_match(so, side_of(adj, "original"), sp, side_of(adj, "perturbed")).collect()}
    assert m[("original", 1)] == 1.0 and m[("original", 2)] == 0.21


def test_shard_documents_against_plain_reading(spark, tmp_path):
    d = tmp_path / "pairs"
    d.mkdir()
    half = {p: {"subjectNodes": [10 * p, 10 * p + 1], "adjList": {str(10 * p): [10 * p + 1, 7], "7": [10 * p], "x": [1]},
                "storedValues": {str(10 * p): "a", "7": "h", "99": "no node"}} for p in range(3)}
    half[2] = {"subjectNodes": [20]}  # no maps
    for i in range(3):
        for j in range(3):
            (d / f"subgraph_shard_{i}-{j}.json").write_text(json.dumps({"originalGraph": half[i], "perturbedGraph": half[j]}) + "\n")
    (d / "subgraph_shard_3-0.json").write_text(json.dumps({"originalGraph": {"adjList": {"1": [2]}}, "perturbedGraph": half[0]}) + "\n")
    nodes, adj = read_shards(spark, str(d), nested=True)
    want_nodes, want_adj = set(), set()
    for side in ("original", "perturbed"):
        for p, h in half.items():
            values = h.get("storedValues", {})
            for n in {*map(str, h["subjectNodes"]), *h.get("adjList", {})}:
                number = int(n) if n.isdigit() else None
                want_nodes.add((side, p, number, values.get(n), number in h["subjectNodes"]))
            for n, nbrs in h.get("adjList", {}).items():
                want_adj |= {(side, p, int(n) if n.isdigit() else None, x) for x in nbrs}
    got_nodes, got_adj = [tuple(r) for r in nodes.collect()], [tuple(r) for r in adj.collect()]
    assert len(got_nodes) == len(want_nodes) and set(got_nodes) == want_nodes
    assert len(got_adj) == len(want_adj) and set(got_adj) == want_adj
    plan = nodes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan


def test_score_sink(spark):
    report = spark.createDataFrame([(0.1, 0.2)], "acc double, vpr double")
    path = scratch_path(spark, "scores")
    write_scores(report, path)
    assert spark.read.json(path).first()["acc"] == 0.1


def test_text_matches_are_written_in_key_order(spark):
    m = spark.range(0, 500).select(
        F.when(F.col("id") % 2 == 0, F.lit("original")).otherwise(F.lit("perturbed")).alias("side"),
        F.col("id").alias("node_id"),
        (F.col("id") + 1).alias("match_id"),
        (F.col("id") / 1000.0).alias("score"),
    )
    path = scratch_path(spark, "ordered")
    write_matches(m, path, text=True)
    local = path.removeprefix("file:")
    files = sorted(f for f in os.listdir(local) if f.startswith("part-"))
    keys = []
    for f in files:
        with open(os.path.join(local, f)) as fh:
            keys += [line.split("\t")[0] for line in fh if line.strip()]
    assert len(keys) == 500 and keys == sorted(keys)
