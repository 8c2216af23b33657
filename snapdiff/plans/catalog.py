"""Registered queries: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, derives the two snapshots from the
driver's ``customer`` / ``orders`` tables (see :mod:`snapdiff.plans.fixtures`)
and returns a DataFrame whose columns match the SQL oracle of the same name.
Doubles are rounded to ``SCORE_DP`` decimals (4 in reports) so that engines
that sum in different orders still agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapdiff.functions.exprs import ORIGINAL, PERTURBED, SCORE_DP, score_round
from snapdiff.operators import graph as G
from snapdiff.operators import similarity as S
from snapdiff.operators.classify import split_scores
from snapdiff.operators.evaluate import score_report, scores_long
from snapdiff.plans.change_detection import (
    DEFAULT_HOPS,
    DEFAULT_PARTS,
    detect_changes,
    detect_changes_sharded,
    evaluate,
    evaluate_snapshots,
    sharded_matches,
)
from snapdiff.plans.fixtures import Snapshots, load_table, snapshots
from snapdiff.session import cut_lineage, in_parallel, scratch_path, stored
from snapdiff.sources.changes import flatten_change_docs, change_docs, read_changes, write_change_docs
from snapdiff.sources.graph_io import (
    node_count_values,
    node_counts,
    read_edges,
    read_nodes,
    split_components,
    stack_components,
)
from snapdiff.sources.matches import decode_matches, encode_matches, read_matches, write_matches
from snapdiff.sources.shards import read_shards, write_shards

#: What a lenient scan of match lines counts.
SKIPS = ("read", "kept", "no_tab", "bad_key", "bad_value", "no_number")

#: Pairs of nodes from which ``best_match_hot`` takes a value as hot.
HOT_PAIRS = 1000

Query = Callable[[SparkSession, str], DataFrame]


def _both(snap: Snapshots, fn: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Apply a per-snapshot operator to both snapshots, tagged by side."""
    o, p = in_parallel(lambda: fn(snap.nodes_o, snap.edges_o), lambda: fn(snap.nodes_p, snap.edges_p))
    return o.select(F.lit(ORIGINAL).alias("side"), "*").unionByName(p.select(F.lit(PERTURBED).alias("side"), "*"))


def _graphs(snap: Snapshots) -> tuple[S.SideGraph, S.SideGraph]:
    return tuple(
        in_parallel(lambda: S.whole_graph(snap.nodes_o, snap.edges_o), lambda: S.whole_graph(snap.nodes_p, snap.edges_p))
    )


def _rounded_pairs(df: DataFrame) -> DataFrame:
    return df.select("a", "b", score_round("score").alias("score"))


def _matches(snap: Snapshots) -> DataFrame:
    return cut_lineage(S.best_match(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p))


def _shown(matches: DataFrame) -> DataFrame:
    return matches.withColumn("score", score_round("score"))


def _original_unmatched(snap: Snapshots) -> DataFrame:
    m = _matches(snap)
    return m.where((F.col("side") == ORIGINAL) & (F.col("score") < 1)).select("node_id", "score")


def _predictions(snap: Snapshots) -> DataFrame:
    return cut_lineage(detect_changes(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p))


def _evaluation(spark: SparkSession, sf_dir: str, changed_pred: str = "removed_added"):
    snap = snapshots(spark, sf_dir)
    pred = _predictions(snap)
    n_o, n_p = node_count_values(snap.nodes_o, snap.nodes_p)
    conf, tl = evaluate(pred, snap.truth, n_o, n_p, changed_pred)
    return cut_lineage(conf), cut_lineage(tl)


def _round_doubles(df: DataFrame, dp: int = SCORE_DP) -> DataFrame:
    return df.select(
        *[F.round(c, dp).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# ---------------------------------------------------------------- scans


def q_nodes_scan(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    return snap.nodes_o.select(F.lit(ORIGINAL).alias("side"), "*").unionByName(
        snap.nodes_p.select(F.lit(PERTURBED).alias("side"), "*")
    )


def q_edges_scan(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    return snap.edges_o.select(F.lit(ORIGINAL).alias("side"), "*").unionByName(
        snap.edges_p.select(F.lit(PERTURBED).alias("side"), "*")
    )


def q_component_split(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    nation = load_table(spark, sf_dir, "nation")
    other = nation.select(
        F.lit("other").alias("kind"),
        F.col("n_nationkey").cast("long").alias("node_id"),
        F.col("n_name").alias("stored_value"),
        F.col("n_regionkey").cast("long").alias("src"),
        F.lit(None).cast("long").alias("dst"),
    )
    mixed = stack_components(snap.nodes_o, snap.edges_o).unionByName(other)
    nodes, edges = split_components(mixed)
    return stack_components(nodes, edges)


def q_node_counts(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    return node_counts(snap.nodes_o, snap.nodes_p)


def q_truth_flatten(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    path = scratch_path(spark, "truth-docs")
    write_change_docs(snap.truth, path)
    return read_changes(spark, path, nested=True)


# ---------------------------------------------------------------- graph


def q_out_adjacency(spark, sf_dir):
    return _both(snapshots(spark, sf_dir), lambda n, e: G.out_adjacency(n, e))


def q_undirected_edges(spark, sf_dir):
    return _both(snapshots(spark, sf_dir), lambda n, e: G.undirected(e))


def q_isolated_nodes(spark, sf_dir):
    return _both(snapshots(spark, sf_dir), lambda n, e: G.isolated_nodes(n, G.undirected(e)))


def q_degrees(spark, sf_dir):
    return _both(snapshots(spark, sf_dir), lambda n, e: G.degrees(G.undirected(e)))


def _components(n, e):
    return cut_lineage(G.connected_components(stored(G.undirected(e), "adjacency"), symmetric=True))


def q_connected_components(spark, sf_dir, sparse=False):
    return _both(snapshots(spark, sf_dir, sparse), _components)


def _parts(n, e, k=DEFAULT_PARTS):
    adj = stored(G.undirected(e), "adjacency")
    return cut_lineage(G.partition_nodes(adj, k, symmetric=True))


def q_partition_nodes(spark, sf_dir, sparse=False):
    return _both(snapshots(spark, sf_dir, sparse), _parts)


def q_khop_nodes(spark, sf_dir, sparse=False):
    def members(n, e):
        adj = stored(G.undirected(e), "adjacency")
        return G.khop(adj, G.partition_nodes(adj, DEFAULT_PARTS, symmetric=True), DEFAULT_HOPS, DEFAULT_PARTS)

    return _both(snapshots(spark, sf_dir, sparse), members)


def q_induced_subgraph(spark, sf_dir, sparse=False):
    def sub(n, e):
        adj = stored(G.undirected(e), "adjacency")
        members = cut_lineage(G.khop(adj, G.partition_nodes(adj, DEFAULT_PARTS, symmetric=True), DEFAULT_HOPS, DEFAULT_PARTS))
        return G.induced(adj, members, DEFAULT_PARTS)

    return _both(snapshots(spark, sf_dir, sparse), sub)


def q_build_shards(spark, sf_dir, sparse=False):
    def counts(n, e):
        shard_nodes, shard_adj = G.build_shards(n, e, DEFAULT_PARTS, DEFAULT_HOPS)
        shard_nodes = cut_lineage(shard_nodes)
        per_node = shard_nodes.groupBy("part").agg(
            F.sum(F.col("is_subject").cast("long")).alias("n_subjects"), F.count(F.lit(1)).alias("n_nodes")
        )
        per_edge = shard_adj.groupBy("part").agg(F.count(F.lit(1)).alias("n_edges"))
        return per_node.join(per_edge, "part", "left").select(
            "part", "n_subjects", "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges")
        )

    return _both(snapshots(spark, sf_dir, sparse), counts)


def q_shard_pairs(spark, sf_dir, sparse=False):
    snap = snapshots(spark, sf_dir, sparse)
    so, sp = in_parallel(
        lambda: cut_lineage(G.build_shards(snap.nodes_o, snap.edges_o, DEFAULT_PARTS, DEFAULT_HOPS)[0]),
        lambda: cut_lineage(G.build_shards(snap.nodes_p, snap.edges_p, DEFAULT_PARTS, DEFAULT_HOPS)[0]),
    )
    return G.shard_pairs(so, sp)


def q_shard_roundtrip(spark, sf_dir, sparse=False, parts=None):
    snap = snapshots(spark, sf_dir, sparse)
    shards_o, shards_p = in_parallel(
        lambda: tuple(cut_lineage(x) for x in G.build_shards(snap.nodes_o, snap.edges_o, DEFAULT_PARTS, DEFAULT_HOPS)),
        lambda: tuple(cut_lineage(x) for x in G.build_shards(snap.nodes_p, snap.edges_p, DEFAULT_PARTS, DEFAULT_HOPS)),
    )
    path = scratch_path(spark, "shards")
    write_shards(shards_o, shards_p, path)
    nodes, adj = read_shards(spark, path, parts=parts)
    nbrs = adj.groupBy("side", "part", F.col("src").alias("node_id")).agg(F.count(F.lit(1)).alias("n_neighbors"))
    return nodes.join(nbrs, ["side", "part", "node_id"], "left").select(
        "side", "part", "node_id", "stored_value", "is_subject", F.coalesce("n_neighbors", F.lit(0)).alias("n_neighbors")
    )


def q_shard_read_parts(spark, sf_dir):
    """Two parts of three, read from the store without opening the third."""
    return q_shard_roundtrip(spark, sf_dir, sparse=True, parts=[0, 2])


# ---------------------------------------------------------------- similarity


def q_label_match(spark, sf_dir):
    return S.label_match(*_graphs(snapshots(spark, sf_dir)))


def q_unmatched_nodes(spark, sf_dir):
    return S.unmatched_nodes(*_graphs(snapshots(spark, sf_dir)))


def q_simrank_pairs(spark, sf_dir):
    return _rounded_pairs(S.simrank_pairs(*_graphs(snapshots(spark, sf_dir)), depth=2))


def q_simrank_depth3(spark, sf_dir):
    return _rounded_pairs(S.simrank_pairs(*_graphs(snapshots(spark, sf_dir)), depth=3))


def q_best_match(spark, sf_dir):
    return _shown(_matches(snapshots(spark, sf_dir)))


def q_best_match_depth3(spark, sf_dir, sparse=False):
    snap = snapshots(spark, sf_dir, sparse)
    return S.best_match(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p, depth=3)


def q_best_match_hot(spark, sf_dir):
    """Two values held by a third of the nodes each; a low budget, so that they go by lists at any size."""
    snap = snapshots(spark, sf_dir, hot=True)
    return _shown(S.best_match(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p, pairs_per_task=HOT_PAIRS))


def q_sharded_match(spark, sf_dir, sparse=False):
    snap = snapshots(spark, sf_dir, sparse)
    return _shown(sharded_matches(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p))


def q_match_encode(spark, sf_dir):
    m = _shown(_matches(snapshots(spark, sf_dir)))
    enc = encode_matches(m, keep=["side", "node_id", "score"])
    return enc.select("side", "node_id", "key", F.split("value", "_").getItem(0).alias("match_part"), "score")


def _match_lines(m: DataFrame) -> DataFrame:
    """Every match as a good text line plus one malformed variant of it
    (chosen by node id), which the decoder must skip."""
    enc = encode_matches(m, keep=["node_id"])
    good = enc.select(F.concat_ws("\t", "key", "value").alias("value"))
    idx = F.pmod(F.col("node_id"), F.lit(4))
    bad = enc.select(
        F.when(idx == 0, F.col("key"))
        .when(idx == 1, F.concat_ws("\t", "key", "value", F.lit("extra")))
        .when(idx == 2, F.concat_ws("\t", F.concat(F.col("key"), F.lit("_1")), "value"))
        .otherwise(F.concat_ws("\t", "key", F.split("value", "_").getItem(0)))
        .alias("value")
    )
    return good.unionByName(bad)


def q_match_decode(spark, sf_dir):
    m = _shown(_matches(snapshots(spark, sf_dir)))
    return decode_matches(_match_lines(m)).select("side", "node_id", "match_id", score_round("score").alias("score"))


def q_match_skips(spark, sf_dir):
    """How many lines the lenient scan read, kept and skipped, by reason, observed as it ran."""
    m = _shown(_matches(snapshots(spark, sf_dir)))
    path = scratch_path(spark, "match-lines")
    _match_lines(m).write.text(path)
    report = Observation("match-skips")
    read_matches(spark, path, text=True, report=report).write.parquet(scratch_path(spark, "matches"))
    told = report.get
    return spark.createDataFrame([tuple(int(told[c]) for c in SKIPS)], ", ".join(f"n_{c} long" for c in SKIPS))


# ---------------------------------------------------------------- classify


def q_split_two_seeds(spark, sf_dir):
    return split_scores(_original_unmatched(snapshots(spark, sf_dir)), "two_seeds")


def q_split_two_means(spark, sf_dir):
    return split_scores(_original_unmatched(snapshots(spark, sf_dir)), "two_means")


def q_classify_changes(spark, sf_dir, sparse=False):
    snap = snapshots(spark, sf_dir, sparse)
    return detect_changes_sharded(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p)


def q_detect_changes(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    return detect_changes(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p)


# ---------------------------------------------------------------- evaluate


def q_confusion_scores(spark, sf_dir):
    conf, _ = _evaluation(spark, sf_dir)
    return _round_doubles(conf)


def q_traceability_scores(spark, sf_dir):
    _, tl = _evaluation(spark, sf_dir)
    return _round_doubles(tl)


def q_traceability_removed_twice(spark, sf_dir):
    _, tl = _evaluation(spark, sf_dir, "removed_twice")
    return _round_doubles(tl)


def q_score_report(spark, sf_dir):
    conf, tl = _evaluation(spark, sf_dir)
    return score_report(conf, tl)


def q_scores_long(spark, sf_dir):
    conf, _ = _evaluation(spark, sf_dir)
    return _round_doubles(scores_long(conf))


def q_evaluate_changes(spark, sf_dir):
    conf, tl = _evaluation(spark, sf_dir)
    report = score_report(conf, tl)
    names = [c for c in report.columns]
    long = report.unpivot([], names, "metric", "score")
    return long.select(
        F.when(F.col("metric").isin("acc", "btlr", "vpr"), F.lit("Traceability"))
        .otherwise(F.initcap(F.split("metric", "_").getItem(0)))
        .alias("change_type"),
        F.when(F.col("metric").isin("acc", "btlr", "vpr"), F.col("metric"))
        .otherwise(F.regexp_replace("metric", "^[a-z]+_", ""))
        .alias("score_type"),
        "score",
    )


# ---------------------------------------------------------------- by file, and the other signatures


def q_nodes_read(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    path = scratch_path(spark, "nodes")
    snap.nodes_p.write.json(path)
    return read_nodes(spark, path, fmt="json")


def q_edges_read(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    path = scratch_path(spark, "edges")
    snap.edges_p.withColumn("weight", F.lit(1.5)).write.parquet(path)
    return read_edges(spark, path)


def q_match_files(spark, sf_dir):
    """Matches through the text sink and the lenient scan, as they come back."""
    path = scratch_path(spark, "matches")
    write_matches(_shown(_matches(snapshots(spark, sf_dir))), path, text=True)
    return _shown(read_matches(spark, path, text=True))


def q_neighbor_lists(spark, sf_dir):
    """A1's list form as text: each node's neighbours in order."""
    def lists(n, e):
        chunks = G.out_adjacency(n, e, as_lists=True)
        whole = chunks.groupBy("node_id").agg(F.array_sort(F.flatten(F.collect_list("neighbors"))).alias("ids"))
        return whole.select("node_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("neighbors"))

    return _both(snapshots(spark, sf_dir, True), lists)


def q_truth_tabs(spark, sf_dir):
    """Change documents laid out with tabs, as the cleaning step expects them."""
    docs = change_docs(snapshots(spark, sf_dir).truth)
    return flatten_change_docs(docs.select(F.replace("value", F.lit(","), F.lit(",\t")).alias("value")))


def q_evaluate_report(spark, sf_dir):
    snap = snapshots(spark, sf_dir)
    return evaluate_snapshots(_predictions(snap), snap.truth, snap.nodes_o, snap.nodes_p)


def q_detect_all_nodes(spark, sf_dir):
    snap = snapshots(spark, sf_dir, True)
    return detect_changes(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p, drop_isolated=False)


def q_simrank_directed(spark, sf_dir):
    snap = snapshots(spark, sf_dir, True)
    return _rounded_pairs(S.simrank(snap.nodes_o, snap.edges_o, snap.nodes_p, snap.edges_p, directed=True))


def _sparse(query: Query) -> Query:
    return lambda spark, sf_dir: query(spark, sf_dir, True)


QUERIES: dict[str, Query] = {
    "nodes_scan": q_nodes_scan,
    "edges_scan": q_edges_scan,
    "component_split": q_component_split,
    "node_counts": q_node_counts,
    "truth_flatten": q_truth_flatten,
    "out_adjacency": q_out_adjacency,
    "undirected_edges": q_undirected_edges,
    "isolated_nodes": q_isolated_nodes,
    "degrees": q_degrees,
    "connected_components": q_connected_components,
    "partition_nodes": q_partition_nodes,
    "khop_nodes": q_khop_nodes,
    "induced_subgraph": q_induced_subgraph,
    "build_shards": q_build_shards,
    "shard_pairs": q_shard_pairs,
    "shard_roundtrip": q_shard_roundtrip,
    "label_match": q_label_match,
    "unmatched_nodes": q_unmatched_nodes,
    "simrank_pairs": q_simrank_pairs,
    "simrank_depth3": q_simrank_depth3,
    "best_match": q_best_match,
    "sharded_match": q_sharded_match,
    "match_encode": q_match_encode,
    "match_decode": q_match_decode,
    "split_two_seeds": q_split_two_seeds,
    "split_two_means": q_split_two_means,
    "classify_changes": q_classify_changes,
    "detect_changes": q_detect_changes,
    "confusion_scores": q_confusion_scores,
    "traceability_scores": q_traceability_scores,
    "traceability_removed_twice": q_traceability_removed_twice,
    "score_report": q_score_report,
    "scores_long": q_scores_long,
    "evaluate_changes": q_evaluate_changes,
    "connected_components_sparse": _sparse(q_connected_components),
    "partition_nodes_sparse": _sparse(q_partition_nodes),
    "khop_nodes_sparse": _sparse(q_khop_nodes),
    "induced_subgraph_sparse": _sparse(q_induced_subgraph),
    "build_shards_sparse": _sparse(q_build_shards),
    "shard_pairs_sparse": _sparse(q_shard_pairs),
    "shard_roundtrip_sparse": _sparse(q_shard_roundtrip),
    "sharded_match_sparse": _sparse(q_sharded_match),
    "classify_changes_sparse": _sparse(q_classify_changes),
    "nodes_read": q_nodes_read,
    "edges_read": q_edges_read,
    "match_files": q_match_files,
    "neighbor_lists": q_neighbor_lists,
    "truth_tabs": q_truth_tabs,
    "evaluate_report": q_evaluate_report,
    "detect_all_nodes": q_detect_all_nodes,
    "simrank_directed": q_simrank_directed,
    "best_match_depth3": q_best_match_depth3,
    "best_match_depth3_sparse": _sparse(q_best_match_depth3),
    "best_match_hot": q_best_match_hot,
    "shard_read_parts": q_shard_read_parts,
    "match_skips": q_match_skips,
}
