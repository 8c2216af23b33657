"""snapdiff: graph snapshot change detection as Spark DataFrame jobs."""

from snapdiff.operators.classify import classify, split_scores
from snapdiff.operators.evaluate import confusion_scores, score_report, scores_long, traceability_scores
from snapdiff.operators.graph import (
    build_shards,
    connected_components,
    degrees,
    induced,
    isolated_nodes,
    khop,
    out_adjacency,
    partition_nodes,
    shard_pairs,
    undirected,
)
from snapdiff.operators.similarity import (
    best_match,
    label_match,
    match_from_graphs,
    sharded_match,
    simrank,
    unmatched_nodes,
)
from snapdiff.plans.change_detection import detect_changes, detect_changes_sharded, evaluate

__all__ = [
    "best_match",
    "build_shards",
    "classify",
    "confusion_scores",
    "connected_components",
    "degrees",
    "detect_changes",
    "detect_changes_sharded",
    "evaluate",
    "induced",
    "isolated_nodes",
    "khop",
    "label_match",
    "match_from_graphs",
    "out_adjacency",
    "partition_nodes",
    "score_report",
    "scores_long",
    "shard_pairs",
    "sharded_match",
    "simrank",
    "split_scores",
    "traceability_scores",
    "undirected",
    "unmatched_nodes",
]
