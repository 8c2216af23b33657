"""F1 / F2: snapshots in, changes and scores out.

``detect_changes`` is the production path: whole-graph matching with the
top level of SimRank pruned to nodes that lack a value-equal partner.
``detect_changes_sharded`` follows the original job's shape (partition each
snapshot, add a k-hop halo, match per shard pair, keep the best per node);
it exists for users who need those per-shard scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapdiff.operators.classify import classify
from snapdiff.operators.evaluate import confusion_scores, score_report, traceability_scores
from snapdiff.operators.graph import shard_masks
from snapdiff.operators.similarity import DEFAULT_DECAY, DEFAULT_DEPTH, best_match, mask_match
from snapdiff.session import cut_lineage, in_parallel, stored
from snapdiff.sources.graph_io import node_count_values

# Fixed defaults of the sharded flow.
DEFAULT_PARTS = 3
DEFAULT_HOPS = 2


def detect_changes(
    nodes_o: DataFrame,
    edges_o: DataFrame,
    nodes_p: DataFrame,
    edges_p: DataFrame,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
    method: str = "two_means",
    drop_isolated: bool = True,
) -> DataFrame:
    """``changes(change_type, node_id)`` between two snapshots. Nodes without an
    edge are compared only with ``drop_isolated=False``; an added isolated node
    can then be reported."""
    matches = cut_lineage(best_match(nodes_o, edges_o, nodes_p, edges_p, decay, depth, drop_isolated))
    return classify(matches, method)


def sharded_matches(
    nodes_o: DataFrame,
    edges_o: DataFrame,
    nodes_p: DataFrame,
    edges_p: DataFrame,
    parts: int = DEFAULT_PARTS,
    hops: int = DEFAULT_HOPS,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
) -> DataFrame:
    def masks(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        node_masks, adj_masks = shard_masks(nodes, edges, parts, hops)
        return stored(node_masks, "shard-nodes"), stored(adj_masks, "shard-adjacency")

    masks_o, masks_p = in_parallel(lambda: masks(nodes_o, edges_o), lambda: masks(nodes_p, edges_p))
    return mask_match(masks_o, masks_p, parts, decay, depth)


def detect_changes_sharded(
    nodes_o: DataFrame,
    edges_o: DataFrame,
    nodes_p: DataFrame,
    edges_p: DataFrame,
    parts: int = DEFAULT_PARTS,
    hops: int = DEFAULT_HOPS,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
    method: str = "two_seeds",
) -> DataFrame:
    matches = stored(sharded_matches(nodes_o, edges_o, nodes_p, edges_p, parts, hops, decay, depth), "matches")
    return classify(matches, method)


def evaluate(
    pred: DataFrame,
    truth: DataFrame,
    n_o: int,
    n_p: int,
    changed_pred: str = "removed_added",
) -> tuple[DataFrame, DataFrame]:
    """(confusion per change type, traceability row)."""
    pred = cut_lineage(pred)
    return confusion_scores(pred, truth, n_o, n_p), traceability_scores(pred, truth, n_o, n_p, changed_pred)


def evaluate_snapshots(
    pred: DataFrame, truth: DataFrame, nodes_o: DataFrame, nodes_p: DataFrame, changed_pred: str = "removed_added"
) -> DataFrame:
    """F2 end to end: the flat rounded report."""
    n_o, n_p = node_count_values(nodes_o, nodes_p)
    conf, tl = evaluate(pred, truth, n_o, n_p, changed_pred)
    return score_report(conf, tl)
