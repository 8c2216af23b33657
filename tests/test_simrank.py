"""Golden vector T1 (the reference's own SimRank fixture) and depth edge cases."""

import pytest

from conftest import graph
from snapdiff.operators import similarity as S

ORIG_ADJ = {1: [2, 3], 2: [1, 3, 4], 3: [1, 2], 4: [2]}
ORIG_VAL = {1: "A", 2: "B", 3: "C", 4: "D"}
PERT_ADJ = {5: [6, 7], 6: [5, 7, 8], 7: [5, 6], 8: [6], 9: [8]}
PERT_VAL = {5: "A", 6: "Y", 7: "C", 8: "D", 9: "Z"}


@pytest.fixture(scope="module")
def graphs(spark):
    return graph(spark, ORIG_ADJ, ORIG_VAL), graph(spark, PERT_ADJ, PERT_VAL)


def pairs(df):
    return {(r["a"], r["b"]): round(r["score"], 12) for r in df.collect()}


def test_all_pairs_depth2(graphs):
    got = pairs(S.simrank_pairs(*graphs, decay=0.63, depth=2))
    expected = {
        (1, 5): 1.0, (3, 7): 1.0, (4, 8): 1.0,
        (2, 5): 0.105, (2, 6): 0.21, (2, 7): 0.105, (2, 9): 0.21,
        (1, 6): 0.105, (3, 6): 0.105,
    }
    assert got == expected


def test_best_match_both_directions(graphs):
    m = {(r["side"], r["node_id"]): (r["match_id"], r["score"]) for r in S.match_from_graphs(*graphs).collect()}
    assert m[("original", 1)] == (5, 1.0)
    assert m[("original", 3)] == (7, 1.0)
    assert m[("original", 4)] == (8, 1.0)
    # 0.63*3/9 and 0.63/3 tie after rounding: the least id wins
    assert m[("original", 2)] == (6, 0.21)
    assert m[("perturbed", 5)] == (1, 1.0)
    assert m[("perturbed", 6)] == (2, 0.21)
    assert m[("perturbed", 9)] == (2, 0.21)
    assert len(m) == 9


def test_depth_zero_and_one(graphs):
    zero = S.match_from_graphs(*graphs, depth=0).collect()
    assert all(r["score"] == 0.0 and r["match_id"] is None for r in zero)
    one = {(r["side"], r["node_id"]): r["score"] for r in S.match_from_graphs(*graphs, depth=1).collect()}
    assert one[("original", 2)] == 0.0 and one[("original", 1)] == 1.0
    assert pairs(S.simrank_pairs(*graphs, depth=1)) == {(1, 5): 1.0, (3, 7): 1.0, (4, 8): 1.0}


def test_pruned_top_level_equals_unpruned(graphs):
    """best_match prunes the top level to unmatched nodes; the scores it reports
    must equal the argmax over the full pair relation."""
    full = S.simrank_pairs(*graphs, depth=3).collect()
    best = {}
    for r in full:
        k = r["a"]
        cand = (round(r["score"], 12), -r["b"])
        best[k] = max(best.get(k, cand), cand)
    m = {r["node_id"]: (r["match_id"], r["score"]) for r in S.match_from_graphs(*graphs, depth=3).collect() if r["side"] == "original"}
    for a, (s, nb) in best.items():
        assert m[a] == (-nb, s)


def test_scores_are_bounded(graphs):
    for depth in (2, 3):
        for r in S.simrank_pairs(*graphs, depth=depth).collect():
            assert r["score"] == 1.0 or 0 < r["score"] <= 0.63
