"""Row products against brute force, with blocks, profile rows and product batches of a few entries."""

import random

import pytest

import snapdiff.operators.products as P
from conftest import graph
from snapdiff.operators import graph as G
from snapdiff.operators import similarity as S
from test_bruteforce import brute, random_graph


@pytest.fixture
def small_pieces(monkeypatch):
    for name, n in (("PROFILE_CHUNK", 2), ("BLOCK", 40), ("WIDE_BLOCK", 60), ("PRODUCTS", 7), ("BATCH", 3)):
        monkeypatch.setattr(P, name, n)


def two_graphs(seed, spark, n_values=25):
    rnd = random.Random(seed)
    adj_o, val_o = random_graph(rnd, list(range(1, 41)), 70, 0.2, n_values)
    adj_p, val_p = random_graph(rnd, list(range(11, 51)), 70, 0.2, n_values)
    val_o[min(adj_o)] = None  # met by nobody, and unequal to all
    return (adj_o, val_o), (adj_p, val_p), graph(spark, adj_o, val_o), graph(spark, adj_p, val_p)


def pair_plan(spark, depth):
    """The pairs' final plan without what lies before the products."""
    *_, go, gp = two_graphs(7, spark)
    plan = S.simrank_pairs(go, gp, depth=depth)._jdf.queryExecution().toString()
    return plan.split("== Physical Plan ==")[1]


def all_pairs_match(spark, depth):
    (adj_o, val_o), (adj_p, val_p), go, gp = two_graphs(31 + depth, spark)
    want = {k: v for k, v in brute(adj_o, val_o, adj_p, val_p, 0.63, depth).items() if v > 0}
    rows = S.simrank_pairs(go, gp, depth=depth).collect()
    got = {(r["a"], r["b"]): r["score"] for r in rows}
    assert len(rows) == len(got) and set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_pairs_of_level_2_are_not_shuffled(spark, small_pieces):
    plan = pair_plan(spark, 2)
    assert "hashpartitioning(a#" not in plan and "MapInArrow" in plan
    all_pairs_match(spark, 2)


def test_pairs_of_level_3_are_not_shuffled(spark, small_pieces):
    plan = pair_plan(spark, 3)
    assert "hashpartitioning(a#" not in plan and "MapInArrow" in plan
    all_pairs_match(spark, 3)


def best_pairs_match(spark, depth, seed):
    (adj_o, val_o), (adj_p, val_p), go, gp = two_graphs(seed, spark)
    ref = brute(adj_o, val_o, adj_p, val_p, 0.63, depth)
    got = {(r["side"], r["node_id"]): (r["match_id"], r["score"]) for r in S.match_from_graphs(go, gp, depth=depth).collect()}
    for side, nodes, others, key in (("original", adj_o, adj_p, lambda a, b: (a, b)), ("perturbed", adj_p, adj_o, lambda a, b: (b, a))):
        for n in nodes:
            scored = [(round(ref[key(n, m)], 12), -m) for m in others if ref[key(n, m)] > 0]
            assert got[(side, n)] == ((-max(scored)[1], max(scored)[0]) if scored else (None, 0.0))


@pytest.mark.parametrize("seed", [41, 42])
def test_best_of_level_3_makes_no_table_of_pairs(spark, small_pieces, monkeypatch, seed):
    def never(*args, **kwargs):
        raise AssertionError("a table of pairs")

    monkeypatch.setattr(S, "_level", never)
    best_pairs_match(spark, 3, seed)


def test_nodes_without_a_row(spark, small_pieces):
    """A neighbour without a node row counts in the degree and scores nothing."""
    adj_o, adj_p = {1: [2, 9], 2: [1], 9: [1]}, {11: [12, 19], 12: [11], 19: [11]}
    go = graph(spark, adj_o, {1: "a", 2: "b"})
    gp = graph(spark, adj_p, {11: "x", 12: "b"})
    for depth, want in ((2, 0.63 / 4), (3, 0.63 / 4)):
        got = {(r["a"], r["b"]): r["score"] for r in S.simrank_pairs(go, gp, depth=depth).collect()}
        assert got[(2, 12)] == 1.0 and got[(1, 11)] == pytest.approx(want, abs=1e-12)
        assert {k[0] for k in got} <= {1, 2} and {k[1] for k in got} <= {11, 12}


def shards(spark, seed, parts=3):
    """Two graphs of many small components and a hub: shards that differ, with a node row that comes twice."""
    rnd = random.Random(seed)
    ids = list(range(1, 61))
    edges = {tuple(sorted(rnd.sample(ids, 2))) for _ in range(45)} | {(1, i) for i in range(2, 14)}
    cut = {e for e in edges if rnd.random() < 0.9}
    values = {i: f"v{rnd.randrange(25)}" for i in ids}
    changed = {i: (v + "#" if i % 5 == 0 else v) for i, v in values.items()}
    frame = lambda v: spark.createDataFrame([*v.items(), (7, "twice")], "node_id long, stored_value string")
    link = lambda e: spark.createDataFrame(sorted(e), "src long, dst long")
    return (frame(values), link(edges)), (frame(changed), link(cut))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("budget", [None, 8])
def test_best_of_shards_by_row_products(spark, small_pieces, monkeypatch, budget):
    """The same as by joins, from rows a part and from bits, with hot values and without; no table of pairs, no row a part and edge."""
    from snapdiff.operators import skew
    from snapdiff.plans import change_detection as C

    if budget:
        monkeypatch.setattr(skew, "PAIRS_PER_TASK", budget)
        monkeypatch.setattr(S, "HOT_VALUES", 3)
    o, p = shards(spark, 5)
    so, sp = G.build_shards(*o), G.build_shards(*p)
    with monkeypatch.context() as m:
        m.setattr(S, "_fits_products", lambda *args, **kwargs: False)
        want = rows_of(S.sharded_match(*so, *sp))

    def never(*args, **kwargs):
        raise AssertionError("a table of pairs, or of edges by part")

    monkeypatch.setattr(S, "_level", never)
    assert rows_of(S.sharded_match(*so, *sp)) == want
    monkeypatch.setattr(S, "with_degrees", never)
    assert rows_of(C.sharded_matches(*o, *p)) == want


def test_sharded_changes_keep_no_checkpoint_of_matches(spark, small_pieces, monkeypatch):
    """The same changes as from the matches by joins; what grows with all nodes is a written table."""
    from snapdiff.operators.classify import classify
    from snapdiff.plans import change_detection as C

    o, p = shards(spark, 6)
    with monkeypatch.context() as m:
        m.setattr(S, "_fits_products", lambda *args, **kwargs: False)
        want = rows_of(classify(S.sharded_match(*G.build_shards(*o), *G.build_shards(*p)), "two_seeds"))

    def never(df):
        raise AssertionError("a checkpoint")

    monkeypatch.setattr(C, "cut_lineage", never)
    assert rows_of(C.detect_changes_sharded(*o, *p)) == want and want
