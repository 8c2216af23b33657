"""Graph operators: T6 undirected view, T7 k-hop, components, partitioning."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from snapdiff.operators import graph as G


def edges(spark, rows):
    return spark.createDataFrame(rows, "src long, dst long")


def test_undirected_and_isolated(spark):
    e = edges(spark, [(1, 2), (2, 1), (3, 3)])
    nodes = spark.createDataFrame([(i, str(i)) for i in range(1, 5)], "node_id long, stored_value string")
    adj = G.undirected(e)
    assert sorted(map(tuple, adj.collect())) == [(1, 2), (2, 1), (3, 3)]
    assert [r["node_id"] for r in G.isolated_nodes(nodes, adj).collect()] == [4]
    deg = {r["node_id"]: r["degree"] for r in G.degrees(adj).collect()}
    assert deg == {1: 1, 2: 1, 3: 1}


def test_out_adjacency_left_join_and_chunks(spark):
    nodes = spark.createDataFrame([(i, str(i)) for i in range(1, 4)], "node_id long, stored_value string")
    e = edges(spark, [(1, 3), (1, 2)] + [(2, k) for k in range(100, 100 + 2 * G.LIST_CHUNK + 5)])
    rows = G.out_adjacency(nodes, e).collect()
    assert any(r["node_id"] == 3 and r["dst"] is None for r in rows)
    lists = {(r["node_id"], r["chunk"]): r["neighbors"] for r in G.out_adjacency(nodes, e, as_lists=True).collect()}
    assert lists[(1, 0)] == [2, 3]
    assert max(len(v) for v in lists.values()) <= 2 * G.LIST_CHUNK
    assert sum(len(v) for (n, _), v in lists.items() if n == 2) == 2 * G.LIST_CHUNK + 5


def test_khop_is_exact_bfs(spark):
    # s=1, x=2, y=3, z=4: edges s-x, s-y, x-y, y-z
    adj = G.undirected(edges(spark, [(1, 2), (1, 3), (2, 3), (3, 4)]))
    seeds = spark.createDataFrame([(0, 1)], "part int, node_id long")
    two = sorted(r["node_id"] for r in G.khop(adj, seeds, 2).collect())
    one = sorted(r["node_id"] for r in G.khop(adj, seeds, 1).collect())
    assert two == [1, 2, 3, 4] and one == [1, 2, 3]


def test_components_on_chains_and_cycles(spark):
    rows = [(i, i + 1) for i in range(100, 140)]  # a long chain
    rows += [(7, 5), (5, 9), (9, 7)]  # a triangle
    rows += [(1000, 2000)]
    adj = G.undirected(edges(spark, rows))
    cc = {r["node_id"]: r["component"] for r in G.connected_components(adj).collect()}
    assert all(cc[i] == 100 for i in range(100, 141))
    assert cc[5] == cc[7] == cc[9] == 5
    assert cc[1000] == cc[2000] == 1000


def test_components_random_against_union_find(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(250)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in rows:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    adj = G.undirected(edges(spark, rows))
    got = {r["node_id"]: r["component"] for r in G.connected_components(adj).collect()}
    members = {}
    for n in got:
        members.setdefault(find(n), []).append(n)
    for root, ns in members.items():
        assert {got[n] for n in ns} == {min(ns)}


def test_global_row_number_matches_window(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame(
        [(rnd.randrange(5), rnd.randrange(10_000), i) for i in range(2000)], "g int, k long, id long"
    )
    ours = {(r["g"], r["id"]): r["row_number"] for r in G.global_row_number(df, ["k", "id"], ["g"]).collect()}
    w = Window.partitionBy("g").orderBy("k", "id")
    ref = {(r["g"], r["id"]): r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert ours == ref


def test_partition_balanced_disjoint_cover(spark):
    rows = [(i, i + 1) for i in range(0, 50)] + [(i, i + 1) for i in range(100, 131)] + [(200, 201)]
    adj = G.undirected(edges(spark, rows))
    parts = G.partition_nodes(adj, 3).collect()
    ids = [r["node_id"] for r in parts]
    assert len(ids) == len(set(ids)) == adj.select("src").distinct().count()
    sizes = {}
    for r in parts:
        sizes[r["part"]] = sizes.get(r["part"], 0) + 1
    assert set(sizes) == {0, 1, 2} and max(sizes.values()) - min(sizes.values()) <= 1
    # ntile order: components stay contiguous
    by_part = {}
    for r in parts:
        by_part.setdefault(r["part"], []).append(r["node_id"])
    assert max(by_part[0]) < min(by_part[1]) < min(by_part[2])


def test_fewer_nodes_than_parts(spark):
    adj = G.undirected(edges(spark, [(1, 2)]))
    parts = G.partition_nodes(adj, 3).collect()
    assert sorted(r["part"] for r in parts) == [0, 1]


def test_induced_and_shards(spark):
    rows = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6)]
    nodes = spark.createDataFrame([(i, f"v{i}") for i in range(1, 8)], "node_id long, stored_value string")
    shard_nodes, shard_adj = G.build_shards(nodes, edges(spark, rows), k=2, hops=1)
    sn = shard_nodes.collect()
    subjects = sorted((r["part"], r["node_id"]) for r in sn if r["is_subject"])
    assert subjects == [(0, 1), (0, 2), (0, 3), (1, 4), (1, 5), (1, 6)]
    halo0 = sorted(r["node_id"] for r in sn if r["part"] == 0)
    assert halo0 == [1, 2, 3, 4]
    e0 = sorted((r["src"], r["dst"]) for r in shard_adj.collect() if r["part"] == 0)
    assert e0 == [(1, 2), (2, 1), (2, 3), (3, 2), (3, 4), (4, 3)]


def test_hub_holding_a_third_of_edges(spark):
    """One node touches a third of all edges; results stay exact."""
    hub = [(0, i) for i in range(1, 1001)]
    chains = [(i, i + 1) for i in range(1001, 3000)]
    adj = G.undirected(edges(spark, hub + chains))
    cc = {r["node_id"]: r["component"] for r in G.connected_components(adj).collect()}
    assert all(cc[i] == 0 for i in range(0, 1001)) and all(cc[i] == 1001 for i in range(1001, 3001))
    deg = {r["node_id"]: r["degree"] for r in G.degrees(adj).collect()}
    assert deg[0] == 1000
    seeds = spark.createDataFrame([(0, 5)], "part int, node_id long")
    reach = {r["node_id"] for r in G.khop(adj, seeds, 2).collect()}
    assert reach == set(range(0, 1001))


def test_component_rounds_keep_the_planned_size_small(spark):
    """Many rounds: the size that the planner sees is that of stored rows, not a product over all rounds."""
    got = G.connected_components(edges(spark, [(i, i + 1) for i in range(60)]))
    size = got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert size < 10**40
    assert got.where("component <> 0").count() == 0 and got.count() == 61


def test_component_rounds_store_each_edge_once(spark):
    """Both directions of an edge are one row of a round's table, whichever way the adjacency is given."""
    held = []

    def keep(df):
        held.append(sorted(tuple(r) for r in df.collect()) if df.columns == ["u", "v"] else None)
        return df

    rows = [(1, 2), (2, 3), (3, 1), (4, 4), (5, 6), (6, 5)]
    loose = {tuple(r) for r in G.connected_components(edges(spark, rows), keep).collect()}
    adj = G.undirected(edges(spark, rows))
    assert loose == {tuple(r) for r in G.connected_components(adj, keep, symmetric=True).collect()}
    assert loose == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5)}
    assert [h for h in held if h is not None].count([(1, 2), (1, 3), (2, 3), (5, 6)]) == 2


def test_leaves_of_a_star_go_in_a_few_rounds(spark):
    """Leaves whose centre ranks after some of them no longer halve round by round."""
    rounds = []

    def keep(df):
        rounds.append(df.columns == ["u", "v"])
        return G._round_table(df)

    # the least id is a leaf of the leaves, so the first round (by id) cannot fold the star
    star = [(1000, i) for i in range(500)] + [(i, i + 2000) for i in range(500)]
    got = G.connected_components(edges(spark, star), keep).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 1001
    assert sum(rounds) <= 6


def test_the_last_edges_are_joined_without_rounds(spark):
    """A path of 60 nodes takes one rewritten edge table, not one a halving."""
    tables = []

    def keep(df):
        tables.append(df.columns == ["u", "v"])
        return G._round_table(df)

    got = G.connected_components(edges(spark, [(i, i + 1) for i in range(60)]), keep).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 61
    assert sum(tables) <= 2


@pytest.mark.parametrize("rest", [0, 5, 1 << 16])
def test_components_do_not_depend_on_where_the_rounds_end(spark, rest):
    """Null ends, loops, copies of edges and nodes with a loop only, against plain union-find."""
    rng = random.Random(rest)
    rows = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    rows += [(900, 900), (901, None), (None, 902), (7, 7), *rows[:20]] + [(i, i + 1) for i in range(1000, 1040)]
    up = {x: x for r in rows for x in r if x is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for u, v in rows:
        if u is not None and v is not None:
            u, v = top(u), top(v)
            up[max(u, v)] = min(u, v)
    got = G.connected_components(edges(spark, rows), rest=rest).collect()
    assert sorted((r["node_id"], r["component"]) for r in got) == sorted((x, top(x)) for x in up)
    adj = G.undirected(edges(spark, rows))
    again = G.connected_components(adj, symmetric=True, rest=rest).collect()
    assert {r["node_id"]: r["component"] for r in again} == {x: top(x) for x in up if x not in (901, 902)}


def test_undirected_deals_out_each_edge_once(spark):
    """Both directions come from one row of an edge; loops stay single, nulls go."""
    rows = [(1, 2), (2, 1), (2, 1), (3, 3), (3, 3), (4, None), (None, 5), (6, 2)]
    adj = G.undirected(edges(spark, rows))
    assert sorted(tuple(r) for r in adj.collect()) == [(1, 2), (2, 1), (2, 6), (3, 3), (6, 2)]
    assert adj._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0
