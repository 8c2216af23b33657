"""k-hop and induced edges on bit sets against plain breadth-first search."""

import random

from pyspark.sql import functions as F

from snapdiff.operators import graph as G


def random_adj(rng, n, m):
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    return sorted(edges | {(b, a) for a, b in edges})


def bfs(adj, seeds, hops):
    out = set()
    near = {}
    for a, b in adj:
        near.setdefault(a, []).append(b)
    for part, node in seeds:
        level, seen = {node}, {node}
        for _ in range(hops):
            level = {y for x in level for y in near.get(x, [])} - seen
            seen |= level
        out |= {(part, x) for x in seen}
    return out


def test_two_hundred_parts(spark):
    rng = random.Random(7)
    adj = random_adj(rng, 300, 330)
    seeds = [(rng.randrange(200), rng.randrange(320)) for _ in range(400)] + [(199, 0), (0, 0), (61, 1), (62, 1), (61, 1)]
    edges = spark.createDataFrame(adj, "src long, dst long")
    rows = spark.createDataFrame(seeds, "part int, node_id long")
    for hops in (0, 1, 3):
        want = bfs(adj, seeds, hops)
        got = G.khop(edges, rows, hops).collect()
        assert len(got) == len(want) and {(r["part"], r["node_id"]) for r in got} == want
    members = G.khop_masks(edges, G.part_masks(rows, 200), 1)
    assert members.count() == len({x for _, x in bfs(adj, seeds, 1)})  # one row a node
    inside = bfs(adj, seeds, 1)
    want = {(p, a, b) for a, b in adj for p in range(200) if (p, a) in inside and (p, b) in inside}
    got = G.mask_parts(G.induced_masks(edges, members)).collect()
    assert len(got) == len(want) and {(r["part"], r["src"], r["dst"]) for r in got} == want
    listed = spark.createDataFrame(sorted(inside), "part int, node_id long")
    assert {tuple(r) for r in G.induced(edges, listed).select("part", "src", "dst").collect()} == want


def test_adjacency_is_read_once(spark):
    adj = spark.range(50).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    adj.createOrReplaceTempView("some_edges")
    plans = []
    for parts in (3, 150):
        seeds = spark.range(parts).select(F.col("id").cast("int").alias("part"), (F.col("id") % 40).alias("node_id"))
        met = G.mask_parts(G.induced_masks(spark.table("some_edges"), G.part_masks(seeds, parts)))
        plans.append(met._jdf.queryExecution().optimizedPlan().toString())
    assert [p.count("Range (0, 50") for p in plans] == [1, 1]


def test_no_members(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long")
    none = spark.createDataFrame([], "part int, node_id long")
    assert G.khop(edges, none).count() == 0 and G.induced(edges, none).count() == 0


def test_only_bits_of_given_parts_are_looked_at(spark):
    """A row's bits are looked at for as many parts as there are, not for all that its columns hold."""
    seeds = spark.createDataFrame([(0, 1), (2, 1), (1, 2), (64, 2)], "part int, node_id long")
    want = sorted((r["part"], r["node_id"]) for r in seeds.collect())
    for parts in (65, None):
        got = G.mask_parts(G.part_masks(seeds, 65), parts).collect()
        assert sorted((r["part"], r["node_id"]) for r in got) == want
    few = G.khop(spark.createDataFrame([(1, 2)], "src long, dst long"), seeds.where("part < 3"), 1, 3)
    plan = few._jdf.queryExecution().analyzed().toString()
    assert "sequence(0, 2" in plan and "sequence(0, 61" not in plan
