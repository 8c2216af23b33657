"""Cross-snapshot similarity: value matches, depth-limited SimRank, best match.

Definition (per pair a of the original snapshot, b of the perturbed one,
N = undirected neighbours, C = decay):

    s_0(a, b) = 0
    s_k(a, b) = 1                                   if value(a) = value(b)
              = C / (|N(a)| |N(b)|) * sum s_{k-1}(x, y) over x in N(a), y in N(b)

It is computed level by level as sparse relations, never as an N x M grid:

* value-equal pairs E are never materialized for an inner level: their
  contribution to level k is the number of value-equal neighbour pairs,
  obtained by joining per-node value counts ``(a, value, n)`` on value;
* the non-equal positive pairs R_k are joined with both adjacencies
  (``adj_o(a, x) ⋈ R(x, y) ⋈ adj_p(b, y)``) and summed per (a, b);
* up to level 3 (level 2 with contexts) both steps are row products
  (:mod:`snapdiff.operators.products`), which store and shuffle no pairs; the
  joins here make the levels beyond;
* only nodes without a value-equal partner can score below one, so the top
  level is computed only for them (``restrict``): everything else is a
  perfect match found by a semi-join on value.

Every graph may carry *context* columns (the shard id for sharded matching);
they are simply extra join keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdiff.functions.exprs import ORIGINAL, PERTURBED, score_key, score_shown
from snapdiff.operators import products
from snapdiff.operators.graph import active_nodes, global_row_number, shards_of, undirected
from snapdiff.operators.skew import hot_keys, salted_join
from snapdiff.session import cut_lineage, in_parallel, stored

# Fixed defaults of the similarity step.
DEFAULT_DECAY = 0.63
DEFAULT_DEPTH = 2

# So many hot values at most go by their lists instead of by pairs; a node's counts of them are one row.
HOT_VALUES = 256
# Rows read from each hot value's list at first, and how much deeper each next round reads.
FIRST_ROWS, DEEPER = 16, 8


@dataclass
class SideGraph:
    """One snapshot as relations. ``vals`` lists the candidate nodes (the
    adjacency keys) with their values; ``adj`` the (directed) neighbour rows,
    each carrying its source's neighbour count ``sdeg``; ``ctx`` the context
    columns carried by both (e.g. the shard id)."""

    vals: DataFrame  # (*ctx, node_id, stored_value)
    adj: DataFrame  # (*ctx, src, dst, sdeg)
    ctx: list[str] = field(default_factory=list)
    # of shards made from bits: their node and edge rows and the number of parts (``adj`` then has no ``sdeg``)
    masks: tuple[DataFrame, DataFrame, int] | None = None


def with_degrees(adj: DataFrame, ctx: list[str]) -> DataFrame:
    """Attach each row's source degree (A2) — one aggregate and one join, once per graph.

    The degrees are stored first: with a plain shuffle on either side AQE can
    split a hub's rows over tasks, which it cannot above an aggregate."""
    deg = cut_lineage(adj.groupBy(*ctx, "src").agg(F.count(F.lit(1)).alias("sdeg")))
    return adj.select(*ctx, "src", "dst").join(deg, [*ctx, "src"])


def whole_graph(nodes: DataFrame, edges: DataFrame, drop_isolated: bool = True, directed: bool = False) -> SideGraph:
    """Snapshot as one graph over distinct node ids (of a repeated id the least value counts).

    The adjacency is undirected and distinct, or with ``directed`` the given
    distinct rows. Candidates are the nodes with a neighbour, or with
    ``drop_isolated=False`` all nodes."""
    rows = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst").distinct()
    adj = stored(with_degrees(stored(rows if directed else undirected(edges), "adjacency"), []), "adjacency")
    single = nodes.groupBy("node_id").agg(F.min("stored_value").alias("stored_value"))
    vals = stored(active_nodes(single, adj) if drop_isolated else single, "values")
    return SideGraph(vals=vals, adj=adj)


def _rename_ctx(df: DataFrame, ctx: list[str], suffix: str) -> DataFrame:
    for c in ctx:
        df = df.withColumnRenamed(c, f"{c}{suffix}")
    return df


def _pair_keys(go: SideGraph, gp: SideGraph) -> tuple[list[str], list[str]]:
    return [f"{c}_o" for c in go.ctx], [f"{c}_p" for c in gp.ctx]


def _value_counts(g: SideGraph, adj: DataFrame, node: str, suffix: str) -> DataFrame:
    """(*ctx, node, stored_value, n, deg): how many neighbours of ``node``
    hold each value, plus the node's degree."""
    vals = g.vals.select(*g.ctx, F.col("node_id").alias("dst"), "stored_value")
    counts = (
        adj.join(vals, [*g.ctx, "dst"])
        .groupBy(*g.ctx, F.col("src").alias(node), "stored_value")
        .agg(F.count(F.lit(1)).alias(f"n{suffix}"), F.max("sdeg").alias(f"deg_{node}"))
    )
    return _rename_ctx(counts, g.ctx, suffix)


def _level(
    go: SideGraph,
    gp: SideGraph,
    prev: DataFrame | None,
    decay: float,
    restrict_o: DataFrame | None = None,
    restrict_p: DataFrame | None = None,
    drop_equal: bool = True,
    best_for: str | None = None,
    pairs_per_task: int | None = None,
) -> DataFrame:
    """Non-equal pairs with positive score at one level (>= 2).

    ``prev`` holds the non-equal positive pairs of the level below as
    ``(*ctx_o, a, *ctx_p, b, score)`` (None at level 2, where only value-equal
    pairs score). ``restrict_o`` / ``restrict_p`` limit a / b to a node set
    ``(*ctx, node_id)`` — the top-level pruning. ``drop_equal=False`` skips
    removing value-equal pairs, valid when the restricted nodes have no
    value-equal partner at all.

    ``best_for='o'|'p'`` asks only for enough pairs to find each restricted
    node's best partner. Hot shared values (more than ``pairs_per_task`` pairs)
    are then not expanded into pairs (see :func:`_hot_value_candidates`), which
    keeps values held by a large share of all nodes linear instead of quadratic."""
    ko, kp = _pair_keys(go, gp)
    adj_o, adj_p = go.adj, gp.adj
    if restrict_o is not None:
        adj_o = adj_o.join(restrict_o.withColumnRenamed("node_id", "src"), [*go.ctx, "src"], "left_semi")
    if restrict_p is not None:
        adj_p = adj_p.join(restrict_p.withColumnRenamed("node_id", "src"), [*gp.ctx, "src"], "left_semi")

    # value-equal neighbour pairs, pre-aggregated per (node, value) on each side;
    # a value shared by many nodes is spread over a salt grid (skew.salted_join)
    # stored once: read by the key counts, the join and the hot value's candidates
    vc_o = cut_lineage(_value_counts(go, adj_o, "a", "_o"))
    vc_p = cut_lineage(_value_counts(gp, adj_p, "b", "_p"))
    hot = cut_lineage(hot_keys(vc_o, vc_p, ["stored_value"], pairs_per_task))
    listed: list[str] = []
    if best_for is not None:
        top = hot.orderBy(F.col("_pairs").desc(), "stored_value").select("stored_value").limit(HOT_VALUES).collect()
        listed = [r["stored_value"] for r in top]
    if listed:
        cold = ~F.col("stored_value").isin(listed)
        hot = hot.where(cold)
        value_pairs = salted_join(vc_o.where(cold), vc_p.where(cold), ["stored_value"], [*ko, "a"], [*kp, "b"], hot=hot)
    else:
        value_pairs = salted_join(vc_o, vc_p, ["stored_value"], [*ko, "a"], [*kp, "b"], hot=hot)
    contrib = value_pairs.select(
        *ko, "a", *kp, "b",
        (F.col("n_o") * F.col("n_p")).alias("e"),
        F.lit(0.0).alias("q"),
        "deg_a", "deg_b",
    )
    if prev is not None:
        # sum_{x in N(a), y in N(b)} R(x, y) as (A_o R) A_p^T: aggregate per (a, y)
        # before the second join. Sums of positive doubles: their order moves the last
        # bits only, which comparisons of deeper levels leave out (score_key).
        ao = _rename_ctx(adj_o, go.ctx, "_o").select(
            *ko, F.col("src").alias("a"), F.col("dst").alias("x"), F.col("sdeg").alias("deg_a")
        )
        ap = _rename_ctx(adj_p, gp.ctx, "_p").select(
            *kp, F.col("src").alias("b"), F.col("dst").alias("y"), F.col("sdeg").alias("deg_b")
        )
        rq = prev.select(*ko, F.col("a").alias("x"), *kp, F.col("b").alias("y"), F.col("score").alias("q"))
        half = cut_lineage(
            salted_join(ao, rq, [*ko, "x"], ["a"], [*kp, "y"])
            .groupBy(*ko, "a", *kp, "y")
            .agg(F.sum("q").alias("q"), F.max("deg_a").alias("deg_a"))
        )
        via = salted_join(half, ap, [*kp, "y"], [*ko, "a"], ["b"]).select(
            *ko, "a", *kp, "b", F.lit(0).cast("long").alias("e"), "q", "deg_a", "deg_b"
        )
        contrib = contrib.unionByName(via)
    summed = contrib.groupBy(*ko, "a", *kp, "b").agg(
        F.sum("e").alias("e"), F.sum("q").alias("q"),
        F.max("deg_a").alias("deg_a"), F.max("deg_b").alias("deg_b"),
    )
    if listed:
        summed = _hot_value_candidates(summed, vc_o, vc_p, listed, ko, kp, best_for)
    summed = summed.select(
        *ko, "a", *kp, "b",
        (F.col("e").cast("double") + F.col("q")).alias("s"),
        "deg_a", "deg_b",
    )
    if drop_equal:
        val_o = _rename_ctx(go.vals, go.ctx, "_o").select(*ko, F.col("node_id").alias("a"), F.col("stored_value").alias("va"))
        val_p = _rename_ctx(gp.vals, gp.ctx, "_p").select(*kp, F.col("node_id").alias("b"), F.col("stored_value").alias("vb"))
        summed = (
            summed.join(val_o, [*ko, "a"])
            .join(val_p, [*kp, "b"])
            .where(~F.coalesce(F.col("va") == F.col("vb"), F.lit(False)))
        )
    return summed.select(
        *ko, "a", *kp, "b",
        # one division of whole numbers at depth 2: equal ratios give equal doubles
        (F.lit(float(decay)) * (F.col("s") / (F.col("deg_a").cast("double") * F.col("deg_b")))).alias("score"),
    )


def _profiles(counts: DataFrame, hot: list[str], keys: list[str], node: str, n: str, p: str, d: str) -> DataFrame:
    """``(*keys, node, p, d)``: a node's counts of the hot values as one array ``p`` of
    ``(v, n)`` (HOT_VALUES at most), and its degree."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col("stored_value").alias("v"), F.col(n).alias("n"))))
    return counts.where(F.col("stored_value").isin(hot)).groupBy(*keys, node).agg(pairs.alias(p), F.max(f"deg_{node}").alias(d))


def _dot(p: str, q: str) -> F.Column:
    """Sum over the values of both profiles of the product of their counts; 0 where one is missing."""
    return F.expr(
        f"coalesce(aggregate({p}, 0L, (t, x) -> t + x.n * coalesce(element_at(map_from_entries({q}), x.v), 0L)), 0L)"
    )


def best_by_lists(fixed: DataFrame, free: DataFrame) -> DataFrame:
    """For each fixed profile the free profile of the largest ``dot / d``, least ``rep`` on ties.

    ``fixed`` is ``(fid, p)``, ``free`` is ``(pid, q, d, rep)`` with ``rep`` a struct that
    begins with a node id. A threshold algorithm: every value has a list of the free
    profiles by descending n / d. All open fixed profiles read their lists to the
    same depth, score what they meet in full, and close when the best score exceeds what
    the next rows of the lists could still add up to. Each round reads DEEPER times as
    deep, so a round costs open profiles times values times depth, not the lists' product.
    Returns ``(fid, best)`` with ``best`` a struct ``(g, neg, rep, e, d)``.
    """
    lists = free.select("pid", "d", F.explode("q").alias("x")).select(
        F.col("x.v").alias("v"), (F.col("x.n") / F.col("d")).alias("ratio"), (-F.col("x.n") / F.col("d")).alias("order"), "pid")
    lists = cut_lineage(global_row_number(lists, ["order", "pid"], ["v"]).select("v", "ratio", "pid", F.col("row_number").alias("place")))
    done, open_ = None, fixed.select("fid", "p")
    seen, depth = 0, FIRST_ROWS
    held = None  # (fid, best) of the open profiles so far
    while True:
        want = cut_lineage(open_.select("fid", F.explode("p").alias("x")).select("fid", F.col("x.v").alias("v"), F.col("x.n").alias("n")))
        met = want.join(lists.where((F.col("place") > seen) & (F.col("place") <= depth)), "v").select("fid", "pid").distinct()
        scored = met.join(open_, "fid").join(free, "pid").withColumn("e", _dot("p", "q"))
        scored = scored.select("fid", F.struct(
            (F.col("e") / F.col("d")).alias("g"), (-F.col("rep")[_first_field(free, "rep")]).alias("neg"), "rep", "e", "d").alias("best"))
        scored = scored if held is None else scored.unionByName(held)
        best = scored.groupBy("fid").agg(F.max("best").alias("best"))
        ahead = want.join(lists.where(F.col("place") == depth + 1).select("v", "ratio"), "v").groupBy("fid").agg(
            F.sum(F.col("n") * F.col("ratio")).alias("bound"))
        best = cut_lineage(best.join(ahead, "fid", "left"))
        # a tie ahead may have a smaller id; the slack covers the bound's rounding
        still = F.coalesce(F.col("best.g") <= F.col("bound") * (1 + 1e-9), F.lit(False))
        over = best.where(~still).select("fid", "best")
        done = over if done is None else done.unionByName(over)
        held = best.where(still).select("fid", "best")
        if held.isEmpty():
            return done
        open_ = open_.join(held.select("fid"), "fid", "left_semi")
        seen, depth = depth, depth * DEEPER


def _first_field(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.fields[0].name


def _hot_value_candidates(
    summed: DataFrame, vc_o: DataFrame, vc_p: DataFrame, hot: list[str], ko: list[str], kp: list[str], best_for: str
) -> DataFrame:
    """Exact best-partner candidates without expanding the hot values.

    Pairs already enumerated (through any other value or the level below) get the
    hot values' terms ``n_a(v) * n_b(v)`` added. A partner that meets a node only
    through hot values scores ``C * sum n_a(v) n_b(v) / (d_a d_b)``, which for a fixed
    node depends on the partner's profile (its counts and degree) alone: equal
    profiles fold into the one with the least id, equal fixed profiles ask once,
    and :func:`best_by_lists` finds the best. A partner that also overlaps
    elsewhere is enumerated with a larger exact score, so the best per node is
    unchanged."""
    ho = cut_lineage(_profiles(vc_o, hot, ko, "a", "n_o", "pa", "deg_a"))
    hp = cut_lineage(_profiles(vc_p, hot, kp, "b", "n_p", "pb", "deg_b"))
    exact = (
        summed.join(ho.drop("deg_a"), [*ko, "a"], "left")
        .join(hp.drop("deg_b"), [*kp, "b"], "left")
        .select(*ko, "a", *kp, "b", (F.col("e") + _dot("pa", "pb")).alias("e"), "q", "deg_a", "deg_b")
    )
    if best_for == "o":
        free, free_keys, node, fq, fd, fixed, fp = hp, kp, "b", "pb", "deg_b", ho, "pa"
    else:
        free, free_keys, node, fq, fd, fixed, fp = ho, ko, "a", "pa", "deg_a", hp, "pb"
    asked = cut_lineage(fixed.groupBy(F.col(fp).alias("p")).agg(F.count(F.lit(1)).alias("n")).select(
        F.monotonically_increasing_id().alias("fid"), "p"))
    folded = free.groupBy(F.col(fq).alias("q"), F.col(fd).alias("d")).agg(F.min(F.struct(node, *free_keys)).alias("rep"))
    folded = cut_lineage(folded.select(F.monotonically_increasing_id().alias("pid"), "q", "d", "rep"))
    best = best_by_lists(asked, folded)
    cand = fixed.join(asked, fixed[fp] == asked["p"]).drop("p").join(best, "fid")
    cand = cand.select(
        *[c for c in fixed.columns if c != fp],
        *[F.col(f"best.rep.{c}").alias(c) for c in (node, *free_keys)],
        F.col("best.d").alias(fd), F.col("best.e").alias("e"), F.lit(0.0).alias("q"),
    )
    return exact.unionByName(cand.select(*exact.columns))


def neighbours(g: SideGraph, nodes: DataFrame) -> DataFrame:
    """``(*ctx, node_id)`` of the nodes next to the given ones, each once."""
    rows = g.adj.join(nodes.select(*g.ctx, F.col("node_id").alias("src")), [*g.ctx, "src"], "left_semi")
    return rows.select(*g.ctx, F.col("dst").alias("node_id")).distinct()


def _inner_levels(
    go: SideGraph, gp: SideGraph, decay: float, depth: int, need_o: DataFrame | None = None, need_p: DataFrame | None = None
) -> DataFrame | None:
    """Non-equal positive pairs of level depth-1 (None when depth-1 < 2).

    With ``need_o`` or ``need_p``, the nodes of one side that the top level is asked
    for, each level is made only for the pairs that the level above reads: those of
    the needed nodes' neighbours, one step further for every level down."""
    if depth < 3:
        return None
    needs: list[tuple[DataFrame | None, DataFrame | None]] = []
    for _ in range(2, depth):  # from the top down
        need_o = cut_lineage(neighbours(go, need_o)) if need_o is not None else None
        need_p = cut_lineage(neighbours(gp, need_p)) if need_p is not None else None
        needs.append((need_o, need_p))
    prev = None
    for want_o, want_p in reversed(needs):
        prev = cut_lineage(_level(go, gp, prev, decay, restrict_o=want_o, restrict_p=want_p))
    return prev


# ---------------------------------------------------------------- row products


@dataclass
class Profiled:
    """A snapshot's values as numbers ``(*ctx, node_id, v)`` (not read with contexts) and its nodes' profiles ``(*ctx, node, d, vs, ns)``."""

    graph: SideGraph
    values: DataFrame
    rows: DataFrame


def _fits_products(go: SideGraph, gp: SideGraph, depth: int, best: bool) -> bool:
    """Whether the top levels are made by row products: without contexts level 3 and all pairs of level 2, with contexts the best of level 2."""
    kinds = [[g.vals.schema[c].dataType.simpleString() for c in g.ctx] for g in (go, gp)]
    known = kinds[0] == kinds[1] and go.ctx == gp.ctx and set(kinds[0]) <= {"int", "bigint", "string"}
    return known and (depth == 2 and best == bool(go.ctx) or depth == 3 and not go.ctx)


def _profiled(go: SideGraph, gp: SideGraph) -> tuple[DataFrame, Profiled, Profiled]:
    """The shared values' numbers, and both sides by them."""
    numbers = products.value_numbers(go.vals, gp.vals)

    def one(g: SideGraph) -> Profiled:
        if g.masks is not None:
            node_masks, adj_masks, parts = g.masks
            return Profiled(g, g.vals, products.shard_profiles(adj_masks, node_masks, numbers, parts))
        values = products.numbered(g.vals, numbers, g.ctx)
        return Profiled(g, values, products.profiles(g.adj, values, g.ctx))

    po, pp = in_parallel(lambda: one(go), lambda: one(gp))
    return numbers, po, pp


def _with_own(rows: DataFrame, side: Profiled, name: str = "own", node: str = "node", known: bool = True) -> DataFrame:
    """``rows`` with the number of their node's value; with ``known`` only nodes that have a row."""
    own = side.values.select(F.col("node_id").alias(node), F.col("v").alias(name))
    met = rows.join(own, node, "inner" if known else "left")
    return met.withColumn(name, F.coalesce(name, F.lit(products.UNKNOWN)))


def _next_profiles(side: Profiled, adj: DataFrame) -> DataFrame:
    """``(node, d, own, far, nd, nown, vs, ns)``: for each row of ``adj`` the profile of its far end, if that has a row."""
    far = _with_own(side.rows, side, "nown").select(F.col("node").alias("far"), F.col("d").alias("nd"), "nown", "vs", "ns")
    rows = adj.select(F.col("src").alias("node"), F.col("dst").alias("far"), F.col("sdeg").alias("d"))
    return _with_own(rows, side, known=False).join(far, "far")


def _next_lists(side: Profiled) -> DataFrame:
    """``(node, d, own, ys)``: neighbour lists in rows of about PROFILE_CHUNK ids."""
    chunk = F.pmod(F.hash("dst"), F.ceil(F.col("sdeg") / products.PROFILE_CHUNK)).alias("chunk")
    lists = side.graph.adj.select("src", "dst", "sdeg", chunk).groupBy(F.col("src").alias("node"), "chunk").agg(
        F.max("sdeg").alias("d"), F.collect_list("dst").alias("ys"))
    return stored(_with_own(lists.drop("chunk"), side, known=False), "neighbours")


def _pair_scores(go: SideGraph, gp: SideGraph, decay: float, depth: int) -> DataFrame:
    """``(a, b, score)`` of all pairs with a positive score and unequal values, at level 2 or 3."""
    _, po, pp = _profiled(go, gp)
    if depth == 2:
        return products.scores(_with_own(po.rows, po), _with_own(pp.rows, pp), [], decay)
    adj = go.adj.join(po.values.select(F.col("node_id").alias("src")), "src", "left_semi")
    return products.scores(
        _with_own(po.rows, po), _with_own(pp.rows, pp, known=False), [], decay, _next_profiles(po, adj), _next_lists(pp))


def _best_pairs(
    numbers: DataFrame, fixed: Profiled, free: Profiled, need: DataFrame, side: str, decay: float, depth: int, pairs_per_task: int | None
) -> DataFrame:
    """Pairs ``(*ctx, a, *ctx, b, score)`` among which is the best partner of every needed
    node ``(*ctx, node_id)`` of the fixed side (``side``); at most a few a node and block of the free side.

    Values of more than ``pairs_per_task`` pairs go by lists, as in :func:`_level`."""
    ctx = fixed.graph.ctx
    names, tags = (("a", "b"), ("_o", "_p")) if side == "o" else (("b", "a"), ("_p", "_o"))
    mine = fixed.rows.join(need.select(*ctx, F.col("node_id").alias("node")), [*ctx, "node"], "left_semi")
    theirs = free.rows
    if ctx:
        theirs = stored(products.alike_once(theirs, ctx), "profiles")
    held = lambda rows: rows.select(F.explode("vs").alias("v"))
    hot = hot_keys(held(mine), held(theirs), ["v"], pairs_per_task).join(numbers, "v")
    top = hot.orderBy(F.col("_pairs").desc(), "stored_value").select("v", "stored_value").limit(HOT_VALUES).collect()
    listed, hot_numbers = [r["stored_value"] for r in top], [r["v"] for r in top]
    if depth == 2:
        found = products.scores(mine, theirs, ctx, decay, names=names, best=True, hot=hot_numbers)
    else:
        adj = fixed.graph.adj.join(need.select(F.col("node_id").alias("src")), "src", "left_semi")
        found = products.scores(
            mine, _with_own(theirs, free, known=False), ctx, decay,
            _next_profiles(fixed, adj), _next_lists(free), names=names, best=True, hot=hot_numbers)
    ko, kp = [f"{c}_o" for c in ctx], [f"{c}_p" for c in ctx]
    for c in ctx:
        for name, tag in zip(names, tags):
            found = found.withColumnRenamed(f"{c}_{name}", f"{c}{tag}")
    if listed:
        def counts(rows: DataFrame, node: str, tag: str) -> DataFrame:
            flat = rows.select(*ctx, F.col("node").alias(node), F.col("d").alias(f"deg_{node}"), F.inline(F.arrays_zip(F.col("vs").alias("v"), F.col("ns").alias("n"))))
            flat = flat.join(F.broadcast(numbers.where(F.col("v").isin(hot_numbers))), "v")
            return _rename_ctx(flat.select(*ctx, node, "stored_value", F.col("n").cast("long").alias(f"n{tag}"), f"deg_{node}"), ctx, tag)

        vc = {tag: cut_lineage(counts(rows, node, tag)) for rows, node, tag in zip((mine, theirs), names, tags)}
        found = _hot_value_candidates(cut_lineage(found), vc["_o"], vc["_p"], listed, ko, kp, side)
    s = F.col("e").cast("double") + F.col("q")
    score = F.lit(float(decay)) * (s / (F.col("deg_a").cast("double") * F.col("deg_b")))
    return found.select(*ko, "a", *kp, "b", score.alias("score"))


def value_equal_pairs(go: SideGraph, gp: SideGraph) -> DataFrame:
    """Every (a, b) with equal values. Quadratic within a value group by
    definition (only the all-pairs report needs it); hot values are salted."""
    ko, kp = _pair_keys(go, gp)
    vo = _rename_ctx(go.vals, go.ctx, "_o").select(*ko, F.col("node_id").alias("a"), "stored_value")
    vp = _rename_ctx(gp.vals, gp.ctx, "_p").select(*kp, F.col("node_id").alias("b"), "stored_value")
    return salted_join(vo, vp, ["stored_value"], [*ko, "a"], [*kp, "b"]).select(
        *ko, "a", *kp, "b", F.lit(1.0).alias("score")
    )


def simrank_pairs(go: SideGraph, gp: SideGraph, decay: float = DEFAULT_DECAY, depth: int = DEFAULT_DEPTH) -> DataFrame:
    """All pairs with a positive depth-``depth`` score, ``(*ctx, a, *ctx, b, score)``."""
    if depth <= 0:
        return value_equal_pairs(go, gp).where(F.lit(False))
    equal = value_equal_pairs(go, gp)
    if depth == 1:
        return equal
    if _fits_products(go, gp, depth, best=False):
        return equal.unionByName(_pair_scores(go, gp, decay, depth))
    prev = _inner_levels(go, gp, decay, depth)
    return equal.unionByName(_level(go, gp, prev, decay))


def simrank(
    nodes_o: DataFrame,
    edges_o: DataFrame,
    nodes_p: DataFrame,
    edges_p: DataFrame,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
    directed: bool = False,
) -> DataFrame:
    """Whole-graph SimRank between two snapshots: ``(a, b, score)`` for every
    pair with a positive score (value-equal pairs score 1). With ``directed``
    the edges are the adjacency ``(src, dst)`` as given: a node's neighbours
    are its rows' ``dst``, and only nodes with a row of their own are compared."""
    go, gp = in_parallel(
        lambda: whole_graph(nodes_o, edges_o, directed=directed), lambda: whole_graph(nodes_p, edges_p, directed=directed)
    )
    return simrank_pairs(go, gp, decay, depth)


# ---------------------------------------------------------------- value matches


def label_match(go: SideGraph, gp: SideGraph) -> DataFrame:
    """J4 without pairs: per candidate node of each side, the number of
    value-equal candidates on the other side and the least of their ids.
    Value groups are counted first (partial aggregation), so a hot value
    costs one row per group, not its square."""

    def one_way(g: SideGraph, other: SideGraph, side: str) -> DataFrame:
        # stored, so that AQE may split the nodes of a hot value over tasks
        counts = cut_lineage(other.vals.groupBy("stored_value").agg(
            F.count(F.lit(1)).alias("n_equal"), F.min("node_id").alias("equal_id")
        ))
        nodes = g.vals.select("node_id", "stored_value").distinct()
        return nodes.join(counts, "stored_value", "left").select(
            F.lit(side).alias("side"),
            "node_id",
            F.coalesce("n_equal", F.lit(0)).alias("n_equal"),
            "equal_id",
        )

    return one_way(go, gp, ORIGINAL).unionByName(one_way(gp, go, PERTURBED))


def unmatched_nodes(go: SideGraph, gp: SideGraph) -> DataFrame:
    """P3 shortcut: nodes with no value-equal counterpart — exactly the nodes
    whose best score is below one (for depth >= 1)."""
    return label_match(go, gp).where(F.col("n_equal") == 0).select("side", "node_id")


# ---------------------------------------------------------------- best match


def _best_per_node(pairs: DataFrame, node: str, other: str, depth: int) -> DataFrame:
    """A4/A5: argmax per node, with a partial (map-side) step; ties go to the least id.

    At depth 2 scores are compared as they are: equal ratios are equal doubles,
    however small. Deeper scores are sums whose last bits depend on the order
    and are compared by their leading 40 bits."""
    key = F.col("score") if depth == 2 else score_key("score")
    best = pairs.groupBy(node).agg(
        F.max(F.struct(key.alias("s"), (-F.col(other)).alias("neg"))).alias("m")
    )
    return best.select(
        F.col(node).alias("node_id"), (-F.col("m.neg")).alias("match_id"), score_shown(F.col("m.s")).alias("score")
    )


def match_from_graphs(
    go: SideGraph,
    gp: SideGraph,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
    subjects_o: DataFrame | None = None,
    subjects_p: DataFrame | None = None,
    pairs_per_task: int | None = None,
) -> DataFrame:
    """Best counterpart of every subject node, both directions.

    ``subjects_*`` are ``(*ctx, node_id)``; by default all candidate nodes. Values with
    more than ``pairs_per_task`` pairs of nodes go by lists instead of by pairs.
    Returns ``matches(side, node_id, match_id, score)``; a node with no
    positive candidate gets ``score = 0.0`` and a NULL match."""
    subj_o = subjects_o if subjects_o is not None else go.vals.select(*go.ctx, "node_id")
    subj_p = subjects_p if subjects_p is not None else gp.vals.select(*gp.ctx, "node_id")
    subj_o_ids = subj_o.select("node_id").distinct()
    subj_p_ids = subj_p.select("node_id").distinct()

    if depth <= 0:
        zero = lambda ids, side: ids.select(
            F.lit(side).alias("side"), "node_id", F.lit(None).cast("long").alias("match_id"), F.lit(0.0).alias("score")
        )
        return zero(subj_o_ids, ORIGINAL).unionByName(zero(subj_p_ids, PERTURBED))

    # perfect matches: value-equal candidate anywhere on the other side
    equal = stored(label_match(go, gp), "equal")
    perfect = equal.where(F.col("n_equal") > 0).select(
        "side", "node_id", F.col("equal_id").alias("match_id"), F.lit(1.0).alias("score")
    )
    unmatched = equal.where(F.col("n_equal") == 0)
    un_o = subj_o.join(unmatched.where(F.col("side") == ORIGINAL).select("node_id"), "node_id", "left_semi")
    un_p = subj_p.join(unmatched.where(F.col("side") == PERTURBED).select("node_id"), "node_id", "left_semi")

    ko, kp = _pair_keys(go, gp)
    if depth >= 2:
        by_rows = _profiled(go, gp) if _fits_products(go, gp, depth, best=True) else None

        # unmatched nodes have no value-equal partner: no equal pair to drop
        def top(side: str) -> DataFrame:
            if by_rows is not None:
                numbers, *sides = by_rows
                fixed, free = sides if side == "o" else reversed(sides)
                return _best_pairs(numbers, fixed, free, un_o if side == "o" else un_p, side, decay, depth, pairs_per_task)
            need = {"need_o": un_o} if side == "o" else {"need_p": un_p}
            own = {"restrict_o": un_o} if side == "o" else {"restrict_p": un_p}
            prev = _inner_levels(go, gp, decay, depth, **need)
            return _level(go, gp, prev, decay, drop_equal=False, best_for=side, pairs_per_task=pairs_per_task, **own)

        top_o, top_p = in_parallel(lambda: top("o"), lambda: top("p"))
        best_o = _best_per_node(top_o.where(F.col("score") > 0), "a", "b", depth)
        best_p = _best_per_node(top_p.where(F.col("score") > 0), "b", "a", depth)
    else:
        empty = equal.select(
            F.col("node_id"), F.col("equal_id").alias("match_id"), F.lit(0.0).alias("score")
        ).where(F.lit(False))
        best_o, best_p = empty, empty

    def imperfect(ids: DataFrame, best: DataFrame, side: str) -> DataFrame:
        return ids.select("node_id").distinct().join(best, "node_id", "left").select(
            F.lit(side).alias("side"),
            "node_id",
            "match_id",
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )

    if subjects_o is not None or subjects_p is not None:
        # label_match covers every candidate node; keep only the subjects
        perfect = perfect.join(
            subj_o_ids.select(F.lit(ORIGINAL).alias("side"), "node_id").unionByName(
                subj_p_ids.select(F.lit(PERTURBED).alias("side"), "node_id")
            ),
            ["side", "node_id"],
            "left_semi",
        )
    return perfect.unionByName(imperfect(un_o, best_o, ORIGINAL)).unionByName(imperfect(un_p, best_p, PERTURBED))


def best_match(
    nodes_o: DataFrame,
    edges_o: DataFrame,
    nodes_p: DataFrame,
    edges_p: DataFrame,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
    drop_isolated: bool = True,
    pairs_per_task: int | None = None,
) -> DataFrame:
    """Whole-graph best match for every node of both snapshots (isolated ones
    only with ``drop_isolated=False``; they match by value alone)."""
    go, gp = in_parallel(
        lambda: whole_graph(nodes_o, edges_o, drop_isolated), lambda: whole_graph(nodes_p, edges_p, drop_isolated)
    )
    return match_from_graphs(go, gp, decay, depth, pairs_per_task=pairs_per_task)


def shard_graph(shard_nodes: DataFrame, shard_adj: DataFrame) -> tuple[SideGraph, DataFrame]:
    """Shards as a context-keyed graph plus its subject rows ``(part, node_id)``."""
    g = SideGraph(
        vals=stored(shard_nodes.select("part", "node_id", "stored_value"), "values"),
        adj=stored(with_degrees(shard_adj, ["part"]), "adjacency"),
        ctx=["part"],
    )
    subjects = shard_nodes.where(F.col("is_subject")).select("part", "node_id")
    return g, subjects


def mask_graph(node_masks: DataFrame, adj_masks: DataFrame, parts: int) -> tuple[SideGraph, DataFrame]:
    """:func:`shard_graph` from stored rows of bits; a row a part is made where it is read."""
    shard_nodes, shard_adj = shards_of(node_masks, adj_masks, parts)
    vals = shard_nodes.select("part", "node_id", "stored_value")
    subjects = shard_nodes.where(F.col("is_subject")).select("part", "node_id")
    return SideGraph(vals=vals, adj=shard_adj, ctx=["part"], masks=(node_masks, adj_masks, parts)), subjects


def sharded_match(
    shard_nodes_o: DataFrame,
    shard_adj_o: DataFrame,
    shard_nodes_p: DataFrame,
    shard_adj_p: DataFrame,
    decay: float = DEFAULT_DECAY,
    depth: int = DEFAULT_DEPTH,
) -> DataFrame:
    """The per-shard-pair definition. Within each pair (i, j) a subject
    of shard i is scored against every node of shard j using the shards'
    induced adjacencies; the best over all j wins (A5). The shard ids are
    join keys, so all k*k pairs run as one set of joins."""
    (go, subj_o), (gp, subj_p) = in_parallel(
        lambda: shard_graph(shard_nodes_o, shard_adj_o), lambda: shard_graph(shard_nodes_p, shard_adj_p)
    )
    return match_from_graphs(go, gp, decay, depth, subj_o, subj_p)


def mask_match(
    masks_o: tuple[DataFrame, DataFrame], masks_p: tuple[DataFrame, DataFrame], parts: int,
    decay: float = DEFAULT_DECAY, depth: int = DEFAULT_DEPTH,
) -> DataFrame:
    """:func:`sharded_match` of stored :func:`shard_masks`, at depth 2 without ever storing a row a part and edge."""
    if depth != 2:
        return sharded_match(*shards_of(*masks_o, parts), *shards_of(*masks_p, parts), decay, depth)
    (go, subj_o), (gp, subj_p) = mask_graph(*masks_o, parts), mask_graph(*masks_p, parts)
    return match_from_graphs(go, gp, decay, depth, subj_o, subj_p)
