"""Graph operators on normalized rows.

``nodes`` is ``(node_id, stored_value)``, ``edges`` / ``adj`` is ``(src, dst)``.
Nothing here builds a per-node list except the optional chunked sink form of
:func:`out_adjacency`; every step is a join or an aggregate that Spark
partitions by key.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.session import cut_lineage, stored

# Neighbour lists written to sinks are cut into chunks of at most this many
# ids, so a hub never becomes one unbounded row.
LIST_CHUNK = 1024

# Parts that one bit column holds; all are positive longs.
MASK_BITS = 62

# So many edges at most, whatever the input, are left to one task when components are found.
REST_EDGES = 1 << 16

# Bits of monotonically_increasing_id() that hold the row position.
_POS_BITS = 33


def out_adjacency(nodes: DataFrame, edges: DataFrame, as_lists: bool = False) -> DataFrame:
    """Every node with its outgoing neighbours; ``dst`` is NULL for a node
    without out-edges. ``as_lists=True`` gives A1's list form as sorted chunks
    ``(node_id, chunk, neighbors)`` of at most ``LIST_CHUNK`` ids."""
    rows = nodes.select("node_id").join(
        edges.select(F.col("src").alias("node_id"), "dst"), "node_id", "left"
    )
    if not as_lists:
        return rows
    return chunked_lists(rows, "node_id", "dst")


def chunked_lists(rows: DataFrame, key: str | list[str], item: str) -> DataFrame:
    """Collect ``item`` per key into sorted lists of about LIST_CHUNK entries.

    A key with d items is cut into ceil(d / LIST_CHUNK) chunks by hashing the
    item, so a hub's list is spread over many groups (and tasks) instead of
    being numbered by one window in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    sizes = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")))
    n_chunks = F.greatest(F.ceil(F.col("_d") / F.lit(LIST_CHUNK)), F.lit(1))
    chunked = rows.join(sizes, keys).withColumn(
        "chunk", F.pmod(F.xxhash64(item), n_chunks.cast("long")).cast("int")
    )
    # dealt anew by chunk: left on the join's keys, the lists would keep a hub in one task
    return chunked.repartition(*keys, "chunk").groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(item)).alias("neighbors"))


def undirected(edges: DataFrame) -> DataFrame:
    """Symmetric, duplicate-free adjacency. A self-loop stays once."""
    e = edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    # dealt out with the lesser end first, so one row an edge, then both directions of each
    once = e.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()
    way = lambda a, b: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"))
    ways = F.when(F.col("u") == F.col("v"), F.array(way("u", "v"))).otherwise(F.array(way("u", "v"), way("v", "u")))
    return once.select(F.inline(ways))


def isolated_nodes(nodes: DataFrame, adj: DataFrame) -> DataFrame:
    """Nodes that no edge touches (they vanish from the undirected view)."""
    return nodes.select("node_id").join(adj.select(F.col("src").alias("node_id")), "node_id", "left_anti")


def active_nodes(nodes: DataFrame, adj: DataFrame) -> DataFrame:
    """Nodes (with values) that have at least one undirected neighbour."""
    return nodes.join(adj.select(F.col("src").alias("node_id")), "node_id", "left_semi")


def degrees(adj: DataFrame) -> DataFrame:
    """A2: neighbour counts, the SimRank denominators."""
    return adj.groupBy(F.col("src").alias("node_id")).agg(F.count(F.lit(1)).alias("degree"))


# ---------------------------------------------------------------- components


def _round_table(df: DataFrame) -> DataFrame:
    """A round's result as a written table. A checkpoint keeps the size that Spark estimates from the
    plan, a product over its joins: carried from round to round it is about cubed each time
    (138,295 bits after a path of 60 nodes), and planning takes minutes. A table's size is that of its files."""
    return stored(df, "components")


def _edges_once(pairs: DataFrame) -> DataFrame:
    """Each edge once, its lesser end first; loops drop out."""
    once = pairs.where(F.col("u") != F.col("v"))
    return once.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``old, new``: each end of the edges and the least end it is connected to."""
    up: dict = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for u, v in zip(*(c.to_pylist() for c in batch.columns)):
            u, v = top(u), top(v)
            up[max(u, v)] = min(u, v)
    if kind is not None:
        old = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(old, kind), pa.array([top(x) for x in old], kind)], names=["old", "new"])


def connected_components(
    adj: DataFrame, cut: Callable[[DataFrame], DataFrame] = _round_table, symmetric: bool = False, rest: int = REST_EDGES
) -> DataFrame:
    """G2 (first half): ``(node_id, component)`` with component = least node id.
    ``cut`` stores what a round has made. ``symmetric`` tells that ``adj`` has every edge in
    both directions, as :func:`undirected` gives it, so that nothing is dealt out to find this.

    Rounds of contraction until at most ``rest`` edges are left, a fixed number
    whatever the input, whose ends one task joins. In each round every vertex
    takes the closed neighbour that comes first in that round's pseudo-random
    order, then that one's choice, edges are rewritten to these choices, and loops and copies of edges
    drop out. In every second round a vertex with one neighbour takes that one,
    whatever the order: a star's leaves would halve only while its centre ranks
    after some of them. An edge is stored once, its lesser end first. The edge
    between a vertex and its choice is rewritten too, so nothing falls apart;
    over half of a path's vertices and far more of a dense graph's go in a
    round, so the rounds grow with log n. There is no round limit.

    A hub costs one partial aggregate row a task when choices are made. The
    rewriting joins read a stored choice table on one side and stored edges on
    the other, so that AQE can split a hub's edges over tasks. Every round is
    written to the shared folder, so executor loss replays one round.
    """
    pairs = adj.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    both = pairs if symmetric else pairs.union(pairs.select("v", "u"))
    edges = cut(pairs.where(F.col("u") < F.col("v")) if symmetric else _edges_once(pairs))
    # the first round goes by id, which folds stars around small ids at once, and names every node
    first = both.where(F.col("u").isNotNull()).groupBy("u").agg(F.min("v").alias("v"))
    choice = _two_hops(cut(first.select(F.col("u").alias("old"), F.least("u", "v").alias("new"))), cut)
    label = choice.select(F.col("old").alias("node_id"), F.col("new").alias("root"))
    turn = 0
    while True:
        ends = edges.join(choice, F.col("u") == F.col("old")).select(F.col("new").alias("u"), "v")
        ends = ends.join(choice, F.col("v") == F.col("old")).select("u", F.col("new").alias("v"))
        edges = cut(_edges_once(ends))
        turn += 1
        left = edges.count()
        if left == 0:
            break
        if left <= rest:
            kind = edges.schema["u"].dataType.simpleString()
            label = _relabelled(label, cut(edges.coalesce(1).mapInArrow(_roots, f"old {kind}, new {kind}")))
            break
        # the hash of a long is one to one, so no two ends rank alike; plain numbers go through a hash aggregate
        rank = lambda c: F.xxhash64(c, F.lit(turn))
        both = edges.union(edges.select("v", "u"))
        first = both.groupBy("u").agg(F.min(rank("v")).alias("h"), F.min_by("v", rank("v")).alias("v"), F.count(F.lit(1)).alias("n"))
        moves = (F.col("h") < rank("u")) | (F.col("n") == 1 if turn % 2 else F.lit(False))
        choice = cut(first.select(F.col("u").alias("old"), F.when(moves, F.col("v")).otherwise(F.col("u")).alias("new")))
        choice = _two_hops(choice, cut)
        label = _relabelled(label, choice)
        if turn % 4 == 0:
            label = cut(label)
    label = cut(label)
    least = cut(label.groupBy("root").agg(F.min("node_id").alias("component")))
    return label.join(least, "root").select("node_id", "component")


def _two_hops(choice: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each vertex's choice replaced by that one's choice."""
    then = choice.select(F.col("old").alias("via"), F.col("new").alias("end"))
    return cut(choice.join(then, F.col("new") == F.col("via")).select("old", F.col("end").alias("new")))


def _relabelled(label: DataFrame, choice: DataFrame) -> DataFrame:
    return label.join(choice, F.col("root") == F.col("old"), "left").select("node_id", F.coalesce("new", "root").alias("root"))


# ---------------------------------------------------------------- partitioning


def global_row_number(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """1-based row number in ``order_cols`` order within ``group_cols`` (plus
    the group's row count ``group_size``), without a single-partition window.

    Range-partition and sort, read each row's position from
    ``monotonically_increasing_id`` (partition index in the high bits), then
    add per-(partition, group) offsets from a table whose size is bounded by
    the number of partitions times the number of groups.
    """
    group_cols = list(group_cols or [])
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = (
        df.repartitionByRange(n_parts, *group_cols, *order_cols)
        .sortWithinPartitions(*group_cols, *order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
    )
    keyed = stored(keyed, "ranked")  # pin positions: a replay must see the same ids
    counts = keyed.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", *group_cols, "_first",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*group_cols)).alias("group_size"),
    )
    # without groups a row a partition; with groups their number decides, so the planner does
    offsets = offsets if group_cols else F.broadcast(offsets)
    ranked = keyed.join(offsets, ["_pid", *group_cols])
    return ranked.withColumn("row_number", F.col("_off") + F.col("_pos") - F.col("_first") + 1).drop(
        "_mid", "_pid", "_pos", "_first", "_off"
    )


def ntile_expr(rn: str, n: str, k: int) -> F.Column:
    """0-based ``ntile(k)`` bucket of 1-based row ``rn`` among ``n`` rows:
    the first ``n mod k`` buckets hold one row more than the others."""
    big = f"pmod({n}, {k}) * ({n} div {k} + 1)"
    return F.expr(
        f"CASE WHEN {rn} <= {big} THEN ({rn} - 1) div ({n} div {k} + 1) "
        f"ELSE pmod({n}, {k}) + ({rn} - 1 - {big}) div ({n} div {k}) END"
    ).cast("int")


def partition_nodes(adj: DataFrame, k: int = 3, components: DataFrame | None = None, symmetric: bool = False) -> DataFrame:
    """K disjoint, balanced covers of the non-isolated nodes, keeping
    connected nodes together: ``ntile(k)`` over (component, node_id), sizes
    differ by at most one; fewer parts when there are fewer than k nodes.
    Returns ``(part, node_id)`` with part in 0..k-1."""
    # stored, as dealing out by range reads it twice, the first time for the bounds
    comps = components if components is not None else stored(connected_components(adj, symmetric=symmetric), "components")
    ranked = global_row_number(comps, ["component", "node_id"])
    return ranked.select(ntile_expr("row_number", "group_size", k).alias("part"), "node_id")


# ---------------------------------------------------------------- shards


def _words(parts: int) -> list[str]:
    """Columns of a set of parts as bits, MASK_BITS parts each."""
    return [f"w{i}" for i in range(-(-parts // MASK_BITS))]


def part_masks(seeds: DataFrame, parts: int) -> DataFrame:
    """``(node_id, w0, w1, ...)``: each node's parts (of 0 .. parts - 1) as bits, one row a node."""
    bit = F.expr(f"shiftleft(1L, cast(pmod(part, {MASK_BITS}) as int))")
    in_word = F.floor(F.col("part") / MASK_BITS)
    return seeds.groupBy("node_id").agg(
        *[F.bit_or(F.when(in_word == i, bit).otherwise(F.lit(0).cast("long"))).alias(w) for i, w in enumerate(_words(parts))]
    )


def khop_masks(adj: DataFrame, masks: DataFrame, hops: int = 2) -> DataFrame:
    """G3/U2 on bits: every node within ``hops`` of a part's nodes gets the part's bit.

    One row a node, whatever the number of parts. Each hop sends along the edges
    only the bits that are new since the last one, and ``bit_or`` folds them
    before the shuffle."""
    words = [c for c in masks.columns if c != "node_id"]
    some = lambda cols: functools.reduce(lambda x, y: x | y, [F.col(c) != 0 for c in cols])
    reached = stored(masks.select("node_id", *words), "reached")
    fresh = reached
    for _ in range(hops):
        step = (
            fresh.where(some(words))
            .join(adj.select(F.col("src").alias("node_id"), "dst"), "node_id")
            .groupBy(F.col("dst").alias("node_id"))
            .agg(*[F.bit_or(w).alias(f"n{w}") for w in words])
        )
        zero = F.lit(0).cast("long")
        both = reached.select("node_id", *words, *[zero.alias(f"n{w}") for w in words]).unionByName(
            step.select("node_id", *[zero.alias(w) for w in words], *[f"n{w}" for w in words]))
        both = both.groupBy("node_id").agg(*[F.bit_or(c).alias(c) for w in words for c in (w, f"n{w}")])
        both = stored(both, "reached")
        reached = both.select("node_id", *[F.col(w).bitwiseOR(F.col(f"n{w}")).alias(w) for w in words])
        fresh = both.select("node_id", *[F.col(f"n{w}").bitwiseAND(F.bitwise_not(F.col(w))).alias(w) for w in words])
    return reached


def mask_parts(masks: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows with bit columns -> a row for each part whose bit is set, the bits replaced by ``part``.
    With ``parts``, their number, only so many bits of a row are looked at."""
    words = [c for c in masks.columns if re.fullmatch(r"w\d+", c)]
    parts = parts or len(words) * MASK_BITS
    bits = "filter(sequence(0, {last}), i -> (shiftright({w}, i) & 1L) = 1L)"
    lists = ", ".join(
        f"transform({bits.format(w=w, last=min(parts - k * MASK_BITS, MASK_BITS) - 1)}, i -> i + {k * MASK_BITS})"
        for k, w in enumerate(words)
    )
    return masks.select(*[c for c in masks.columns if c not in words], F.explode(F.expr(f"concat({lists})")).alias("part"))


def khop(adj: DataFrame, seeds: DataFrame, hops: int = 2, parts: int | None = None) -> DataFrame:
    """Exact breadth-first search. ``seeds`` is ``(part, node_id)`` with part in
    0 .. parts - 1; returns every node within ``hops`` undirected hops of a seed
    of the same part, as :func:`khop_masks` finds them."""
    parts = parts or _count_parts(seeds)
    return mask_parts(khop_masks(adj, part_masks(seeds, parts), hops), parts).select("part", "node_id")


def induced_masks(adj: DataFrame, masks: DataFrame) -> DataFrame:
    """``(src, dst, w0, ...)``: the parts in which both ends of an edge lie, as bits. The
    adjacency is read once, a row an edge, whatever the number of parts."""
    words = [c for c in masks.columns if c != "node_id"]
    ends = {end: masks.select(F.col("node_id").alias(end), *[F.col(w).alias(f"{end}_{w}") for w in words]) for end in ("src", "dst")}
    met = adj.select("src", "dst").join(ends["src"], "src").join(ends["dst"], "dst")
    met = met.select("src", "dst", *[F.col(f"src_{w}").bitwiseAND(F.col(f"dst_{w}")).alias(w) for w in words])
    return met.where(functools.reduce(lambda x, y: x | y, [F.col(w) != 0 for w in words]))


def induced(adj: DataFrame, members: DataFrame, parts: int | None = None) -> DataFrame:
    """Per part, the edges with both ends among the part's members ``(part, node_id)``."""
    parts = parts or _count_parts(members)
    return mask_parts(induced_masks(adj, part_masks(members, parts)), parts).select("part", "src", "dst")


def _count_parts(rows: DataFrame) -> int:
    return 1 + (rows.agg(F.max("part")).first()[0] or 0)


def looked_up(rows: DataFrame, nodes: DataFrame, strict: bool = False) -> DataFrame:
    """``rows`` (with ``node_id``) and the node's ``stored_value``.

    A node that the node table does not have gets NULL, or with ``strict`` fails
    the query, naming the node; a node whose value is NULL is known and does not."""
    known = nodes.select("node_id", "stored_value", F.lit(True).alias("_known"))
    met = rows.join(known, "node_id", "left")
    if not strict:
        return met.drop("_known")
    fail = F.raise_error(F.concat(F.lit("no value is stored for node "), F.coalesce(F.col("node_id").cast("string"), F.lit("NULL"))))
    value = F.when(F.col("_known").isNull(), fail.cast("string")).otherwise(F.col("stored_value"))
    return met.withColumn("stored_value", value).drop("_known")


def shard_masks(
    nodes: DataFrame, edges: DataFrame, k: int = 3, hops: int = 2, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """G5 on bits: ``(node_id, w0, ..., own, stored_value)``, the parts whose shards hold a node, the one
    whose subject it is and its value, and ``(src, dst, w0, ...)``, the induced adjacency: a row a
    node or edge whatever the number of parts. Values are looked up by an equi-join (J2/P8)."""
    adj = stored(undirected(edges), "adjacency")  # read by components, k-hop and induced
    subjects = cut_lineage(partition_nodes(adj, k, symmetric=True))
    members = khop_masks(adj, part_masks(subjects, k), hops)
    # a node is the subject of one part: its values are looked up a row a node, before the parts
    own = members.join(subjects.select("node_id", F.col("part").alias("own")), "node_id", "left")
    return looked_up(own, nodes, strict), induced_masks(adj, members)


def shards_of(node_masks: DataFrame, adj_masks: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`build_shards` from those of :func:`shard_masks`."""
    shard_nodes = mask_parts(node_masks, k).select(
        F.col("part").cast("int").alias("part"),
        "node_id",
        "stored_value",
        F.coalesce(F.col("part") == F.col("own"), F.lit(False)).alias("is_subject"),
    )
    return shard_nodes, mask_parts(adj_masks, k).select("part", "src", "dst")


def build_shards(
    nodes: DataFrame, edges: DataFrame, k: int = 3, hops: int = 2, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Shards as normalized rows. With ``strict`` an edge to an unknown node fails (:func:`looked_up`).

    ``shard_nodes(part, node_id, stored_value, is_subject)`` — subjects of the
    part plus its ``hops``-hop halo; ``shard_adj(part, src, dst)`` — the
    induced adjacency."""
    return shards_of(*shard_masks(nodes, edges, k, hops, strict), k)


def shard_pairs(shard_nodes_o: DataFrame, shard_nodes_p: DataFrame) -> DataFrame:
    """J3, pruned: the (i, j) shard pairs that share at least one stored
    value, i.e. the pairs that can yield a positive similarity. Built from an
    equi-join on value over distinct (part, value) rows, so a hot value
    contributes at most k*k rows."""
    vo = shard_nodes_o.select(F.col("part").alias("i"), "stored_value").distinct()
    vp = shard_nodes_p.select(F.col("part").alias("j"), "stored_value").distinct()
    return vo.join(vp, "stored_value").select("i", "j").distinct()
