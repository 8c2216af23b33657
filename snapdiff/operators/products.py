"""Scores of node pairs row by row, without a stored or shuffled table of pairs.

A node's *profile* lists the values that both snapshots have among its neighbours, as numbers, each
with its count. The level-2 sum of a pair is the product of two profiles, and a level-3 sum adds up
such products over the neighbours of both. Tables of these products are quadratic in a value's
nodes. Here only profiles travel: the free side (b) is dealt into blocks of bounded size, the
fixed side (a) into bands, and each (band, block) cell is one task's stream, first the block, then
the band's nodes one after the other. A task holds the block and the products of a few nodes, and
hands on a node's scores (or its best partner) before it takes the next, so disk and shuffle grow with
the profiles times the blocks, never with the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.operators.graph import global_row_number, mask_parts
from snapdiff.session import stored

# Counts of values in one row at most, so that a hub's profile is many rows.
PROFILE_CHUNK = 256
# Entries of a block: those of its nodes' own lists, and of all profiles that it reads at depth 3.
BLOCK, WIDE_BLOCK = 1 << 22, 1 << 23
# Products made at once, unless one node has more; rows of a batch handed on.
PRODUCTS, BATCH = 1 << 20, 1 << 16
# Kinds of dealt rows, blocks before bands: a free node's profile, its neighbours, a fixed node's profile, one of its neighbours'.
FREE, FREE_NEXT, FIXED, FIXED_NEXT = range(4)
# Instead of a value's number: a value that the other side lacks (or NULL), and a node without a row.
ALONE, UNKNOWN = -1, -2


# ---------------------------------------------------------------- profiles


def value_numbers(vals_o: DataFrame, vals_p: DataFrame) -> DataFrame:
    """``(stored_value, v)``: the values of both sides, numbered."""
    both = vals_o.select("stored_value").distinct().join(vals_p.select("stored_value").distinct(), "stored_value")
    both = stored(both, "values")
    kind = "int" if both.count() < 1 << 31 else "long"
    return stored(global_row_number(both, ["stored_value"]).select("stored_value", F.col("row_number").cast(kind).alias("v")), "values")


def numbered(vals: DataFrame, numbers: DataFrame, ctx: list[str]) -> DataFrame:
    """``(*ctx, node_id, v)``: each node's value as a number, ALONE without one."""
    met = vals.select(*ctx, "node_id", "stored_value").join(numbers, "stored_value", "left")
    return stored(met.select(*ctx, "node_id", F.coalesce("v", F.lit(ALONE)).cast(numbers.schema["v"].dataType).alias("v")), "values")


def profiles(adj: DataFrame, values: DataFrame, ctx: list[str]) -> DataFrame:
    """``(*ctx, node, d, vs, ns)``: how many neighbours hold each shared value, in rows of about
    PROFILE_CHUNK values, and the neighbour count. Dealt out by node once: both aggregates find their rows there."""
    held = values.where(F.col("v") >= 0).withColumnRenamed("node_id", "dst")
    rows = adj.where(F.col("src").isNotNull()).select(*ctx, "src", "dst", "sdeg").join(held, [*ctx, "dst"]).select(*ctx, "src", "v", "sdeg").repartition(*ctx, "src")
    return _listed(rows.groupBy(*ctx, "src", "v").agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("sdeg").alias("d")), ctx)


def _listed(counts: DataFrame, ctx: list[str]) -> DataFrame:
    chunk = F.pmod(F.hash("v"), F.ceil(F.col("d") / PROFILE_CHUNK)).alias("chunk")
    lists = counts.select("*", chunk).groupBy(*ctx, F.col("src").alias("node"), "chunk").agg(
        F.max("d").alias("d"), F.sort_array(F.collect_list(F.struct("v", "n"))).alias("l"))
    return stored(lists.select(*ctx, "node", "d", F.col("l.v").alias("vs"), F.col("l.n").alias("ns")), "profiles")


def shard_profiles(adj_masks: DataFrame, node_masks: DataFrame, numbers: DataFrame, parts: int) -> DataFrame:
    """:func:`profiles` by part, from a row a node and a row an edge: a node's value is the same in
    all parts, so edges meet values and are dealt out by node before they become a row a part."""
    values = node_masks.select(F.col("node_id").alias("dst"), "stored_value").join(numbers, "stored_value")
    values = stored(values.groupBy("dst").agg(F.collect_list("v").alias("held")), "values")  # a repeated node counts as often
    words = [c for c in adj_masks.columns if c not in ("src", "dst")]
    rows = adj_masks.join(values, "dst", "left").select("src", "held", *words).repartition("src")
    rows = mask_parts(rows, parts).withColumn("d", F.count(F.lit(1)).over(Window.partitionBy("part", "src")))
    rows = rows.select("part", "src", "d", F.explode("held").alias("v"))
    return _listed(rows.groupBy("part", "src", "v").agg(F.count(F.lit(1)).cast("int").alias("n"), F.max("d").alias("d")), ["part"])


def alike_once(rows: DataFrame, ctx: list[str]) -> DataFrame:
    """Of a node that has the same profile in several contexts only one of them, as a best partner
    is one in any. Hubs of several rows stay as they are."""
    small = rows.where(F.col("d") <= PROFILE_CHUNK).groupBy("node", "d", "vs", "ns").agg(F.min(F.struct(*ctx)).alias("c"))
    return rows.where(F.col("d") > PROFILE_CHUNK).unionByName(small.select("c.*", "node", "d", "vs", "ns"))


def _entries(rows: DataFrame, column: str = "vs") -> tuple[int, int]:
    got = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size(column).cast("long")).alias("n")).first()
    return got["rows"], got["n"] or 0


# ---------------------------------------------------------------- dealing


def _bands(free: DataFrame, blocks: int, rows: int) -> int:
    """Number of bands: a cell for every core, as each band reads all blocks."""
    cores = free.sparkSession.sparkContext.defaultParallelism
    return max(1, min(rows, math.ceil(cores / blocks)))


def _rows(df: DataFrame, kind: int, ctx: list[str], cells: F.Column, whole: str) -> DataFrame:
    """Rows as they are dealt, one for each cell; the columns that a kind lacks are NULL."""
    have = set(df.columns)
    col = lambda c, t: (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
    return df.select(
        F.explode(cells).alias("cell"), F.lit(kind).cast("int").alias("kind"), *ctx, F.col("node"), col("d", "double"), col("own", whole),
        col("nd", "double"), col("nown", whole), col("far", "bigint"), col("vs", f"array<{whole}>"), col("ns", "array<int>"), col("ys", "array<bigint>"))


def _deal(parts: list[tuple[DataFrame, int, F.Column]], ctx: list[str], cells: int, whole: str) -> DataFrame:
    """All kinds of rows, each cell in a partition of its own, blocks first, then by node."""
    out = None
    for df, kind, to in parts:
        rows = _rows(df, kind, ctx, to, whole)
        out = rows if out is None else out.unionByName(rows)
    out = out.withColumn("band", F.col("kind") >= FIXED).repartitionById(cells, F.col("cell").cast("int"))
    return out.sortWithinPartitions("cell", "band", "node", *ctx, "far")


def _cells_of(node: str, mine: int, others: int, fixed: bool) -> F.Column:
    """The cells of a node's row: a fixed node's band in every block, a free node's block in every band."""
    own = F.pmod(F.xxhash64(node), F.lit(mine))
    each = F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))
    if fixed:
        return F.transform(each, lambda j: own * others + j)
    return F.transform(each, lambda i: i * mine + own)


# ---------------------------------------------------------------- products


class _Lists:
    """Items with weights, found by key."""

    def __init__(self, keys: np.ndarray, items: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        self.items, self.weights = items[order].astype(np.int32, copy=False), weights[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.ends = keys[first], np.r_[first, len(keys)]

    def spans(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        start = self.ends[at]
        return start, np.where(self.keys[at] == keys, self.ends[at + 1] - start, 0)


def _spread(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which span, and the place, of every item in the spans."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) + np.repeat(start - (np.cumsum(n) - n), n)


def _sums(keys: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key of 0 .. size - 1 with a positive sum of weights, ascending."""
    if size <= 8 * len(keys):
        total = np.bincount(keys, weights, size)
        found = np.flatnonzero(total)
        return found, total[found]
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(weights, first) if len(keys) else np.zeros(0)
    some = total > 0
    return keys[first][some], total[some]


def _counts(keys: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_sums` for whole weights, mostly 1: sorted without their places where that is shorter."""
    many = weights.astype(np.int64)
    if size <= 8 * len(keys) or many.sum() > 2 * len(keys):
        return _sums(keys, weights, size)
    keys = np.sort(np.repeat(keys, many).astype(np.int32 if size < 1 << 31 else np.int64))
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first].astype(np.int64), np.diff(np.r_[first, len(keys)]).astype(np.float64)


def _together(sums: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of parts added up."""
    if len(sums) < 2:
        return sums[0] if sums else (np.zeros(0, np.int64), np.zeros(0))
    total = np.zeros(size)
    for k, w in sums:
        total[k] += w
    found = np.flatnonzero(total)
    return found, total[found]


def _products(
    lists: _Lists, keys: np.ndarray, weights: np.ndarray, size: int, limit: int, keep: Callable | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Sums over one row's entries of weight times the weights of the entry's list, about ``limit`` products at a time."""
    start, n = lists.spans(keys)
    sums, ends = [], np.cumsum(n)
    lo = 0
    while lo < len(keys):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        which, at = _spread(start[lo:hi], n[lo:hi])
        items, w = lists.items[at], weights[lo:hi][which] * lists.weights[at]
        if keep is not None:
            good = keep(items, which + lo)
            items, w = items[good], w[good]
        sums.append(_sums(items, w, size))
        lo = hi
    return _together(sums, size)


def _next_scores(
    block: _Block, xs: np.ndarray, v: np.ndarray, n: np.ndarray, dx: np.ndarray, own: np.ndarray, decay: float, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(y, g)``: the level-2 scores of every y with a row's neighbours ``xs`` (0, 1, ...; an entry each, ascending) added up.
    Neighbours of equal values are left out, they are counted in E; so are nodes without a row."""
    start, many = block.every.spans(v)
    ends, entry_ends = np.cumsum(np.bincount(xs, many, len(dx)).astype(np.int64)), np.searchsorted(xs, np.arange(len(dx)), "right")
    sums, lo = [], 0
    while lo < len(dx):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        e0, e1 = entry_ends[lo - 1] if lo else 0, entry_ends[hi - 1]
        which, at = _spread(start[e0:e1], many[e0:e1])
        which += e0
        keys = (xs[which] - lo) * block.size + block.every.items[at]
        keys, e = _counts(keys, n[which] * block.every.weights[at], (hi - lo) * block.size)
        x, y = keys // block.size + lo, keys % block.size
        theirs = block.own[y]
        apart = (theirs != UNKNOWN) & ((own[x] < 0) | (theirs != own[x]))
        x, y, e = x[apart], y[apart], e[apart]
        sums.append(_sums(y, decay * (e / (dx[x] * block.d[y])), block.size))
        lo = hi
    return _together(sums, block.size)


def score_keys(x: np.ndarray) -> np.ndarray:
    """:func:`snapdiff.functions.exprs.score_key` on an array."""
    high = x * float(2**13 + 1)
    return high - (high - x)


# ---------------------------------------------------------------- streams


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """True where a row differs from the one before in the named columns, and for the first."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in names:
        col = table.column(name).combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], col.type)
        if not pa.types.is_integer(col.type):
            col = col.dictionary_encode().indices
        x = col.fill_null(0).to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    return new


def _flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of a list column's lists, and all their items."""
    col = table.column(name).combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = col.chunk(0)
    sizes = col.value_lengths().to_numpy(zero_copy_only=False)
    return np.nan_to_num(sizes).astype(np.int64), col.flatten().to_numpy(zero_copy_only=False)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


class _Block:
    """A block of free nodes, ascending by id."""

    def __init__(self, table: pa.Table, ctx: list[str], hot: np.ndarray, deep: bool):
        new = _changes(table, ["node", *ctx])
        at = (np.cumsum(new) - 1).astype(np.int32)
        self.first = np.flatnonzero(new)
        self.ctx = [table.column(c).take(pa.array(self.first)) for c in ctx]
        self.nodes = _numbers(table, "node")[self.first]
        self.d, self.size = _numbers(table, "d")[self.first], len(self.first)
        self.own = _numbers(table, "own")[self.first] if table.column("own").null_count == 0 else None
        sizes, vs = _flat(table, "vs")
        _, ns = _flat(table, "ns")
        items, ns = np.repeat(at, sizes), ns.astype(np.float64)
        is_hot = np.isin(vs, hot) if len(hot) else np.zeros(len(vs), bool)
        # hot values go by node too: they are looked at for pairs that were met elsewhere
        self.hot = _Lists(items[is_hot], vs[is_hot], ns[is_hot]) if len(hot) else None
        if not deep:
            self.cold = _Lists(vs[~is_hot], items[~is_hot], ns[~is_hot])
            return
        self.every = _Lists(vs, items, ns)
        kinds = _numbers(table, "kind")
        near = table.filter(pa.array(kinds == FREE_NEXT))
        sizes, ys = _flat(near, "ys")
        b = np.repeat(at[kinds == FREE_NEXT], sizes)
        y = np.searchsorted(self.nodes, ys)
        y[y == self.size] = 0
        there = self.nodes[y] == ys  # the others have no value to meet
        b, y = b[there], y[there]
        self.asked = np.zeros(self.size, bool)
        self.asked[at[kinds == FREE_NEXT]] = True
        one = np.ones(len(b), np.float32)
        self.to_b, self.to_y = _Lists(y, b, one), _Lists(b, y, one)


def _streams(batches: Iterator[pa.RecordBatch], ctx: list[str], hot: np.ndarray, deep: bool):
    """``(block, table)``: the block of a cell with its band's rows, whole nodes at a time."""
    cell = block = None
    pending: list[pa.Table] = []  # a block's rows
    held: list[pa.Table] = []  # the rows of a node that may go on
    key = None
    for batch in batches:
        whole = pa.Table.from_batches([batch])
        cells, bands = _numbers(whole, "cell"), _numbers(whole, "kind") >= FIXED
        cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (bands[1:] != bands[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(cells)]):
            if lo == hi:
                continue
            part = whole.slice(lo, hi - lo)
            if cells[lo] != cell:
                if held and block is not None:
                    yield block, pa.concat_tables(held)
                cell, block, pending, held, key = cells[lo], None, [], [], None
            if not bands[lo]:
                pending.append(part)
                continue
            if block is None:
                if not pending:
                    continue  # nothing to meet
                block, pending = _Block(pa.concat_tables(pending), ctx, hot, deep), []
            new = _changes(part, ["node", *ctx])
            ident = lambda i: tuple(part.column(c)[i].as_py() for c in ("node", *ctx))  # noqa: B023, E731
            if held and ident(0) != key:
                yield block, pa.concat_tables(held)
                held = []
            last = int(np.flatnonzero(new)[-1])
            if last > 0:
                yield block, pa.concat_tables([*held, part.slice(0, last)])
                held = []
            held.append(part.slice(last))
            key = ident(part.num_rows - 1)
    if held and block is not None:
        yield block, pa.concat_tables(held)


class _Out:
    """Collects columns and hands them on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.parts, self.rows = schema, [], 0

    def add(self, columns: list) -> Iterator[pa.RecordBatch]:
        n = len(columns[0])
        if not n:
            return
        cast = [c if isinstance(c, pa.Array | pa.ChunkedArray) else pa.array(c) for c in columns]
        self.parts.append(pa.table([c.cast(f.type) for c, f in zip(cast, self.schema)], schema=self.schema))
        self.rows += n
        if self.rows >= BATCH:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            yield from pa.concat_tables(self.parts).to_batches(max_chunksize=BATCH)
        self.parts, self.rows = [], 0


def _unequal(block: _Block, b: np.ndarray, own: np.ndarray) -> np.ndarray:
    return (own < 0) | (block.own[b] != own)


def _shallow(block: _Block, table: pa.Table, ctx: list[str], decay: float, hot: np.ndarray, best: bool, limit: int):
    """Level 2 for whole nodes: columns of pairs, or of each node's best pair."""
    new = _changes(table, ["node", *ctx])
    first = np.flatnonzero(new)
    at = np.cumsum(new) - 1
    nodes, d = _numbers(table, "node")[first], _numbers(table, "d")[first]
    own = None if best else _numbers(table, "own")[first]
    sizes, vs = _flat(table, "vs")
    _, ns = _flat(table, "ns")
    a, ns = np.repeat(at, sizes), ns.astype(np.float64)
    is_hot = np.isin(vs, hot) if len(hot) else np.zeros(len(vs), bool)
    start, n = block.cold.spans(vs)
    n = np.where(is_hot, 0, n)
    per_node = np.bincount(a, n, len(nodes)).astype(np.int64)
    ends, lo = np.cumsum(per_node), 0
    entry_ends = np.searchsorted(a, np.arange(len(nodes)), "right")
    while lo < len(nodes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        hi = min(hi, lo + max(1, (1 << 62) // max(1, block.size)))
        e0, e1 = entry_ends[lo - 1] if lo else 0, entry_ends[hi - 1]
        which, places = _spread(start[e0:e1], n[e0:e1])
        keys = (a[e0:e1][which] - lo) * block.size + block.cold.items[places]
        keys, e = _counts(keys, ns[e0:e1][which] * block.cold.weights[places], (hi - lo) * block.size)
        row, b = keys // block.size + lo, keys % block.size
        lo = hi
        if not len(b):
            continue
        total = e
        if best and block.hot is not None and is_hot[e0:e1].any():
            mine = is_hot[e0:e1]
            total = e + _hot_terms(block, hot, row, b, a[e0:e1][mine], vs[e0:e1][mine], ns[e0:e1][mine])
        score = decay * (total / (d[row] * block.d[b]))
        if not best:
            good = _unequal(block, b, own[row])
            yield [nodes[row[good]], block.nodes[b[good]], score[good]]
            continue
        head = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        most = np.repeat(np.maximum.reduceat(score, head), np.diff(np.r_[head, len(row)]))
        top = np.flatnonzero(score == most)  # a node's partners ascend by id: the first is the least
        top = top[np.r_[True, row[top[1:]] != row[top[:-1]]]]
        row, b = row[top], b[top]
        mine = [table.column(c).take(pa.array(first[row])) for c in ctx]
        theirs = [c.take(pa.array(b)) for c in block.ctx]
        yield [*mine, nodes[row], *theirs, block.nodes[b], e[top], np.zeros(len(b)), d[row], block.d[b]]


def _hot_terms(block: _Block, hot: np.ndarray, row: np.ndarray, b: np.ndarray, a: np.ndarray, vs: np.ndarray, ns: np.ndarray) -> np.ndarray:
    """What the hot values add to the given pairs."""
    base, last = int(row[0]), int(row[-1])
    mine = np.zeros((last - base + 1, len(hot)))
    near = (a >= base) & (a <= last)
    mine[a[near] - base, np.searchsorted(hot, vs[near])] = ns[near]
    start, n = block.hot.spans(b.astype(np.int32))
    which, places = _spread(start, n)
    w = mine[row[which] - base, np.searchsorted(hot, block.hot.items[places])] * block.hot.weights[places]
    return np.bincount(which, w, len(b))


def _deep(block: _Block, table: pa.Table, decay: float, hot: np.ndarray, best: bool, limit: int):
    """Level 3 for whole nodes: columns of pairs, or of each node's best pair.

    A partner's score is C / (d_a d_b) times E, its equal neighbour pairs, plus the sum of g over its
    neighbours, where g(y) adds up the level-2 scores of y with a's neighbours. For the best partner
    the sum is made only where E / d_b plus the largest g, which is above what any partner's
    neighbours give on average, could still reach the best E / d_b."""
    new = _changes(table, ["node"])
    heads = np.r_[np.flatnonzero(new), table.num_rows]
    sizes, vs = _flat(table, "vs")
    _, ns = _flat(table, "ns")
    ends = np.r_[0, np.cumsum(sizes)]
    nodes, d, own = (_numbers(table, c) for c in ("node", "d", "own"))
    next_, nd, nown = _numbers(table, "kind") == FIXED_NEXT, _numbers(table, "nd"), _numbers(table, "nown")
    ns, by_node = ns.astype(np.float64), np.zeros(block.size)
    far = _changes(table, ["node", "kind", "far"])
    for lo, hi in zip(heads[:-1], heads[1:]):
        row = np.repeat(np.arange(lo, hi), sizes[lo:hi])
        v, n = vs[ends[lo]:ends[hi]], ns[ends[lo]:ends[hi]]
        inner = next_[row]
        # E: at the asked nodes only
        eb, et = _products(block.every, v[~inner], n[~inner], block.size, limit, lambda items, _: block.asked[items])
        # a neighbour's rows follow each other
        new_x = far[lo:hi] & next_[lo:hi]
        first_x = lo + np.flatnonzero(new_x)
        y, g = _next_scores(block, (np.cumsum(new_x) - 1)[row[inner] - lo], v[inner], n[inner], nd[first_x], nown[first_x], decay, limit)
        a, da = nodes[lo], d[lo]
        if best:
            ceiling = float(g.max(initial=0.0)) * (1 + 1e-9)
            share = et / block.d[eb]
            least = float(share.max(initial=0.0)) * (1 - 1e-9)
            if ceiling < least:
                close = share + ceiling >= least
                eb, et = eb[close], et[close]
                by_node[y] = g
                start, many = block.to_y.spans(eb.astype(np.int32))
                which, places = _spread(start, many)
                q = np.bincount(which, by_node[block.to_y.items[places]], len(eb))
                by_node[y] = 0.0
                b, s = eb, et
            else:
                b, s, q = _outer(block, eb, et, y, g, limit)
        else:
            b, s, q = _outer(block, eb, et, y, g, limit)
        score = decay * ((s + q) / (da * block.d[b]))
        if not best:
            good = _unequal(block, b, own[np.full(len(b), lo)]) & (block.own[b] != UNKNOWN)
            yield [np.full(int(good.sum()), a), block.nodes[b[good]], score[good]]
        elif len(b):
            key = score_keys(score)
            top = int(np.flatnonzero(key == key.max())[0])
            cold = s[top:top + 1]
            if block.hot is not None:
                mine = np.isin(v, hot) & ~inner
                if mine.any():
                    cold = cold - _hot_terms(block, hot, np.zeros(1, np.int64), b[top:top + 1], np.zeros(int(mine.sum()), np.int64), v[mine], n[mine])
            yield [np.array([a]), block.nodes[b[top:top + 1]], cold, q[top:top + 1], np.array([da]), block.d[b[top:top + 1]]]


def _outer(block: _Block, eb: np.ndarray, e: np.ndarray, y: np.ndarray, g: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All partners that a row meets: ``(b, E, sum of g over b's neighbours)``."""
    fb, f = _products(block.to_b, y, g, block.size, limit)
    b = np.union1d(eb, fb)
    s, q = np.zeros(len(b)), np.zeros(len(b))
    s[np.searchsorted(b, eb)] = e
    q[np.searchsorted(b, fb)] = f
    return b, s, q


def _score_rows(ctx: list[str], decay: float, hot: list[int], deep: bool, best: bool, schema: pa.Schema, limit: int):
    hot_values = np.array(sorted(hot), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for block, table in _streams(batches, ctx, hot_values, deep):
            found = _deep(block, table, decay, hot_values, best, limit) if deep else _shallow(block, table, ctx, decay, hot_values, best, limit)
            for columns in found:
                yield from out.add(columns)
        yield from out.rest()

    return run


# ---------------------------------------------------------------- operators


def scores(
    fixed: DataFrame, free: DataFrame, ctx: list[str], decay: float,
    fixed_next: DataFrame | None = None, free_next: DataFrame | None = None,
    names: tuple[str, str] = ("a", "b"), best: bool = False, hot: list[int] = (),
) -> DataFrame:
    """Scores of all pairs of a fixed and a free node, or with ``best`` each fixed node's best
    pairs (one a block of free nodes).

    ``fixed`` and ``free`` are profiles ``(*ctx, node, d, own, vs, ns)``, ``own`` only where read (not for the
    best of level 2). Level 3 needs ``fixed_next``, the profiles of the fixed nodes' neighbours
    ``(node, d, own, far, nd, nown, vs, ns)``, and ``free_next``, the neighbour lists ``(node, d, own, ys)``; ``free``
    then has every node that is in such a list. ``hot`` values are counted in the best, but no pair is met through
    them at level 2, and what they add is left out of ``e``. Returns ``(a, b, score)`` without the
    value-equal pairs, or ``(*ctx_a, a, *ctx_b, b, e, q, deg_a, deg_b)``."""
    deep = fixed_next is not None
    a, b = names
    whole = free.schema["vs"].dataType.elementType.simpleString()
    rows, n = _entries(free)
    blocks = max(1, math.ceil(n / BLOCK))
    parts_free = [(free, FREE)]
    if deep:
        _, links = _entries(free_next, "ys")
        blocks = max(1, math.ceil(links / BLOCK))
        if n > WIDE_BLOCK:  # profiles read by a block: at most those of its nodes and all of their neighbours
            blocks = max(blocks, math.ceil((n + links * n / max(1, rows)) / WIDE_BLOCK))
    bands = _bands(free, blocks, _entries(fixed)[0])
    if deep:
        links = free_next.select(F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("j"), F.explode("ys").alias("node"))
        near = links.unionByName(free_next.select(F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("j"), "node")).distinct()
        spread = lambda j: F.transform(F.sequence(F.lit(0).cast("long"), F.lit(bands - 1).cast("long")), lambda i: i * blocks + j)
        read = free.join(near, "node") if blocks > 1 else free.withColumn("j", F.lit(0).cast("long"))
        parts_free = [(read, FREE, spread(F.col("j"))), (free_next, FREE_NEXT, _cells_of("node", blocks, bands, False))]
    else:
        parts_free = [(free, FREE, _cells_of("node", blocks, bands, False))]
    to = _cells_of("node", bands, blocks, True)
    parts = [*parts_free, (fixed, FIXED, to)]
    if deep:
        parts.append((fixed_next, FIXED_NEXT, to))
    dealt = _deal(parts, ctx, bands * blocks, whole)
    kinds = {c: free.schema[c].dataType.simpleString() for c in ctx}
    if best:
        fields = [*[(f"{c}_{a}", kinds[c]) for c in ctx], (a, "bigint"), *[(f"{c}_{b}", kinds[c]) for c in ctx], (b, "bigint"),
                  ("e", "double"), ("q", "double"), (f"deg_{a}", "double"), (f"deg_{b}", "double")]
    else:
        fields = [(a, "bigint"), (b, "bigint"), ("score", "double")]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "smallint": pa.int16(), "tinyint": pa.int8()}
    schema = pa.schema([(name, arrow[kind]) for name, kind in fields])
    return dealt.mapInArrow(_score_rows(ctx, decay, list(hot), deep, best, schema, PRODUCTS), ", ".join(f"{name} {kind}" for name, kind in fields))
