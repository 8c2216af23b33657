"""Near-duplicate documents: HyperMinHash sketches, banding, exact check, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.text import SPACED, Words, as_bytes, mix, pieces, windows
from snapdiff.operators.graph import connected_components
from snapdiff.session import stored

SHINGLE = 5
#: Link at 100 * |A and B| >= SIMILARITY * |A or B|.
SIMILARITY = 75
#: Registers of a sketch: 2**BUCKET_BITS, each a count of leading zeros and MANTISSA bits.
BUCKET_BITS, MANTISSA = 8, 10
REGISTERS = 1 << BUCKET_BITS
#: BANDS * ROWS of the registers are banded. At a similarity of 0.75 all bands
#: miss with a chance of (1 - 0.75**4)**36, about one in a million.
BANDS, ROWS = 36, 4
#: A pair is checked unless its estimate lies so many deviations below the threshold.
MARGIN = 4.5
#: A hub whose estimate exceeds the threshold by this much is preferred by id.
SAFE = 0.08
#: Rounds in which linked nodes look for a common leader.
LEADER_ROUNDS = 2
#: A block with more plausible pairs than this for each member is compared by exact intersections.
DENSE = 4
#: Members of a bucket compared at once (larger buckets go by pairs of blocks).
BLOCK = 1024
#: A side of at most so many rows of a few numbers (some 50 MB) is broadcast, a larger one shuffled.
FEW = 1 << 20
EMPTY = 0xFFFF

_rng = np.random.Generator(np.random.PCG64(0xB0CCE7))
#: Buckets that an empty register borrows from, in turn, and the registers of each band.
_BORROW = np.array([_rng.permutation(REGISTERS) for _ in range(REGISTERS)], dtype=np.int16)
_BAND_OF = _rng.permutation(REGISTERS)[: BANDS * ROWS].reshape(BANDS, ROWS)
_SALT = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Steps are written tables: the job has many, and the driver should hold little of each."""
    return stored(df, "near")


def _few(side: DataFrame) -> DataFrame:
    """A stored table, broadcast if its checked size allows: texts and sketches then stay where they are."""
    return F.broadcast(side) if side.count() <= FEW else side


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of many texts, sorted within each: (hashes, first of each text).

    A text with fewer words than a shingle has its whole word sequence as one;
    a text without words has none.
    """
    words = Words(texts, SPACED)
    n = np.diff(words.ptr)
    all_hashes = windows(words.hash, SHINGLE)
    doc = np.repeat(np.arange(len(texts)), n)
    full = np.flatnonzero(doc[: len(all_hashes)] == doc[SHINGLE - 1 :]) if len(all_hashes) else np.zeros(0, np.int64)
    hashes, owner = all_hashes[full], doc[full]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        one = np.array([windows(words.hash[words.ptr[i] : words.ptr[i] + n[i]], int(n[i]))[0] + np.uint64(n[i])
                        for i in short], dtype=np.uint64)
        hashes, owner = np.concatenate([hashes, mix(one)]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[keep], owner[keep]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def sketch(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (texts x REGISTERS, uint16) of sorted distinct hashes.

    The top bits pick the bucket; of the least remaining value per bucket, the
    leading zeros and the MANTISSA bits behind the first one are kept.
    """
    n = len(ptr) - 1
    out = np.full((n, REGISTERS), EMPTY, dtype=np.uint16)
    if not len(hashes):
        return out
    owner = np.repeat(np.arange(n), np.diff(ptr))
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(hashes), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    rest = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(11)  # 53 bits, exact as float
    top = np.frexp(rest.astype(np.float64))[1].astype(np.int64)  # bits of the value
    zeros = 53 - top
    below = np.where(top > MANTISSA, rest >> np.maximum(top - 1 - MANTISSA, 0).astype(np.uint64),
                     rest << np.maximum(MANTISSA + 1 - top, 0).astype(np.uint64))
    mantissa = below & np.uint64((1 << MANTISSA) - 1)
    out[owner[first], bucket[first]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Keys of the bands (texts x BANDS, int64); an empty register borrows another's value."""
    filled = registers.copy()
    row, at = np.nonzero(registers == EMPTY)
    turn = 0
    while len(row) and turn < REGISTERS:
        value = registers[row, _BORROW[at, turn]]
        found = value != EMPTY
        filled[row[found], at[found]] = value[found]
        row, at = row[~found], at[~found]
        turn += 1
    key = np.zeros((len(registers), BANDS), np.uint64) + _SALT
    for i in range(ROWS):
        key = mix(key ^ (filled[:, _BAND_OF[:, i]].astype(np.uint64) + np.uint64(i << 16)))
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows and the number of registers used.

    Of the registers that either side fills, the equal ones, less the
    expected chance agreements of two unrelated sets of these sizes.
    """
    either = (a != EMPTY) | (b != EMPTY)
    used = np.maximum(either.sum(axis=-1), 1)
    equal = ((a == b) & either).sum(axis=-1)
    ratio = size_a / np.maximum(size_b, 1)
    chance = 0.169919487 * REGISTERS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return np.clip((equal - chance) / used, 0, 1), used


def _plausible(a, b, size_a, size_b, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The estimates, and whether sizes and estimate leave the threshold possible."""
    guess, used = estimate(a, b, size_a, size_b)
    t = percent / 100
    sized = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    return guess, sized & (guess >= t - MARGIN * np.sqrt(t * (1 - t) / used) - 2 / used)


def sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, set_a, set_b`` (128-bit fingerprint of the set),
    ``registers`` (binary), ``bands`` (array of keys). Empty sets have no bands."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in pieces(batch.column(1).to_pylist()):
                hashes, ptr = shingle_sets(held)
                n = np.diff(ptr)
                total = np.concatenate([[np.uint64(0)], np.cumsum(hashes)])
                other = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5)))])
                registers = sketch(hashes, ptr)
                keys = band_keys(registers)
                some = n > 0
                offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(held)), pa.array(n.astype(np.int64)),
                     pa.array((total[ptr[1:]] - total[ptr[:-1]]).view(np.int64)),
                     pa.array((other[ptr[1:]] - other[ptr[:-1]]).view(np.int64)),
                     pa.array([r.tobytes() for r in registers], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].reshape(-1)))],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "registers", "bands"],
                )

    return docs.select(F.col(id_col).alias("doc_id"), as_bytes(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, set_a long, set_b long, registers binary, bands array<long>")


def _full_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text: str) -> DataFrame:
    """``node, shingles`` (sorted 64-bit hashes) of the named documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in pieces(batch.column(1).to_pylist()):
                hashes, ptr = shingle_sets(held)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(held)),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:])], pa.binary())],
                    names=["node", "shingles"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("node"), as_bytes(text).alias("text"))
    return rows.join(_few(nodes), "node", "left_semi").mapInArrow(run, f"node {kind}, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets meet the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_of_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                same = int((large[at] == small).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "set_of_a", "set_of_b").mapInArrow(run, f"a {kind}, b {kind}")


def _likely(pairs: DataFrame, regs: DataFrame, percent: int) -> DataFrame:
    """``a, b, guess`` of the pairs whose sketches do not rule the threshold out."""
    left = regs.select(F.col("node").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na"))
    right = regs.select(F.col("node").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb"))
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (4, 5))
            guess, good = _plausible(x, y, na, nb, percent)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(guess)], names=["a", "b", "guess"])
            yield out.filter(pa.array(good))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ra", "rb", "na", "nb")
    return both.mapInArrow(run, f"a {kind}, b {kind}, guess double")


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of different components inside a bucket. Where a block has more than ``DENSE`` plausible
    pairs for each member it has, they are not listed: each member comes once, as a
    pair (its bucket's least member, itself) with ``dense`` set.

    ``members``: ``key, i, j, block, node, component, n_shingles, registers``,
    one row for each pair of blocks (i, j) that the member's block is in.
    Rows are dealt by (key, i, j) and read in order, so a task holds the two
    blocks of one group at a time.
    """
    kind = members.schema["node"].dataType.simpleString()

    def group(rows: list[tuple]) -> Iterator[tuple]:
        i, j = rows[0][1], rows[0][2]
        left = [r for r in rows if r[3] == i]
        right = left if i == j else [r for r in rows if r[3] == j]
        if not left or not right:
            return
        regs = np.frombuffer(b"".join(r[7] for r in right), np.uint16).reshape(-1, REGISTERS)
        comp = np.array([r[5] for r in right])
        size = np.array([r[6] for r in right], float)
        pairs = []
        for at, r in enumerate(left):
            other = comp != r[5]
            if i == j:
                other[: at + 1] = False
            pick = np.flatnonzero(other)
            if len(pick):
                mine = np.frombuffer(r[7], np.uint16)[None]
                good = _plausible(mine, regs[pick], np.full(len(pick), float(r[6])), size[pick], percent)[1]
                pairs += [(min(r[4], right[k][4]), max(r[4], right[k][4]), False) for k in pick[good]]
        nodes = {r[4] for r in rows}
        if len(pairs) > DENSE * len(nodes):
            least = min(nodes)
            pairs = [(least, n, True) for n in nodes]
        yield from pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: set[tuple] = set()

        def out() -> pa.RecordBatch:
            pairs = list(found)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64()),
                                               pa.array([p[2] for p in pairs], pa.bool_())], names=["a", "b", "dense"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:3] != row[:3]:
                    found.update(group(held))
                    held = []
                    if len(found) > 50_000:
                        yield out()
                held.append(row)
        if held:
            found.update(group(held))
        yield out()

    keyed = members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return keyed.select("key", "i", "j", "block", "node", "component", "n_shingles", "registers").mapInArrow(
        run, f"a {kind}, b {kind}, dense boolean").distinct()


def _dense_links(dense: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside groups of many plausible pairs, by exact intersections in blocks.

    ``dense``: pairs whose chains name the groups. A group's members are cut into
    blocks; each pair of blocks is one small matrix product over the shingles
    that its members share, and yields links that span what it connects. No
    pair is listed that is not a link.
    """
    group = cut_lineage(connected_components(dense.select(F.col("a").alias("src"), F.col("b").alias("dst")), cut_lineage))
    size = group.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    spread = group.join(cut_lineage(size), "component").withColumn("block", F.pmod(F.xxhash64("node_id"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    spread = spread.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                           "block", F.col("node_id").alias("node"))
    kind = spread.schema["node"].dataType.simpleString()

    def linked(rows: list[tuple]) -> list[tuple]:
        i, j = rows[0][1], rows[0][2]
        own = [np.frombuffer(r[5], np.uint64) for r in rows]
        size = np.array([len(x) for x in own])
        of = np.repeat(np.arange(len(rows)), size)
        number, count = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)[1:]
        kept = np.flatnonzero(count > 1)
        place = np.full(len(count), -1)
        place[kept] = np.arange(len(kept))
        same = np.zeros((len(rows), len(rows)), np.float32)
        for lo in range(0, len(kept), 8192):  # a stretch of the shared shingles at a time
            column = place[number]
            here = (column >= lo) & (column < lo + 8192)
            part = np.zeros((len(rows), min(8192, len(kept) - lo)), np.float32)
            part[of[here], column[here] - lo] = 1
            same += part @ part.T
        met = 100 * same >= percent * (size[:, None] + size[None] - same)
        parent = list(range(len(rows)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for x, y in zip(*(v.tolist() for v in np.nonzero(np.triu(met, 1)))):
            if {rows[x][3], rows[y][3]} == {i, j} and find(x) != find(y):
                parent[find(x)] = find(y)
                out.append((rows[x][4], rows[y][4]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            found = linked(held)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                                              names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][:3] != row[:3]:
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    keyed = spread.join(sets, "node").repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return keyed.select("component", "i", "j", "block", "node", "shingles").mapInArrow(run, f"a {kind}, b {kind}")


def _leaders(links: DataFrame) -> DataFrame:
    """``node, lead``: the least id that a few steps reach. Each round a node takes
    the least leader among its neighbours', then its leader's leader. Nodes with
    one leader are connected; connected nodes with different leaders are left to
    :func:`_components`, and until then only mean more comparisons."""
    both = cut_lineage(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))))
    lead = both.groupBy("u").agg(F.min("v").alias("to")).select("u", F.least("u", "to").alias("to"))
    for _ in range(LEADER_ROUNDS):
        of = cut_lineage(lead).select(F.col("u").alias("x"), F.col("to").alias("y"))
        near = both.join(of, F.col("v") == F.col("x")).groupBy("u").agg(F.min("y").alias("to"))
        near = cut_lineage(near.select("u", F.least("u", "to").alias("to")))
        of = near.select(F.col("u").alias("x"), F.col("to").alias("y"))
        lead = near.join(of, F.col("to") == F.col("x")).select("u", F.col("y").alias("to"))
    return cut_lineage(lead.select(F.col("u").alias("node"), F.col("to").alias("lead")))


def _components(links: DataFrame, lead: DataFrame) -> DataFrame:
    """``lead, component`` of the leaders that links still join: few edges and few rounds.
    A component's least id leads itself, so the least of its leaders is its least id."""
    ends = links.join(lead.select(F.col("node").alias("a"), F.col("lead").alias("x")), "a", "left")
    ends = ends.join(lead.select(F.col("node").alias("b"), F.col("lead").alias("y")), "b", "left")
    ends = ends.select(F.coalesce("x", "a").alias("src"), F.coalesce("y", "b").alias("dst"))
    cross = cut_lineage(ends.where(F.col("src") != F.col("dst")).distinct())
    return connected_components(cross, cut_lineage).select(F.col("node_id").alias("lead"), "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents whose shingle sets have a Jaccard similarity of ``percent`` / 100
    or more are linked; ``component_id`` is the least id reachable over links,
    ``kept`` says whether that is the row's own id. Ids are integers. Texts
    without words (or null) link with nothing. Rows that share an id are one
    document (each row is returned); rows with a null id link with nothing and
    are kept, with a null component. An empty table gives an empty table.

    1. Equal sets fold into one node (partial aggregation, any number of copies).
    2. Nodes that share a band key are a bucket. Each member is paired with one
       hub of its bucket (another in each band); pairs that the estimate allows
       are checked on full sets, three hubs for each node first.
    3. Buckets that still span several components are compared across
       components, in blocks, on sketches, and plausible pairs are checked on full
       sets. Where most pairs of a block are plausible (a large group near the
       threshold), none is listed: its members are compared exactly, in blocks.
    """
    rows = cut_lineage(sketches(docs, id_col, text))
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    sets_of = known.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.max("doc_id").alias("last"))
    # rows with the fingerprint's least id carry its sketch; equal rows give equal sketches
    copies = cut_lineage(sets_of.where(F.col("node") != F.col("last")).select(
        F.col("set_a").alias("ca"), F.col("set_b").alias("cb"), F.col("n_shingles").alias("cn"), "node"))
    member = known.select("doc_id", "set_a", "set_b", "n_shingles").join(
        _few(copies), (F.col("set_a") == F.col("ca")) & (F.col("set_b") == F.col("cb")) & (F.col("n_shingles") == F.col("cn")))
    folded = cut_lineage(member.where(F.col("doc_id") != F.col("node")).select(
        "doc_id", "set_a", "set_b", "n_shingles", "node").distinct())
    nodes = known.join(_few(folded.drop("node")), ["doc_id", "set_a", "set_b", "n_shingles"], "left_anti").select(
        F.col("doc_id").alias("node"), "n_shingles", "registers", "bands")
    nodes = cut_lineage(nodes)  # rows that share an id, also equal ones, may repeat here
    regs = nodes.select("node", "n_shingles", "registers")

    banded = nodes.select(F.explode("bands").alias("key"), "node")
    # the hub of a bucket: least id after a mask that differs from bucket to bucket
    hubs = banded.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(F.col("key"))).alias("mask"),
                                     F.max(F.col("node").bitwiseXOR(F.col("key"))).alias("far"))
    hubs = hubs.where(F.col("mask") != F.col("far")).select("key", F.col("mask").bitwiseXOR(F.col("key")).alias("hub"))
    shared = cut_lineage(banded.join(cut_lineage(hubs), "key"))
    star = shared.where(F.col("node") != F.col("hub")).select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    likely = cut_lineage(_likely(star, regs, percent))
    # three hubs for each node: the least id among those that look safe and among those
    # that look linked (so that few hubs gather a group), and the likeliest
    t = percent / 100
    best = likely.groupBy("a").agg(
        F.array_distinct(F.array_compact(F.array(
            F.min(F.when(F.col("guess") >= t + SAFE, F.col("b"))), F.min(F.when(F.col("guess") >= t, F.col("b"))),
            F.max_by("b", "guess")))).alias("hubs"))
    tested = best.select("a", F.explode("hubs").alias("b"))
    ends = cut_lineage(likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct())
    sets = cut_lineage(_full_sets(docs, ends, id_col, text))
    links = _confirm(tested, sets, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = cut_lineage(links.union(folded.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))))
    lead = _leaders(links)
    tested = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    # what is left: buckets whose members lie in several components
    labelled = shared.select("key", "node").distinct().join(lead, "node", "left")
    labelled = cut_lineage(labelled.select("key", "node", F.coalesce("lead", "node").alias("component")))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                        F.count(F.lit(1)).alias("members"))
    mixed = mixed.where(F.col("low") != F.col("high")).select("key", F.ceil(F.col("members") / BLOCK).alias("blocks"))
    spread = labelled.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    spread = spread.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                           "block", "node", "component")
    rest = cut_lineage(_across(spread.join(regs, "node"), percent))
    listed = rest.where(~F.col("dense")).select("a", "b").join(tested, ["a", "b"], "left_anti")
    dense = rest.where("dense").select("a", "b")
    # every plausible pair of a star is in ``likely``; other pairs may need sets that are not there yet
    more = rest.select(F.col("a").alias("node")).union(rest.select(F.col("b").alias("node"))).distinct()
    more = cut_lineage(more.join(ends, "node", "left_anti"))
    if not more.isEmpty():
        sets = sets.union(cut_lineage(_full_sets(docs, more, id_col, text)))
    links = links.union(_confirm(listed, sets, percent))
    if not dense.isEmpty():
        links = links.union(_dense_links(dense, sets, percent))
    group = _components(links, lead)
    return (
        rows.select("doc_id", "n_shingles")
        .join(lead.select(F.col("node").alias("doc_id"), "lead"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("lead", "doc_id").alias("lead"))
        .join(group, "lead", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "lead").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns kept.

    The document with the least id stays. Of rows that share a kept id one
    stays, the least by a hash of its columns; rows with a null id all stay.
    """
    from pyspark.sql import Window

    from snapdiff.llm.text import free_names

    columns = docs.columns
    mark, turn = free_names(docs, "_kept_id", "_turn")
    kept = near_duplicates(docs, id_col, text, percent).where(F.col("kept") & F.col("doc_id").isNotNull())
    kept = kept.select(F.col("doc_id").alias(mark)).distinct()
    first = Window.partitionBy(id_col).orderBy(F.xxhash64(*columns), text)
    some = docs.join(kept, docs[id_col] == kept[mark], "left_semi")
    one = some.withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1).select(*columns)
    return one.unionByName(docs.where(F.col(id_col).isNull()).select(*columns))
