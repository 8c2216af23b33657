"""Hard negatives by a secondary-sort shuffle.

A stated set of anchors is scored against all rows, block by block. Scores travel as
packed keys (anchor, descending score, id); rows are dealt by anchor and sorted by key
(``repartition`` and ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``). An iterator then reads the sorted stream: a
positive opens a window of scores, a negative is emitted to the open windows, a window
closes when it is full or the scores have fallen below it. An anchor's rows are never
held together.

There are two such shuffles: the first finds each anchor's positives, the second its
negatives. Before either a block keeps only what the stream could emit: its own first
positives of an anchor, and its own first negatives of each window. A row behind those
has enough rows of its own block before it, so nothing that belongs to the result is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdiff.session import cut_lineage, scratch_path

#: Positives of an anchor, negatives of a positive, and the window in hundredths of the positive's score.
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
#: Components are scaled by this and rounded down.
SCALE = 256
#: Rows of a block, and anchors that are scored against one at once.
BLOCK, ANCHORS = 2048, 256

_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("row", ">u8")])
_WINDOWS = "array<struct<id:long,score:long>>"
_PARTS = f"rows array<long>, labels array<long>, windows array<{_WINDOWS}>, width int, data binary"


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, row: np.ndarray) -> list[bytes]:
    """Keys whose byte order is (anchor, descending score, kind, row)."""
    flip = np.uint64(1 << 63)
    key = np.empty(len(anchor), _KEY)
    key["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ flip
    key["score"] = ~(score.astype(np.int64).view(np.uint64) ^ flip)
    key["kind"] = kind
    key["row"] = row.astype(np.int64).view(np.uint64) ^ flip
    return [key[i : i + 1].tobytes() for i in range(len(key))]


def unpack(keys: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, score, kind, row) of packed keys."""
    flip = np.uint64(1 << 63)
    key = np.frombuffer(b"".join(keys), _KEY)
    plain = lambda x: x.astype(np.uint64).view(np.int64).tolist()
    return zip(plain(key["anchor"].astype(np.uint64) ^ flip), plain(~key["score"].astype(np.uint64) ^ flip),
               key["kind"].tolist(), plain(key["row"].astype(np.uint64) ^ flip))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers (float64), as int64."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if reach < 2**53:  # a double holds every partial sum
        return (a @ b.T).astype(np.int64)
    if reach < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    out = np.array([[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a], dtype=object).reshape(len(a), len(b))
    if any(abs(x) >= 2**63 for x in out.ravel()):
        raise ValueError("a score needs more than 64 bits")
    return out.astype(np.int64)


def usable(rows: DataFrame, id_col: str, label: str, vector: str) -> DataFrame:
    """``row, label, vector`` of the rows that take part, one for each id."""
    values = F.col(vector).cast("array<double>")
    whole = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    some = rows.select(F.col(id_col).cast("long").alias("row"), F.col(label).cast("long").alias("label"), values.alias("vector"),
                       F.coalesce(whole, F.lit(False)).alias("whole"))
    some = some.where(F.col("whole") & F.col("row").isNotNull() & F.col("label").isNotNull())
    return some.groupBy("row").agg(F.min(F.struct("label", "vector")).alias("m")).select("row", "m.label", "m.vector")


def _packed(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """``part`` and ``_PARTS``: runs of up to ``size`` rows of one width, a matrix each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def out(width: int) -> pa.RecordBatch:
            told = sorted(held.pop(width), key=lambda t: t[0])
            data = np.floor(scale * np.array([t[2] for t in told], np.float64)).tobytes()
            pair = pa.struct([("id", pa.int64()), ("score", pa.int64())])
            return pa.RecordBatch.from_arrays(
                [pa.array([[t[0] for t in told]], pa.list_(pa.int64())), pa.array([[t[1] for t in told]], pa.list_(pa.int64())),
                 pa.array([[t[3] for t in told]], pa.list_(pa.list_(pair))), pa.array([width], pa.int32()), pa.array([data], pa.binary())],
                names=["rows", "labels", "windows", "width", "data"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                width = len(row[2])
                held.setdefault(width, []).append(row)
                if len(held[width]) >= size:
                    yield out(width)
        for width in list(held):
            yield out(width)

    windows = F.col("windows") if "windows" in rows.columns else F.lit(None).cast(_WINDOWS)
    made = rows.select("row", "label", "vector", windows.alias("windows")).mapInArrow(run, _PARTS)
    path = scratch_path(rows.sparkSession, "vectors")
    made.withColumn("part", F.monotonically_increasing_id()).write.option("compression", "none").parquet(path)
    return rows.sparkSession.read.parquet(path)


def _first(scores: np.ndarray, fit: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the first ``n`` fitting entries of each line by descending score, then id."""
    least = np.iinfo(np.int64).min
    held = np.where(fit, scores, least)
    if held.shape[1] > n:  # a line's n-th score; its ties stay until ids decide
        fit = fit & (held >= np.partition(held, held.shape[1] - n, axis=1)[:, [held.shape[1] - n]])
    at, col = np.nonzero(fit)
    order = np.lexsort((row[col], ~scores[at, col], at))
    at, col = at[order], col[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    return at[place < n], col[place < n]


def _positives(ids, labels, windows, matrix, rows, row_labels, scores, n: int, bounds) -> tuple[np.ndarray, np.ndarray]:
    same = (labels[:, None] == row_labels[None]) & (ids[:, None] != rows[None])
    return _first(scores, same, rows, n)


def _negatives(ids, labels, windows, matrix, rows, row_labels, scores, n: int, bounds) -> tuple[np.ndarray, np.ndarray]:
    low, high = bounds
    other = labels[:, None] != row_labels[None]
    found = [np.zeros(0, np.int64)]
    for k in range(max((len(w) for w in windows), default=0)):
        some = np.array([len(w) > k for w in windows])
        # ceil(low * p / 100) and floor(high * p / 100) in whole numbers of any size
        least = np.array([-(-low * w[k]["score"] // 100) if len(w) > k else 0 for w in windows], np.int64)
        most = np.array([high * w[k]["score"] // 100 if len(w) > k else 0 for w in windows], np.int64)
        at, col = _first(scores, other & some[:, None] & (scores >= least[:, None]) & (scores <= most[:, None]), rows, n)
        found.append(at * len(rows) + col)
    both = np.unique(np.concatenate(found))
    return both // max(1, len(rows)), both % max(1, len(rows))


def _keys(blocks: DataFrame, anchors: DataFrame, pick: Callable, kind: int, n: int, bounds: tuple[int, int], ranges: int) -> DataFrame:
    """``anchor, key``: what ``pick`` keeps of each block for each anchor.

    Blocks are dealt over the tasks and each run of anchors is copied to every task; a
    task holds its blocks and reads one run of anchors at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for task, asked, ids, labels, windows, width, data in zip(*(c.to_pylist() for c in batch.columns)):
                if task != now:  # a partition may get several
                    now, held = task, []
                ids, labels = np.array(ids, np.int64), np.array(labels, np.int64)
                matrix = np.frombuffer(data, np.float64).reshape(len(ids), width)
                if not asked:
                    held.append((ids, labels, matrix))
                    continue
                windows = [w or [] for w in windows]
                for rows, row_labels, other in held:
                    if other.shape[1] != width:
                        continue
                    scores = inner_products(matrix, other)
                    at, col = pick(ids, labels, windows, matrix, rows, row_labels, scores, n, bounds)
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[at]), pa.array(pack(ids[at], scores[at, col], kind, rows[col]), pa.binary())], names=["anchor", "key"])

    columns = ["rows", "labels", "windows", "width", "data"]
    place = blocks.select(F.pmod(F.xxhash64("part"), F.lit(ranges)).cast("int").alias("task"), F.lit(False).alias("asked"), *columns)
    copies = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("task"), F.lit(True).alias("asked"), *columns)
    dealt = place.union(copies).repartition(ranges, "task").sortWithinPartitions("task", "asked")
    return dealt.mapInArrow(run, "anchor long, key binary")


def _by_anchor(keys: DataFrame, ranges: int) -> DataFrame:
    return keys.repartition(ranges, "anchor").sortWithinPartitions("key").select("key")


def _opened(keys: DataFrame, n: int, ranges: int) -> DataFrame:
    """``anchor, positive_id, positive_score``: the first ``n`` rows of each anchor's stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, 0
        for batch in batches:
            out = []
            for anchor, score, _, row in unpack(batch.column(0).to_pylist()):
                now, seen = anchor, seen + 1 if anchor == now else 1
                if seen <= n:
                    out.append((anchor, row, score))
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in out], pa.int64()) for i in range(3)],
                                             names=["anchor", "positive_id", "positive_score"])

    return _by_anchor(keys, ranges).mapInArrow(run, "anchor long, positive_id long, positive_score long")


def _emitted(keys: DataFrame, n: int, bounds: tuple[int, int], ranges: int) -> DataFrame:
    """Negatives of each positive from the sorted stream of both."""
    low, high = bounds
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, windows = None, []  # a window: positive, its score, negatives so far
        for batch in batches:
            out = []
            for anchor, score, kind, row in unpack(batch.column(0).to_pylist()):
                if anchor != now:
                    now, windows = anchor, []
                if kind == 0:
                    windows.append([row, score, 0])
                    continue
                windows = [w for w in windows if w[2] < n and low * w[1] <= 100 * score]
                for w in windows:
                    if 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], row, w[1], score))
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[i] for t in out], pa.int32() if i == 2 else pa.int64()) for i in range(6)], names=names)

    return _by_anchor(keys, ranges).mapInArrow(
        run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A row's score is its integer inner product with the anchor, components taken as
    floor(``scale`` * x). Higher scores come first, ties by the smaller id. An anchor's
    positives are its first ``positives`` other rows of its label; a positive's negatives
    are the first ``negatives`` rows of another label with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``
    (0 < low <= high <= 100, so a positive score below zero has none).

    ``is_anchor`` is a condition on the row's id, a column named ``row``. Rows with a null id, label or vector or a null
    or non-finite component take no part; of rows that share an id the one of the least
    (label, vector) counts; vectors of other lengths than the anchor's are not compared;
    labels are whole numbers. An empty table, or one without an anchor, gives no rows.
    Scores beyond 64 bits raise an error. Other columns are not read.
    """
    if not 0 < low <= high <= 100:
        raise ValueError("need 0 < low <= high <= 100")
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = cut_lineage(usable(rows, id_col, label, vector))
    blocks = _packed(some, BLOCK, scale)
    anchors = some.where(is_anchor)
    found = _keys(blocks, _packed(anchors, ANCHORS, scale), _positives, 0, positives, (low, high), ranges)
    opened = cut_lineage(_opened(found, positives, ranges))
    windows = opened.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct(
        F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("windows"))  # ``positives`` at most
    asked = _packed(anchors.join(windows, "row"), ANCHORS, scale)
    found = _keys(blocks, asked, _negatives, 1, negatives, (low, high), ranges)
    starts = opened.mapInArrow(_start_keys, "anchor long, key binary")
    return _emitted(starts.union(found), negatives, (low, high), ranges)


def _start_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, row, score = (np.array(c.to_pylist(), np.int64) for c in batch.columns)
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(pack(anchor, score, 0, row), pa.binary())], names=["anchor", "key"])
