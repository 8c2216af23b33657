"""Removal of repeated byte strings with a logarithmic family of sorted suffix indexes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.chunks import by_bucket, by_chunk, dealt, gathered, texts_of, write_chunks
from snapdiff.llm.text import _BYTE, _power, mix
from snapdiff.session import cut_lineage

#: A byte goes if a string of LENGTH bytes that covers it also starts earlier.
LENGTH = 100
#: Bytes of the grams that anchors are chosen among.
GRAM = 24
#: Bytes of documents kept together (a longer document stands alone).
CHUNK = 1 << 20
#: Positions hashed at once.
SLICE = 1 << 20
#: Records that enter an index at once.
BATCH = 1 << 15
_POSITION = np.uint64((1 << 24) - 1)


class Levels:
    """Sorted arrays of fingerprints in levels of doubling size.

    A new batch is sorted (its suffix array, by fingerprint), scanned against
    every level for strings already known, and added as a level of its own;
    levels of about equal size merge, so n batches leave log n levels and a
    record is merged log n times.
    """

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def known(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            out |= level[at] == keys
        return out

    def add(self, keys: np.ndarray) -> None:
        """``keys``: sorted, new and distinct."""
        if not len(keys):
            return
        while self.levels and len(self.levels[-1]) <= 2 * len(keys):
            keys = np.concatenate([self.levels.pop(), keys])
            keys.sort(kind="stable")  # two sorted runs: one merge
        self.levels.append(keys)

    def first_of(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key, in the given order, is seen for the first time; the keys become known."""
        out = np.zeros(len(keys), bool)
        for lo in range(0, len(keys), BATCH):
            batch, first = np.unique(keys[lo : lo + BATCH], return_index=True)
            new = ~self.known(batch)
            out[lo + first[new]] = True
            self.add(batch[new])
        return out


class Segments:
    """The runs of windows of a chunk of documents that share an anchor.

    A window is LENGTH bytes inside one document. Its anchor is the least of
    the GRAM-byte grams inside it (by hash, then the leftmost), so equal windows
    have equal anchors at equal places. A segment is a maximal run of windows
    with one anchor; ``key`` fingerprints all bytes of its windows, ``anchor``
    the gram. Long chunks are cut into slices; a segment that a slice cuts in
    two is two segments, which the comparison of windows makes good.
    """

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        self.length = length
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.bound = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        start, size, key, anchor = [], [], [], []
        self._sums: list[tuple[int, np.ndarray]] = []
        for lo in range(0, max(len(data) - length + 1, 0), SLICE):
            part = data[lo : lo + SLICE + length - 1]
            s, m, k, a = self._slice(part, lo)
            start.append(s), size.append(m), key.append(k), anchor.append(a)
        whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.start, self.size = whole(start, np.int64), whole(size, np.int64)
        self.key, self.anchor = whole(key, np.uint64), whole(anchor, np.uint64)
        self.doc = np.searchsorted(self.bound, self.start, "right") - 1

    def _slice(self, part: np.ndarray, lo: int):
        up, down = _power(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        self._sums.append((lo, sums))
        n = len(part) - GRAM + 1
        gram = mix((sums[GRAM:] - sums[:n]) * down[:n])
        value = (gram & ~_POSITION) | np.arange(n, dtype=np.uint64)
        span = self.length - GRAM + 1
        padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = value
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        count = n - span + 1
        at = np.minimum(behind[:count], ahead[span - 1 : span - 1 + count]) & _POSITION
        doc_end = self.bound[np.searchsorted(self.bound, lo + np.arange(count), "right").clip(max=len(self.bound) - 1)]
        inside = np.flatnonzero(lo + np.arange(count) + self.length <= doc_end)
        if not len(inside):
            nothing = np.zeros(0, np.int64)
            return nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
        chosen = at[inside].astype(np.int64)
        cut = np.flatnonzero((chosen[1:] != chosen[:-1]) | (inside[1:] != inside[:-1] + 1)) + 1
        first = np.concatenate([[0], cut])
        size = np.diff(np.append(first, len(inside)))
        start = inside[first]
        bytes_ = size - 1 + self.length
        key = mix((sums[start + bytes_] - sums[start]) * down[start] + bytes_.astype(np.uint64))
        return lo + start, size, key, mix(gram[chosen[first]] + np.uint64(1))

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, fingerprint) of every window of the given segments."""
        size = self.size[rows]
        total = int(size.sum())
        at = np.repeat(self.start[rows], size) + np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        out = np.zeros(total, np.uint64)
        for lo, sums in self._sums:
            here = np.flatnonzero((at >= lo) & (at < lo + SLICE))
            p = at[here] - lo
            out[here] = mix((sums[p + self.length] - sums[p]) * _power(len(sums))[1][p])
        return at, out


def _first_in(keys: np.ndarray) -> np.ndarray:
    """Indexes of the first of each distinct key, in order."""
    return np.sort(np.unique(keys, return_index=True)[1])


def _rank(ids: list) -> np.ndarray:
    """Order numbers of the ids; a null id comes first."""
    return np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)


def _in_buckets(sent: DataFrame, decide: Callable[[list[np.ndarray]], np.ndarray], kinds: list) -> DataFrame:
    """``chunk, answers`` from rows ``bucket, chunk, docs, k1 .. kN`` (blobs of numbers of these kinds).

    A bucket's records are put into document order and answered with a byte each.
    """

    def answer(rows: list[tuple]) -> Iterator[tuple[int, bytes]]:
        sizes = [len(r[2]) // 8 for r in rows]
        keys = [np.frombuffer(b"".join(r[3 + i] for r in rows), kind) for i, kind in enumerate(kinds)]
        doc = np.frombuffer(b"".join(r[2] for r in rows), np.int64)
        order = np.argsort(doc, kind="stable")  # rows come by chunk, records by place
        out = np.zeros(len(doc), np.uint8)
        out[order] = decide([k[order] for k in keys])
        at = 0
        for r, n in zip(rows, sizes):
            yield r[1], out[at : at + n].tobytes()
            at += n

    columns = ["bucket", "chunk", "docs", *[f"k{i + 1}" for i in range(len(kinds))]]
    return by_chunk(by_bucket(sent, columns, answer))


def _segment_verdicts(keys: list[np.ndarray]) -> np.ndarray:
    """0: the only content with its anchor, or nothing to do; 1: seen before; 2: first of
    its kind, but its anchor has other contents, so its windows must be compared."""
    key, anchor = keys
    first = Levels().first_of(key)
    kinds, inverse, count = np.unique(anchor[first], return_inverse=True, return_counts=True)
    out = np.where(first, 0, 1).astype(np.uint8)
    out[np.flatnonzero(first)[count[inverse] > 1]] = 2
    return out


def _window_verdicts(keys: list[np.ndarray]) -> np.ndarray:
    return np.where(Levels().first_of(keys[0]), 0, 1).astype(np.uint8)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id, n_bytes, spans, kept``.

    A byte of the UTF-8 text is removed if some string of ``length`` bytes that
    covers it also starts earlier: in a document with a smaller id, or before
    in the same one. ``spans`` are the maximal removed runs (start, end
    exclusive, in bytes), ``kept`` the remaining bytes. Ids are integers; null
    ids come first and null texts are empty. Rows that share an id follow one
    another in an arbitrary but fixed order, so a repeated row of ``length``
    bytes or more is removed from its second time on. Strings are judged on the input. An
    empty table gives an empty table. Texts shorter than ``length`` lose nothing.

    Only windows with equal anchors can be equal, so segments (runs of windows
    with one anchor) are sent to buckets by anchor, once per chunk, as a 64-bit
    fingerprint and 32 more bits of the anchor's (anchors that agree in these by
    chance only cause needless comparisons). A bucket takes them in document order, in batches: each batch is
    sorted, scanned against the levels of the index and added to them. A segment
    seen before is a repeat as a whole. Where an anchor has different contents,
    the windows of the first segment of each content go through a second such
    round, by 64-bit fingerprints.
    """
    n_buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunks = write_chunks(docs, CHUNK, id_col, text)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, data, chunk in zip(*(c.to_pylist() for c in batch.columns)):
                s = Segments(texts_of(sizes, data), length)
                sent = _first_in(s.key)
                doc = _rank(ids)[s.doc[sent]]
                rows = [(b, chunk, doc[r].tobytes(), s.key[sent[r]].tobytes(),
                         (s.anchor[sent[r]] >> np.uint64(32)).astype(np.uint32).tobytes())
                        for b, r in dealt(s.anchor[sent] % np.uint64(n_buckets))]
                yield _rows(rows, 2)

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, data, chunk, answers in zip(*(c.to_pylist() for c in batch.columns)):
                s = Segments(texts_of(sizes, data), length)
                at, key, bucket, mixed, _ = _second(s, answers, n_buckets)
                doc = _rank(ids)[np.searchsorted(s.bound, at, "right") - 1]
                yield _rows([(b, chunk, doc[r].tobytes(), key[r].tobytes()) for b, r in dealt(bucket)], 1)

    def last_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, data, _, answers, more in zip(*(c.to_pylist() for c in batch.columns)):
                texts = texts_of(sizes, data)
                s = Segments(texts, length)
                at, _, bucket, repeated, windows = _second(s, answers, n_buckets)
                again = gathered(bucket, more, np.uint8)
                starts = [s.start[repeated], at[again == 1], windows]
                ends = [s.start[repeated] + s.size[repeated] - 1 + length, at[again == 1] + length, windows + length]
                edge = np.zeros(int(s.bound[-1]) + 1, np.int64)
                for x in starts:
                    np.add.at(edge, x, 1)
                for x in ends:
                    np.add.at(edge, x, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans, kept = [], []
                for i, t in enumerate(texts):
                    flags = gone[s.bound[i] : s.bound[i + 1]]
                    if not flags.any():
                        spans.append([])
                        kept.append(t)
                        continue
                    bounds = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(bounds[0::2], bounds[1::2])])
                    kept.append(np.frombuffer(t, np.uint8)[~flags].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"])

    row = "bucket int, chunk long, docs binary, k1 binary"
    table = chunks.select("ids", "sizes", "data", "chunk")
    sent = table.mapInArrow(first_round, f"{row}, k2 binary")
    one = cut_lineage(_in_buckets(sent, _segment_verdicts, [np.uint64, np.uint32]))
    told = table.join(one, "chunk", "left").select("ids", "sizes", "data", "chunk", "answers")
    two = cut_lineage(_in_buckets(told.mapInArrow(second_round, row), _window_verdicts, [np.uint64]))
    told = told.join(two.select("chunk", F.col("answers").alias("more")), "chunk", "left")
    return told.select("ids", "sizes", "data", "chunk", "answers", "more").mapInArrow(
        last_round, "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")


def _second(s: Segments, answers: list[dict] | None, n_buckets: int):
    """From a chunk's segments and the first answers: the windows to compare (first
    byte, fingerprint, bucket; each content once), the segments that are repeats
    as a whole, and the windows that repeat inside the chunk."""
    sent = _first_in(s.key)
    verdict = np.ones(len(s.key), np.uint8)  # later ones in the chunk are repeats
    verdict[sent] = gathered(s.anchor[sent] % np.uint64(n_buckets), answers, np.uint8)
    mixed = np.flatnonzero(verdict == 2)
    at, key = s.windows(mixed)
    anchor = np.repeat(s.anchor[mixed], s.size[mixed])
    first = _first_in(key)
    later = np.ones(len(key), bool)
    later[first] = False
    return at[first], key[first], anchor[first] % np.uint64(n_buckets), np.flatnonzero(verdict == 1), at[later]


def _rows(rows: list[tuple], blobs: int) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), *[pa.binary()] * blobs]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      names=["bucket", "chunk", "docs", *[f"k{i}" for i in range(1, blobs + 1)]])
