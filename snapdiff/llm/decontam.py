"""Benchmark decontamination by Wu-Manber multi-pattern search over word sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.text import ALNUM, Words, as_bytes, free_names, mix, pieces
from snapdiff.session import scratch_path

#: Words of a window; an item with fewer words is one window of its own.
WINDOW = 13
#: Benchmark text searched in one pass over the documents, in bytes. A larger
#: benchmark is searched in several passes, one block of items each.
BLOCK_BYTES = 4 << 20
#: Words of a block in the shift table, and bits of the table's index.
PAIR = 2
TABLE_BITS = 18
#: Places of a document scanned side by side are so many words apart.
STRIDE = 256


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


class Patterns:
    """Wu-Manber tables for windows of one length (in words).

    ``shift``: for a hashed block of words, how far the search may move on:
    the least distance of the block to the end of any window that holds it.
    Blocks that end a window have shift 0; their windows are found in a bucket
    by the hash of the window's last and first block, and compared word by word.
    """

    def __init__(self, windows: dict[bytes, list[int]], length: int):
        self.length, self.block = length, min(PAIR, length)
        self.words = list(windows)
        self.items = list(windows.values())
        hashes = Words(self.words, ALNUM).hash.reshape(-1, length)
        self.shift = np.full(1 << TABLE_BITS, length - self.block + 1, dtype=np.uint8 if length < 256 else np.int64)
        for end in range(self.block - 1, length):
            at = self._block(hashes[:, end - self.block + 1], hashes[:, end]) & np.uint64((1 << TABLE_BITS) - 1)
            np.minimum.at(self.shift, at.astype(np.int64), length - 1 - end)
        key = self.bucket(hashes[:, 0], hashes[:, self.block - 1], hashes[:, length - self.block], hashes[:, -1])
        order = np.argsort(key, kind="stable")
        self.key, self.hashes = key[order], hashes[order]
        self.words = [self.words[i] for i in order]
        self.items = [self.items[i] for i in order]

    def _block(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return _pair(left, right) if self.block > 1 else right

    def bucket(self, a, b, c, d) -> np.ndarray:
        return _pair(self._block(a, b), self._block(c, d))

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window number) of every occurrence inside one text."""
        h, n = words.hash, self.length
        count = np.diff(words.ptr)
        ends = np.maximum(count - n + 1, 0)  # window ends in each text
        runs = -(-ends // STRIDE)
        if not runs.sum():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(count)), runs)
        turn = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
        at = words.ptr[:-1][of] + n - 1 + turn * STRIDE
        stop = np.minimum(at + STRIDE, words.ptr[1:][of])
        mask = np.uint64((1 << TABLE_BITS) - 1)
        place, which = [], []
        while len(at):
            step = self.shift[(self._block(h[at - self.block + 1], h[at]) & mask).astype(np.int64)]
            hit = at[step == 0]
            if len(hit):
                first = hit - n + 1
                key = self.bucket(h[first], h[first + self.block - 1], h[hit - self.block + 1], h[hit])
                lo, hi = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
                size = hi - lo
                some = size > 0
                first, lo, size = first[some], lo[some], size[some]
                number = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                first = np.repeat(first, size)
                same = np.ones(len(first), bool)
                for i in range(n):
                    same &= h[first + i] == self.hashes[number, i]
                place.append(first[same])
                which.append(number[same])
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        if not place:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place, which = np.concatenate(place), np.concatenate(which)
        clean = words.data.translate(ALNUM)
        sure = [b" ".join(clean[words.start[p] : words.end[p + n - 1]].split()) == self.words[k]
                for p, k in zip(place.tolist(), which.tolist())]
        return place[sure], which[sure]


def build_patterns(items: list[tuple[str, bytes]]) -> tuple[list[str], list[Patterns]]:
    """Item names and one table for each window length."""
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    by_length: dict[int, dict[bytes, set[int]]] = {}
    for name, text in items:
        words = (text or b"").translate(ALNUM).split()
        size = min(WINDOW, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(b" ".join(words[i : i + size]), set()).add(number[name])
    return names, [Patterns({k: sorted(v) for k, v in by_length[size].items()}, size) for size in sorted(by_length)]


def _blocks(benchmark: DataFrame, item_col: str, text: str) -> tuple[int, Iterator[list[tuple[str, bytes]]]]:
    """The number of blocks and the blocks, each read when it is asked for."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), as_bytes(text).alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(max(n, 1)))
    return n, ([(r["item"] if r["item"] is not None else "", bytes(r["text"])) for r in rows.where(part == k).collect()] for k in range(n))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id",
                   item_text: str = "text", out: tuple[str, str, str] = ("n_words", "hit_spans", "hit_items")) -> DataFrame:
    """``docs`` with, for the whole text of each row: the number of words, the
    merged runs of words inside occurrences (``array<struct<start,end>>``, words
    from 0, end exclusive) and the ids of the items occurring (sorted strings).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A
    window is 13 consecutive words of an item, or all words of a shorter one;
    items without words (or null) have none. Null texts have no words. Repeated
    items count once; items with a null id go by the empty name. Both tables
    may be empty. The three new names must be free in ``docs``.

    The benchmark is read in blocks of bounded size, whose tables go to the
    tasks. With several blocks, the documents are stored with row numbers, and
    each pass writes its hits to the shared folder before the next block is
    read: the driver and a task hold one block's tables at a time. The hits of
    all passes are then joined to the rows and merged.
    """
    columns = docs.columns
    body, row = free_names(docs, "_text_bytes", "_row_number")
    n_words, spans, items = out
    kept = [(f"`{f.name}`", f.dataType.simpleString()) for f in docs.schema.fields]

    def started(rows: DataFrame, names: list[str]) -> DataFrame:
        return rows.select(*[F.col(f"`{c}`") for c in names], as_bytes(text).alias(body), F.lit(0).cast("long").alias(n_words),
                           F.array().cast("array<long>").alias(spans), F.array().cast("array<string>").alias(items))

    def schema(fields: list[tuple[str, str]]) -> str:
        return ", ".join(f"{k} {t}" for k, t in [*fields, (f"`{body}`", "binary"), (f"`{n_words}`", "long"),
                                                 (f"`{spans}`", "array<long>"), (f"`{items}`", "array<string>")])

    def passed(block: list[tuple[str, bytes]], first_columns: list[str]):
        labels, tables = build_patterns(block)
        width, names = len(first_columns), [*first_columns, body, *out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                old_spans, old_items = batch.column(width + 2).to_pylist(), batch.column(width + 3).to_pylist()
                count, runs, hits = [], [], []
                for first, held in pieces(batch.column(width).to_pylist()):
                    words = Words(held, ALNUM)
                    count += np.diff(words.ptr).tolist()
                    edge = np.zeros(len(words.hash) + 1, np.int64)
                    mine: list[set[str]] = [set(x) for x in old_items[first : first + len(held)]]
                    for i, flat in enumerate(old_spans[first : first + len(held)]):
                        np.add.at(edge, words.ptr[i] + np.array(flat[0::2], np.int64), +1)
                        np.add.at(edge, words.ptr[i] + np.array(flat[1::2], np.int64), -1)
                    for table in tables:
                        place, which = table.find(words)
                        np.add.at(edge, place, 1)
                        np.add.at(edge, place + table.length, -1)
                        doc = np.searchsorted(words.ptr, place, "right") - 1
                        for i, k in {*zip(doc.tolist(), which.tolist())}:
                            mine[i].update(labels[x] for x in table.items[k])
                    hit = np.cumsum(edge[:-1]) > 0
                    hits += [sorted(x) for x in mine]
                    for i in range(len(held)):
                        flags = hit[words.ptr[i] : words.ptr[i + 1]]
                        if flags.any():
                            bounds = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
                            runs.append(bounds.tolist())
                        else:
                            runs.append([])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: width + 1], pa.array(count, pa.int64()),
                     pa.array(runs, pa.list_(pa.int64())), pa.array(hits, pa.list_(pa.string()))], names=names)

        return run

    n, blocks = _blocks(benchmark, item_col, item_text)
    if n <= 1:
        found = started(docs, columns).mapInArrow(passed(next(blocks, []), columns), schema(kept))
    else:
        spark = docs.sparkSession
        path = scratch_path(spark, "decontam-rows")
        docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
        stored = spark.read.parquet(path)
        hits = []
        for block in blocks:
            found = started(stored, [row]).mapInArrow(passed(block, [row]), schema([(f"`{row}`", "long")]))
            hits.append(scratch_path(spark, "decontam-hits"))
            found.where(F.size(items) > 0).select(row, spans, items).write.parquet(hits[-1])
        merged = spark.read.parquet(*hits).groupBy(row).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in (spans, items)])
        fresh = started(stored, [row, *columns]).drop(spans, items).join(merged, row, "left")
        fresh = fresh.select(*[F.col(f"`{c}`") for c in columns], body, n_words,
                             *[F.coalesce(F.col(c), F.array().cast(t)).alias(c) for c, t in ((spans, "array<long>"), (items, "array<string>"))])
        found = fresh.mapInArrow(passed([], columns), schema(kept))  # merges the spans of a row
    pairs = F.transform(F.sequence(F.lit(0), F.size(spans) - 2, F.lit(2)),
                        lambda i: F.struct(F.get(spans, i).alias("start"), F.get(spans, i + 1).alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return found.withColumn(spans, F.when(F.size(spans) == 0, none).otherwise(pairs)).drop(body)


def n_hit(spans: str | Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def contaminated(n_words: Column, hit: Column, share: int = 20) -> Column:
    """At least one hit word, and hits of a ``share``-th of the words or more."""
    return (hit > 0) & (share * hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows, columns as they were."""
    names = free_names(docs, "_n_words", "_hit_spans", "_hit_items")
    found = find_benchmark(docs, benchmark, text, out=tuple(names))
    return found.where(~contaminated(F.col(names[0]), n_hit(names[1]))).select(*docs.columns)
