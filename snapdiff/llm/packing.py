"""Best-two-fit packing of tokenized documents into fixed-length sequences."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.llm.text import PIECE, as_bytes, pieces
from snapdiff.session import cut_lineage

SEQUENCE = 2048
SEPARATOR = 0
#: Entries of a task's token caches; a full cache is emptied, results do not change.
CACHE = 1_000_000
#: Longest chunk worth caching, in bytes.
LONG = 48

_caches: dict[str, "_Encoder"] = {}


def _byte_letters() -> list[str]:
    """The letter that a byte-level tokenizer writes for each byte: printable
    Latin-1 characters stand for themselves, the others follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


_LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"


class _Encoder(dict):
    """A word or mark as the tokenizer splits it -> its ids as little-endian uint32 bytes.

    The tokenizer drops white space, never joins across it and treats each word
    on its own. A text of ASCII and Latin-1 letters is split here by the
    tokenizer's own pattern (such texts have no other normal form than their
    lower case) and each word goes to the tokenizer's model once. Chunks with
    any other character take the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.plain = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
        self.split = re.compile(f"[{_LETTER}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\\t-\\r {_LETTER}0-9]+").findall

    def __missing__(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
        out = b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(shown))
        if len(word) <= LONG:
            self[word] = out
        return out

    def ids(self, text: str) -> bytes:
        if "<|" not in text and self.plain(text):  # <| begins the special tokens
            return b"".join(map(self.__getitem__, self.split(text.lower())))
        if (chunks := text.encode().split()) and len(chunks) > 1:
            return b"".join(self.ids(chunk.decode()) for chunk in chunks)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def encode_text(text: bytes, encoder: _Encoder) -> bytes:
    """Ids of one text as little-endian uint32 bytes."""
    if len(encoder) > CACHE:
        encoder.clear()
    return encoder.ids(text.decode("utf-8", "replace"))


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece of each document: ``doc_id, piece, start, length, ids``.

    A document is its text's ids, then one separator id; null texts count as
    empty, so every row gives at least one piece. Only documents longer than
    ``length`` are cut, into pieces of ``length`` ids; the last may be shorter.
    ``ids`` holds unsigned little-endian 32-bit ids (binary). Repeated rows
    give repeated pieces. The tokenizer file is read on the executors by path.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), as_bytes(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _caches.get(tokenizer_path) or _caches.setdefault(tokenizer_path, _Encoder(tokenizer_path))
        step = 4 * length
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, held in pieces(texts, 4 * PIECE):
                at, piece, start, size, ids = [], [], [], [], []
                for i, t in enumerate(held, first):
                    whole = encode_text(t, encoder) + SEPARATOR.to_bytes(4, "little")
                    for k, lo in enumerate(range(0, len(whole), step)):
                        part = whole[lo : lo + step]
                        at.append(i)
                        piece.append(k)
                        start.append(k * length)
                        size.append(len(part) // 4)
                        ids.append(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return rows.mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids binary")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best-two-fit over a histogram of lengths: ``(copies, lengths of one bin)``.

    A bin takes the longest remaining piece, then greedily the longest that
    fits its gap. Then its smallest piece (if it has two or more) is taken out
    and the pair of remaining pieces that fills the widened gap best replaces
    it, if it leaves less room than the piece did. The bin is repeated while
    its lengths last, so the work depends on ``capacity`` and not on the rows:
    each step uses up a length (below the number a bin needs of it).
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        left[size] = n
    bins: list[tuple[int, list[int]]] = []
    if left[capacity]:
        bins.append((int(left[capacity]), [capacity]))
        left[capacity] = 0
    index = np.arange(capacity + 1)
    top = capacity
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return bins
        fits = np.maximum.accumulate(np.where(left > 0, index, 0))  # longest remaining <= i
        used: dict[int, int] = {}

        def best(room: int) -> int:
            size = int(fits[room])
            while size and left[size] <= used.get(size, 0):
                size = int(fits[size - 1])
            return size

        chosen, room = [], capacity
        while room and (size := best(room)):
            chosen.append(size)
            used[size] = used.get(size, 0) + 1
            room -= size
        if room and len(chosen) > 1:
            small = chosen[-1]
            wide = room + small
            free = left.copy()
            for size, n in used.items():
                free[size] -= n
            free[small] = 0  # a pair with the piece itself was ruled out by the greedy fill
            fit = np.maximum.accumulate(np.where(free > 0, index, 0))
            x = np.flatnonzero(free[: wide + 1] > 0)
            if len(x):
                y = fit[wide - x]
                twice = (x == y) & (free[x] < 2)
                y = np.where(twice, fit[np.maximum(y - 1, 0)], y)
                total = np.where(y > 0, x + y, 0)
                k = int(total.argmax())
                if total[k] > small:
                    chosen[-1:] = sorted((int(x[k]), int(y[k])), reverse=True)
        need: dict[int, int] = {}
        for size in chosen:
            need[size] = need.get(size, 0) + 1
        copies = min(int(left[size]) // n for size, n in need.items())
        for size, n in need.items():
            left[size] -= n * copies
        bins.append((copies, chosen))


def _slots(bins: list[tuple[int, list[int]]]) -> np.ndarray:
    """One row per place of a bin form: length, first rank, copies, first sequence, offset."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for copies, sizes in bins:
        offset = 0
        for size in sizes:
            out.append((size, rank.get(size, 0), copies, sequence, offset))
            rank[size] = rank.get(size, 0) + copies
            offset += size
        sequence += copies
    table = np.array(out, dtype=np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(items: DataFrame, capacity: int = SEQUENCE, length: str = "length") -> DataFrame:
    """``items`` with ``sequence_id, offset``: a place for every row.

    Lengths lie between 1 and ``capacity``. Rows of equal length are
    interchangeable, so only the histogram of lengths (``capacity`` rows at
    most) reaches the driver. Each row is then numbered among its length:
    counts per (length, hash bucket) give each bucket's first number, so a
    length that a third of the rows share is spread over all buckets. Working
    columns start with ``_pack``; ``items`` must not change between reads (it
    is cut by checkpoint here). An empty table gives an empty table.
    """
    spark = items.sparkSession
    columns = items.columns
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.spark_partition_id()), F.lit(n)).cast("int")
    items = cut_lineage(items.withColumn("_pack_bucket", spread))
    counts = cut_lineage(items.groupBy(F.col(length).alias("_pack_len"), "_pack_bucket").agg(
        F.count(F.lit(1)).alias("_pack_n")))
    histogram = counts.groupBy("_pack_len").agg(F.sum("_pack_n").alias("n")).collect()
    slots = _slots(plan_bins({int(r["_pack_len"]): int(r["n"]) for r in histogram}, capacity))
    by_bucket = Window.partitionBy("_pack_len").orderBy("_pack_bucket")
    firsts = counts.select(
        "_pack_len", F.col("_pack_bucket").alias("_pack_b"),
        (F.sum("_pack_n").over(by_bucket) - F.col("_pack_n")).alias("_pack_first"),
    )
    inside = Window.partitionBy(length, "_pack_bucket").orderBy(*columns)
    ranked = (
        items.withColumn("_pack_row", F.row_number().over(inside))
        .join(firsts, (F.col(length) == F.col("_pack_len")) & (F.col("_pack_bucket") == F.col("_pack_b")))
        .select(*columns, (F.col("_pack_first") + F.col("_pack_row") - 1).alias("_pack_rank"))
    )
    at = columns.index(length)
    key = slots[:, 0] << np.int64(48) | slots[:, 1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(len(columns)).to_numpy(zero_copy_only=False).astype(np.int64)
            row = slots[np.searchsorted(key, size << np.int64(48) | rank, "right") - 1] if len(size) else slots[:0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                names=[*columns, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(pieces_with_ids: DataFrame, packed: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """``sequence_id, length, ids``: the packed sequences themselves.

    Joins the pieces' ids to their places by (doc_id, piece, start) and lays
    them out by offset; a group holds ``capacity`` ids at most. For tables
    whose ids are unique per document.
    """
    keys = ["doc_id", "piece"]
    rows = pieces_with_ids.select(*keys, "ids", "length").join(packed.select(*keys, "sequence_id", "offset"), keys)
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return rows.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids")
    )
