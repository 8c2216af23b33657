"""Helpers shared by the text operators: word hashing in numpy, row keys, Arrow plumbing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text hashed at once; bounds the 8-byte-per-byte work arrays.
PIECE = 1 << 19


def _table(is_word, lower: bool) -> bytes:
    """Translation of single bytes: what is not part of a word becomes a space."""
    out = bytearray(32 if not is_word(b) else b for b in range(256))
    if lower:
        for b in range(65, 91):
            if out[b] != 32:
                out[b] = b + 32
    return bytes(out)


#: words [^\x20\x09-\x0D]+, case kept
PLAIN = _table(lambda b: b not in SPACES, lower=False)
#: words [^\x20\x09-\x0D]+ after lower-casing A-Z
SPACED = _table(lambda b: b not in SPACES, lower=True)
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80, lower=True)

_rng = np.random.Generator(np.random.PCG64(0x5EED))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, PIECE + 4096)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer (every input bit reaches every output bit)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hash_piece(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power(len(a) + 1)
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[a] * up[: len(a)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of many texts: ``hash`` (64 bits a word), ``start``/``end`` (bytes in
    ``data``), ``ptr`` (first word of each text; one more entry closes the last)."""

    def __init__(self, texts: list[bytes], table: bytes):
        self.data = b" " + b" ".join(texts) + b" "
        a = np.frombuffer(self.data.translate(table), dtype=np.uint8)
        word = a != 32
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        if len(a) <= 2 * PIECE:
            self.hash = _hash_piece(a, self.start, self.end)
        else:
            parts, i = [], 0
            while i < len(self.start):
                lo = int(self.start[i])
                j = max(i + 1, int(np.searchsorted(self.end, lo + PIECE, "right")))
                hi = int(self.end[j - 1])
                parts.append(_hash_piece(a[lo:hi], self.start[i:j] - lo, self.end[i:j] - lo))
                i = j
            self.hash = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offset = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])
        self.ptr = np.searchsorted(self.start, self.offset)
        self.ptr[-1] = len(self.start)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    size = len(hashes) - n + 1
    out = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + hashes[i : i + size]
    return mix(out)


def pieces(texts: list[bytes | None], limit: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of about ``limit`` bytes: (index of the first, texts)."""
    first, size, held = 0, 0, []
    for i, text in enumerate(texts):
        held.append(text or b"")
        size += len(held[-1])
        if size >= limit:
            yield first, held
            first, size, held = i + 1, 0, []
    if held:
        yield first, held


def as_bytes(column: str = "text") -> Column:
    return F.col(column).cast("binary")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of ``df`` has (names are not case sensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
