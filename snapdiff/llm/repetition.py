"""Quality rules by repetition coverage: rolling n-gram hashes in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.text import PLAIN, Words, as_bytes, free_names, pieces, windows

#: Largest share of a text's word characters inside n-grams (n words) that occur more than once.
MAX_COVERED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share inside the most frequent n-gram.
MAX_TOP = {2: 0.20, 3: 0.18, 4: 0.16}
#: Largest share of word characters in lines that repeat an earlier line.
MAX_DUP_LINE_CHARS = 0.20
#: The plain rule before the repetition rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_MARKS = re.compile(rb"[#*$%&|<>]")
_CONTINUATION = np.zeros(256, bool)
_CONTINUATION[0x80:0xC0] = True


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of ``n`` that begins at one of ``starts``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + n, size), -1)
    return np.cumsum(edge[:-1]) > 0


def _lines(text: bytes, chars: int) -> tuple[int, int, float]:
    """Lines with a word, those equal to an earlier one, and the characters' share of these."""
    parts = [x for x in text.split(b"\n") if x.split()]
    if len(set(parts)) == len(parts):
        return len(parts), 0, 0.0
    seen: set[bytes] = set()
    repeated = 0
    size = 0
    for line in parts:
        if line in seen:
            repeated += 1
            size += len(b"".join(line.split()).decode("utf-8", "replace"))
        seen.add(line)
    return len(parts), repeated, size / max(1, chars)


def measure(texts: list[bytes]) -> dict[str, list]:
    """The measures of each text, as columns.

    Windows of n words count as equal if their 64-bit rolling hashes are. A
    window of another length is hashed from the same word hashes, so the text
    is read once. A covered word counts with its characters (code points).
    """
    words = Words(texts, PLAIN)
    data = np.frombuffer(words.data, np.uint8)
    points = np.concatenate([[0], np.cumsum(~_CONTINUATION[data])])
    chars = points[words.end] - points[words.start]
    total = np.concatenate([[0], np.cumsum(chars)])
    out: dict[str, list] = {k: [] for k in (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words", "covered", "top")}
    lengths = sorted({3, *MAX_COVERED, *MAX_TOP})
    for i, text in enumerate(texts):
        lo, hi = int(words.ptr[i]), int(words.ptr[i + 1])
        h, mine = words.hash[lo:hi], chars[lo:hi]
        size, whole = hi - lo, int(total[hi] - total[lo])
        repeat_words, covered, top = 0, [], []
        more = True  # a text without a repeated (n-1)-gram has no repeated n-gram
        for n in lengths:
            share = best = 0.0
            if more and size > n:
                grams = windows(h, n)
                order = np.argsort(grams, kind="stable")
                ranked = grams[order]
                new = np.ones(len(ranked), bool)
                new[1:] = ranked[1:] != ranked[:-1]
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(ranked)))
                many = np.repeat(count, count) > 1
                more = bool(many.any())
                if more:
                    at = order[many]
                    inside = _covered(at, n, size)
                    if n == 3:
                        repeat_words = int(inside.sum())
                    share = float(mine[inside].sum()) / max(1, whole)
                    if n in MAX_TOP:
                        k = int(count.argmax())
                        of = order[first[k] : first[k] + count[k]]
                        best = float(mine[_covered(of, n, size)].sum()) / max(1, whole)
            if n in MAX_COVERED:
                covered.append(share)
            if n in MAX_TOP:
                top.append(best)
        n_lines, repeated, line_share = _lines(text, whole)
        for key, value in (("n_words", size), ("word_chars", whole), ("n_symbols", len(_MARKS.findall(text))),
                           ("n_lines", n_lines), ("n_dup_lines", repeated), ("dup_line_chars", line_share),
                           ("n_repeat_words", repeat_words), ("covered", covered), ("top", top)):
            out[key].append(value)
    return out


def repetition(docs: DataFrame, text: str = "text", out: str = "repetition") -> DataFrame:
    """``docs`` with a struct of measures of the whole text.

    ``n_words`` (runs of ``[^\\x20\\x09-\\x0D]``), ``word_chars`` (code points in
    words), ``n_symbols``, ``n_lines`` (``\\n``-split lines with a word),
    ``n_dup_lines`` (equal to an earlier line), ``dup_line_chars`` (share of
    word characters in those), ``n_repeat_words`` (words in 3-word windows
    found twice or more), ``covered`` (share of word characters in repeated
    n-grams, n = 5 to 10), ``top`` (share in the most frequent n-gram, n = 2 to
    4; ties: the n-gram with the least hash). Null and empty texts measure 0
    throughout. Each row is measured alone: repeated rows get equal results, an
    empty table gives an empty table. ``out`` must be free in ``docs``.
    """
    columns = docs.columns
    (body,) = free_names(docs, "_text_bytes")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    fields = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_lines", pa.int64()),
                        ("n_dup_lines", pa.int64()), ("dup_line_chars", pa.float64()), ("n_repeat_words", pa.int64()),
                        ("covered", pa.list_(pa.float64())), ("top", pa.list_(pa.float64()))])
    schema = (f"{kept}, `{out}` struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_lines:bigint,n_dup_lines:bigint,"
              "dup_line_chars:double,n_repeat_words:bigint,covered:array<double>,top:array<double>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in pieces(batch.column(len(columns)).to_pylist()):
                got = measure(held)
                struct = pa.StructArray.from_arrays([pa.array(got[f.name], f.type) for f in fields], fields=list(fields))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, len(held)) for c in batch.columns[: len(columns)]), struct], names=[*columns, out])

    return docs.select(*[F.col(f"`{c}`") for c in columns], as_bytes(text).alias(body)).mapInArrow(run, schema)


def base_failed(m: str = "repetition"):
    """The plain rule: too few words, or more than half of them repeat."""
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m}.n_words"))


def repetitive(m: str = "repetition"):
    """The method's verdict: one of the coverage shares is over its limit."""
    rules = [F.element_at(f"{m}.covered", i + 1) > limit for i, limit in enumerate(MAX_COVERED.values())]
    rules += [F.element_at(f"{m}.top", i + 1) > limit for i, limit in enumerate(MAX_TOP.values())]
    rules.append(F.col(f"{m}.dup_line_chars") > MAX_DUP_LINE_CHARS)
    bad = rules[0]
    for rule in rules[1:]:
        bad = bad | rule
    return bad
