"""Repeat removal against a plain set of all strings."""

import random

import numpy as np

from snapdiff.llm import suffix


def brute(rows, length):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, (rows[i][1] or "").encode()))
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = [True] * length
            seen.add(w)
        spans, at = [], None
        for p, g in enumerate([*gone, False]):
            if g and at is None:
                at = p
            if not g and at is not None:
                spans.append((at, p))
                at = None
        out.append((rows[i][0], len(data), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def got(spark, rows, length=suffix.LENGTH):
    df = suffix.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), length=length)
    return sorted(((r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in df.collect()), key=repr)


def corpus(seed, docs, vocabulary):
    rng = random.Random(seed)
    word = lambda: rng.choice(vocabulary)
    passages = [" ".join(word() for _ in range(rng.randrange(10, 60))) for _ in range(6)]
    rows = []
    for i in range(docs):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 60)))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(p[a : a + rng.randrange(60, 400)])
            parts.append(" ".join(word() for _ in range(rng.randrange(0, 20))))
        rows.append((rng.randrange(10**6) * 1000 + i, rng.choice(["\n", " "]).join(parts)))
    rows += [(5, rows[3][1]), (10**12, rows[4][1]), (7, None), (8, ""), (9, "x" * 99), (11, "y" * 250), (12, "ab" * 300), (13, "y" * 130)]
    return rows


def test_against_plain_sets(spark):
    for seed, words in ((1, [f"w{i}" for i in range(500)]), (2, ["aa", "ab", "é"]), (3, ["the", "of", "\x00", "zz zz"])):
        rows = corpus(seed, 50, words)
        assert got(spark, rows) == brute(rows, suffix.LENGTH)


def test_small_slices_and_chunks(spark, monkeypatch):
    rows = corpus(4, 40, [f"w{i}" for i in range(200)])
    for name, value in (("SLICE", 700), ("CHUNK", 1500), ("BATCH", 16)):
        monkeypatch.setattr(suffix, name, value)
    s = suffix.Segments([t.encode() for _, t in rows if t])
    assert sum(s.size) == sum(max(0, len(t.encode()) - 99) for _, t in rows if t)
    assert got(spark, rows) == brute(rows, suffix.LENGTH)


def test_repeated_rows_null_ids_empty_table(spark):
    long = " ".join(map(str, range(200)))
    rows = [(1, long), (1, long), (None, long), (2, long + "!"), (2, "short")]
    assert got(spark, rows) == brute(rows, suffix.LENGTH)
    assert got(spark, []) == []


def test_levels():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 3000, 9000, dtype=np.uint64)
    levels, seen = suffix.Levels(), set()
    want = []
    for k in keys.tolist():
        want.append(k not in seen)
        seen.add(k)
    got = np.concatenate([levels.first_of(part) for part in np.array_split(keys, 40)])
    assert got.tolist() == want
    sizes = [len(x) for x in levels.levels]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 13 and sum(sizes) == len(seen)
