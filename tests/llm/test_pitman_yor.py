"""Token counts against a plain count; the model's probabilities sum to one and beat the unigrams."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdiff.llm import pitman_yor as M

WORD = re.compile("[^\x20\x09-\x0d]+")


def rows():
    """Texts over a small vocabulary with new words now and then (where no text brings
    a new word and words are independent, add-one counts are already the best model)."""
    rng = random.Random(6)
    syllables = ["an", "the", "or", "ing", "ti", "sh", "é", "re"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    out = [(1, None), (2, ""), (3, "One  one\tONE"), (4, "x" * 3000), (5, " ".join(rng.choice(vocabulary) for _ in range(30_000)))]
    fresh = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(4, 7)))
    word = lambda: rng.choice(vocabulary) if rng.random() < 0.9 else fresh()
    out += [(i, " ".join(word() for _ in range(rng.randrange(1, 80)))) for i in range(10, 120)]
    return out + [out[7], (None, "null id")]


def test_counts_and_scores(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = M.score_texts(df, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))).collect()
    assert len(got) == len(data)
    said = lambda t: WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]
    count = Counter(w for i, t in data if i is None or i % 3 != 0 for w in said(t))
    total, distinct = sum(count.values()), len(count)
    want = sorted((i if i is not None else -1, len(said(t)), sum(count[w] > 0 for w in said(t)),
                   round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in said(t)), 6)) for i, t in data)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {total}
    held = [r for r in got if r["doc_id"] and r["doc_id"] >= 10 and not r["training"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in got)


def test_probabilities_sum_to_one():
    texts = [t.encode() for _, t in rows() if t]
    keys, _ = M.spell([*{w for t in texts for w in t.split()}, b""])
    distinct, count = np.unique(keys, return_counts=True)
    contexts = [int(distinct[5]) >> 8, int(distinct[-1]) >> 8, int.from_bytes(b"zzzz", "big")]
    every = np.array([c << 8 | s for c in contexts for s in range(256)], np.uint64)
    merged, n = M._merged([(distinct, count), (every, np.zeros(len(every), np.int64))])
    first = np.full((256, 256), 1 / 256)
    for _ in range(2):
        _, dishes, sent = M.deep_sweeps(merged, n, first, 2, 0, 1)
        customers = np.zeros(1 << 16, np.int64)
        customers[dishes.astype(np.int64)] = sent
        first = M.shallow_sweeps(customers.reshape(256, 256), 3, 2)
        assert first.sum(axis=1) == pytest.approx(np.ones(256))
    p, _, _ = M.deep_sweeps(merged, n, first, 2, 3, 1)
    for c in contexts:
        assert p[merged >> np.uint64(8) == c].sum() == pytest.approx(1)


def test_seating_follows_the_process():
    """Mean tables of a dish against seating customers one by one."""
    rng = np.random.Generator(np.random.PCG64(1))
    c, p, others, s, d = 400, 0.3, 12.0, 1.0, 0.5
    got = M.seat(np.full(4000, c), np.full(4000, p), np.full(4000, others), s, d, lambda live, _: 1 - rng.random(len(live))).mean()
    total = 0
    for _ in range(1500):
        t = 1
        for n in range(1, c):
            w = (s + d * (others + t)) * p
            t += rng.random() < w / (n - d * t + w)
        total += t
    assert got == pytest.approx(total / 1500, rel=0.03)


def test_one_large_count_and_empty_table(spark):
    t = M.seat(np.array([0, 1, 50_000_000]), np.array([0.1, 0.1, 0.9]), np.array([0, 0, 40]), 1.0, 0.6,
               lambda live, step: np.random.Generator(np.random.PCG64(step)).random(len(live)) + 1e-12)
    assert t[0] == 0 and t[1] == 1 and 1 < t[2] < 50_000_000
    df = spark.createDataFrame([], "doc_id long, text string")
    assert M.score_texts(df, F.lit(True)).count() == 0
