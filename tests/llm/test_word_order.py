"""Scores follow the order of words; the restaurants of contexts sum to one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdiff.llm import pitman_yor as M


def rows():
    """Texts in which each word has few followers."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    after = {w: rng.sample(vocabulary, 3) for w in vocabulary}
    out = []
    for i in range(400):
        text = [rng.choice(vocabulary)]
        while len(text) < 40:
            text.append(rng.choice(after[text[-1]]))
        out.append((2 * i + 2, " ".join(text)))
    held = []
    for i in range(20):
        words = out[-1 - i][1].split()
        rng.shuffle(words)
        held.append((2 * i + 1, " ".join(words)))
    return out[:-20], out[-20:], held


def scores(spark, n):
    learned, kept, mixed = rows()
    told = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        data = [(i, t, True) for i, t in learned] + [(i, t, False) for i, t in kept + mixed]
        data += [(10_000 + i, "", True) for i in range(3000)]
        df = spark.createDataFrame(data, "doc_id long, text string, learn boolean")
        got = {r["doc_id"]: r for r in M.score_texts(df, F.col("learn")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", told)
    assert [got[i]["n_known"] for i, _ in kept] == [41] * 20
    return [np.array([got[i]["score"] / got[i]["n_tokens"] for i, _ in x]) for x in (kept, mixed)]


def test_order_of_words_counts(spark):
    right, wrong = scores(spark, 4)
    assert right.mean() > wrong.mean() + 0.5
    # three followers each: near a third a word, where words alone give a sixtieth
    assert right.mean() == pytest.approx(np.log10(1 / 3), abs=0.15)
    # the end token stands before so many tokens that its pairs are dealt over 32 buckets
    assert M.is_hot(np.array([3380]), 380 * 41 + 3000, 32).all() and not M.is_hot(np.array([3380]), 380 * 41 + 3000, 4).any()
    dealt_right, dealt_wrong = scores(spark, 32)
    # (one discount for all buckets: only the seatings differ)
    assert dealt_right == pytest.approx(right, abs=0.02) and dealt_right.mean() > dealt_wrong.mean() + 0.5


def test_restaurants_sum_to_one():
    rng = np.random.Generator(np.random.PCG64(4))
    previous = np.repeat(np.arange(50, dtype=np.uint64), 20)
    customers = rng.integers(0, 6, 1000) ** 3
    parent = np.tile(np.full(20, 1 / 20), 50)
    keep, left, tables = M.pair_sweeps(previous, customers, parent, np.ones(1000, np.int64), 1)
    assert ((tables > 0) == (customers > 0)).all() and (tables <= customers).all()
    total = customers.reshape(50, 20).sum(axis=1)
    own = keep.reshape(50, 20).sum(axis=1)
    reserve = left.reshape(50, 20).sum(axis=1)
    assert (own + M.PAIR_STRENGTH + reserve) / (M.PAIR_STRENGTH + total) == pytest.approx(np.ones(50))
