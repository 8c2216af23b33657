"""Hard negatives against a plain sort of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapdiff.llm import negatives


def brute(rows, is_anchor, positives=5, n=5, low=80):
    ok = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in ok or (label, v) < ok[i]:
            ok[i] = (label, v)
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in ok.items()}
    out = []
    for a in filter(is_anchor, whole):
        label, v = whole[a]
        near = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in whole.items() if i != a and len(w) == len(v))
        for p, i, _ in [t for t in near if t[2] == label][:positives]:
            hits = [(s, j) for s, j, other in near if other != label and low * -p <= 100 * -s <= 100 * -p][:n]
            out += [(a, i, k + 1, j, -p, -s) for k, (s, j) in enumerate(hits)]
    return sorted(out)


def vectors():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        v = [rng.choice([0.0, 0.25, -0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(6)]
        rows.append((i, rng.choice([0, 0, 0, 1, 2]), v))
    same = [0.5] * 6
    rows += [(1000 + i, i % 2, same) for i in range(60)]  # one vector many times, ties by id
    rows += [(2000, 1, None), (2001, None, same), (None, 1, same), (2002, 1, [None] * 6), (2003, 1, [float("nan")] * 6),
             (2004, 1, [float("inf")] * 6), (2100, 1, [0.5] * 5), (2101, 0, [0.5] * 5), (2102, 1, [0.5] * 5), (2110, 0, []), (2111, 0, []),
             (20, 1, [0.1] * 6), (-10, 1, same), rows[5], rows[5]]
    return rows


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 37)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"row": F.lit("x"), "key": F.lit(1)}).repartition(5)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("row") % 10 == 0).collect())
    rounded = [(i, label, v and [x if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]
    expected = brute(rounded, lambda i: i % 10 == 0)
    assert len(expected) > 300 and got == expected
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("row") % 10 == 0, positives=2, negatives=60, low=1).collect())
    assert got == brute(rounded, lambda i: i % 10 == 0, 2, 60, 1)


def test_keys_sort_as_their_parts():
    rng = random.Random(1)
    parts = [(rng.choice([-5, 0, 7, 2**62]), rng.choice([-9, -1, 0, 3, 2**61]), rng.randrange(2), rng.choice([-3, 0, 4])) for _ in range(500)]
    keys = [negatives.pack(np.array([a]), np.array([s]), k, np.array([r]))[0] for a, s, k, r in parts]
    assert list(negatives.unpack(keys)) == parts
    assert list(negatives.unpack(sorted(keys))) == sorted(parts, key=lambda t: (t[0], -t[1], t[2], t[3]))


def test_large_components_are_exact():
    a = np.array([[2.0**29, 3.0, -(2.0**29)], [2.0**31, 1.0, 1.0]])
    assert negatives.inner_products(a, a).tolist() == [[int(sum(int(x) * int(y) for x, y in zip(u, v))) for v in a] for u in a]
    with pytest.raises(ValueError):
        negatives.inner_products(np.array([[2.0**40]]), np.array([[2.0**40]]))


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(df, F.col("row") % 10 == 0).count() == 0
    one = spark.createDataFrame([(1, 1, [0.5])], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(one, F.col("row") % 10 == 0).count() == 0
