"""Near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from snapdiff.llm import near

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Rows (id, text) -> {id: least id reachable}."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    index = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(k)
    seen = set()
    for members in index.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    (ia, sa), (ib, sb) = sets[a], sets[b]
                    if 100 * len(sa & sb) >= 75 * len(sa | sb):
                        x, y = find(ia), find(ib)
                        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def check(spark, rows):
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = sorted(r["n_shingles"] for r in got)
    assert sizes == sorted(len(shingles(t)) for _, t in rows)


def mutated(rng, words, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words)


def test_groups_of_variants(spark):
    rng = random.Random(5)
    rows, n = [], 100
    for size, share, length in ((40, 0.01, 200), (30, 0.03, 120), (6, 0.02, 30), (25, 0.05, 60)):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        for _ in range(size):
            rows.append((n, mutated(rng, base, share)))
            n += 1
    shared = " ".join(f"s{i}" for i in range(40))
    for _ in range(40):
        rows.append((n, shared + " " + " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60)))))
        n += 1
    rows += [(i, "A same Text") for i in (7, 3, 50)] + [(8, "a SAME text"), (9, "a same text b")]
    rng.shuffle(rows)
    check(spark, rows)


def test_nulls_empty_long_repeated(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"),
            (5, "a b c d e f"), (6, long), (2, long + " end"), (10, "One"), (11, "one"), (12, "one two")]
    check(spark, rows)


def test_one_id_two_texts(spark):
    rows = [(5, "a b c d e f g"), (5, "k l m n o p q"), (3, "a b c d e f g"), (9, "k l m n o p q")]
    check(spark, rows)


def test_empty_table(spark):
    assert near.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_drop_keeps_columns_and_one_of_each(spark):
    df = spark.createDataFrame([(2, "a b c", "x", 1), (1, "a b c", "y", 2), (1, "a b c", "z", 3), (3, None, "n", 4), (None, "a b c", "q", 5)],
                               "doc_id long, text string, component_id string, kept long")
    out = near.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 1), (False, 3), (True, 0)]


def test_estimate_is_close():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:2400], rng.integers(0, 2**63, 600, dtype=np.uint64)]))
    regs = near.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    guess = near.estimate(regs[:1], regs[1:], np.array([float(len(a))]), np.array([float(len(b))]))[0][0]
    assert guess == pytest.approx(len(np.intersect1d(a, b)) / len(np.union1d(a, b)), abs=0.12)


def test_dense_group_near_the_threshold(spark):
    """Variants whose similarities scatter around 0.75: some linked, some not, nearly all plausible."""
    rng = random.Random(21)
    base = [f"w{rng.randrange(5000)}" for _ in range(140)]
    rows = [(1000 - i, mutated(rng, base, rng.choice([0.012, 0.018, 0.024]))) for i in range(70)]
    want = brute(rows)
    assert 2 < len(set(want.values())) < 70
    check(spark, rows)
