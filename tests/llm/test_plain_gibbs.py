"""Pairs' predictions against a Gibbs sampler that moves one customer at a time."""

import random

import numpy as np
import pytest

from snapdiff.llm import pitman_yor as M

DISCOUNT = 0.5


def pairs():
    """200 tokens of five words after four contexts."""
    rng = random.Random(2)
    words = [(rng.randrange(4), min(rng.randrange(5), rng.randrange(5))) for _ in range(200)]
    keys = sorted(set(words))
    return np.array([c for c, _ in keys]), np.array([w for _, w in keys]), np.array([words.count(k) for k in keys])


def plain(context, customers, parent, sweeps, rng):
    """Mean tables of each pair: a customer leaves its table and sits down anew, at a table
    of its word or a new one."""
    seats = [[1] * int(c) for c in customers]
    mean = np.zeros(len(customers))
    for turn in range(sweeps):
        for i, c in enumerate(customers):
            for _ in range(int(c)):
                t = seats[i]
                j = rng.choices(range(len(t)), t)[0]
                t[j] -= 1
                if not t[j]:
                    t.pop(j)
                total = sum(len(seats[k]) for k in np.flatnonzero(context == context[i]))
                weight = [x - DISCOUNT for x in t] + [(M.PAIR_STRENGTH + DISCOUNT * total) * parent[i]]
                j = rng.choices(range(len(weight)), weight)[0]
                if j == len(t):
                    t.append(1)
                else:
                    t[j] += 1
        if turn >= sweeps // 5:
            mean += np.array([len(t) for t in seats]) / (sweeps - sweeps // 5)
    return mean


def test_predictions_match_a_plain_sampler():
    context, word, customers = pairs()
    parent = np.array([0.3, 0.25, 0.2, 0.15, 0.1])[word]
    guests = np.bincount(context, customers)[context]

    def score(keep, left):
        p = (keep + (M.PAIR_STRENGTH + np.bincount(context, left)[context]) * parent) / (M.PAIR_STRENGTH + guests)
        return (customers * np.log10(p)).sum() / customers.sum()

    want = [plain(context, customers, parent, 150, random.Random(s)) for s in range(4)]
    want = np.array([score(customers - DISCOUNT * m, DISCOUNT * m) for m in want])
    got = []
    for seed in range(60):
        keep, left, _ = M.pair_sweeps(context, customers, parent, np.ones(len(customers), np.int64), seed, DISCOUNT)
        got.append(score(keep, left))
    got = np.array(got)
    # a dish's customers seated anew in turn are not an exact block of the sampler: measured
    # -0.64479 against -0.64428 a token (standard error 0.00002)
    assert got.mean() == pytest.approx(want.mean(), abs=0.001)
