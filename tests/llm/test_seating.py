"""Tables of large dishes against seating their customers one by one."""

import numpy as np
import pytest

from snapdiff.llm import pitman_yor as M


def one_by_one(c, p, others, d, times, rng):
    t = np.ones(times)
    for n in range(1, c):
        w = (1 + d * (others + t)) * p
        t += rng.random(times) < w / (n - d * t + w)
    return t


@pytest.mark.parametrize("c, p, others, d", [
    (400, 0.9, 12, 0.8), (4000, 0.3, 12, 0.5), (4000, 0.02, 2000, 0.5), (20000, 0.3, 12, 0.5), (20000, 0.9, 2000, 0.5)])
def test_mean_and_spread(c, p, others, d):
    rng = np.random.Generator(np.random.PCG64(8))
    want = one_by_one(c, p, others, d, 1500, rng)
    got = M.seat(np.full(1500, c), np.full(1500, p), np.full(1500, others), 1.0, d, lambda live, _: 1 - rng.random(len(live)))
    noise = np.sqrt((want.var() + got.var()) / 1500)
    assert abs(got.mean() - want.mean()) < 4 * noise
    assert got.std() == pytest.approx(want.std(), rel=0.12)


def test_binomial_numbers():
    u = (np.arange(20000) + 0.5) / 20000
    for n, c in ((3, 0.2), (50, 0.01), (50, 0.97), (4000, 0.002), (4000, 0.3)):
        x = M._binomial(u, np.full(len(u), float(n)), np.full(len(u), c))
        assert 0 <= x.min() and x.max() <= n
        assert x.mean() == pytest.approx(n * c, rel=0.01) and x.std() == pytest.approx(np.sqrt(n * c * (1 - c)), rel=0.05)
