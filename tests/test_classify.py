"""Golden vector T8 and the edge cases of the two-cluster split."""

import random

import pytest

from snapdiff.operators.classify import classify, lloyd_two, split_scores


def scores(spark, rows):
    return spark.createDataFrame(rows, "node_id long, score double")


T8 = [(10, 0.2), (11, 0.3), (2, 0.6), (3, 0.25)]


def as_sets(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["change_type"], set()).add(r["node_id"])
    return out


def test_two_seeds(spark):
    got = as_sets(split_scores(scores(spark, T8), "two_seeds"))
    assert got == {"Removed": {10}, "Modified": {11, 2, 3}}


def test_two_means(spark):
    got = as_sets(split_scores(scores(spark, T8), "two_means"))
    assert got == {"Removed": {10, 11, 3}, "Modified": {2}}


def test_edge_cases(spark):
    assert split_scores(scores(spark, []), "two_means").count() == 0
    one = as_sets(split_scores(scores(spark, [(1, 0.1), (2, 0.1)]), "two_means"))
    assert one == {"Modified": {1, 2}}
    assert as_sets(split_scores(scores(spark, [(1, 0.1)]), "two_seeds")) == {"Modified": {1}}


def plain_lloyd(values):
    """Rounds one after another; the number of rounds and the two means."""
    lo, hi, rounds = min(values), max(values), 0
    while True:
        low = [v for v in values if abs(v - hi) - abs(v - lo) > 2.0**-30 * (hi - lo)]
        high = [v for v in values if not abs(v - hi) - abs(v - lo) > 2.0**-30 * (hi - lo)]
        new = sum(low) / len(low), sum(high) / len(high)
        rounds += 1
        if abs(new[0] - lo) + abs(new[1] - hi) < 1e-11:
            return rounds, new
        lo, hi = new


def value_sets():
    rng = random.Random(9)
    yield [0.1] * 50 + [0.9]
    yield [0.25, 0.5, 0.75]
    yield [0.0, 0.5, 1.0, 1.0]
    yield [k / 8 for k in range(9) for _ in range(rng.randrange(1, 5))]
    yield [rng.random() ** 6 for _ in range(3000)]  # the cut falls for many rounds
    yield [1 - rng.random() ** 6 for _ in range(3000)]  # and rises
    yield [rng.gauss(rng.choice([0.1, 0.2, 0.7]), 0.02) for _ in range(2000)]
    yield [1e-13 * rng.randrange(1, 9) for _ in range(40)]
    yield [0.4] * 30_000 + [0.4000001, 0.5]


@pytest.mark.parametrize("values", list(value_sets()))
def test_two_means_against_rounds(spark, values):
    got = lloyd_two(scores(spark, list(enumerate(values)) + [(-1, None)]))
    assert got == pytest.approx(plain_lloyd(values)[1], rel=1e-9)


def test_two_means_takes_no_job_for_a_round(spark):
    rng = random.Random(5)
    quick = [rng.choice([0.1, 0.9]) + rng.random() / 50 for _ in range(2000)]
    slow = [rng.random() ** 8 for _ in range(2000)]
    assert plain_lloyd(quick)[0] + 5 < plain_lloyd(slow)[0]
    jobs = []
    for i, values in enumerate([quick, slow]):
        spark.sparkContext.setJobGroup(f"two-means-{i}", "")
        lloyd_two(scores(spark, list(enumerate(values))))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"two-means-{i}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_classify_added_excludes_modified(spark):
    m = spark.createDataFrame(
        [("original", 1, None, 0.0), ("original", 2, 7, 0.5), ("original", 3, 8, 1.0),
         ("perturbed", 2, 9, 0.1), ("perturbed", 5, None, 0.0), ("perturbed", 6, 1, 1.0)],
        "side string, node_id long, match_id long, score double",
    )
    got = as_sets(classify(m))
    assert got == {"Removed": {1}, "Modified": {2}, "Added": {5}}
