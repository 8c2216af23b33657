"""Turn best matches into predicted changes (Modified / Removed / Added).

Original-side nodes whose best score is below one are split in two clusters
by score: the low cluster is Removed, the high one Modified. Perturbed-side
nodes below one, minus the Modified ids, are Added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.functions.exprs import ORIGINAL, match_key, score_key
from snapdiff.session import cut_lineage

MODIFIED, REMOVED, ADDED = "Modified", "Removed", "Added"


#: Distances that differ by less than this share of the gap between the centres are a tie.
TIE = 2.0**-30


def _nearer(lo: float | F.Column, hi: float | F.Column, s: F.Column | None = None) -> F.Column:
    """Strictly nearer to ``lo``. What counts as a tie is relative to the gap, so float
    noise cannot break one and small scores are told apart like large ones."""
    s, lo, hi = F.col("score") if s is None else s, F.lit(lo), F.lit(hi)
    return F.abs(s - hi) - F.abs(s - lo) > F.lit(TIE) * (hi - lo)


def _label(scores: DataFrame, lo: float, hi: float) -> DataFrame:
    """Strictly nearer to ``lo`` -> Removed, otherwise Modified (ties go high)."""
    return scores.select(
        "node_id", F.when(_nearer(lo, hi), F.lit(REMOVED)).otherwise(F.lit(MODIFIED)).alias("change_type")
    )


def seeds_two(scores: DataFrame) -> list[float]:
    """The first two distinct scores in text-key order
    (``original_10`` sorts before ``original_2``). Top-2 of a per-score
    aggregate: the output is bounded by construction."""
    firsts = scores.groupBy(score_key("score")).agg(
        F.min("score").alias("score"), F.min(match_key(F.lit(ORIGINAL), F.col("node_id"))).alias("first_key")
    )
    return [r["score"] for r in firsts.orderBy("first_key").limit(2).collect()]


def _cuts(scores: DataFrame) -> DataFrame:
    """One row for each distinct score: ``score, above`` (the next one), the means ``lo`` and
    ``hi`` of the rows up to the score and beyond it, and the extremes ``least, most``.

    A scan without a single-task window: the per-score counts are partitioned
    by range, each partition adds up its own from both ends, and what lies
    before and after a partition comes from a table of one row a partition."""
    n_parts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hist = scores.where(F.col("score").isNotNull()).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    hist = cut_lineage(hist.repartitionByRange(n_parts, "score").withColumn("pid", F.spark_partition_id()))
    mass = F.col("score") * F.col("n")
    parts = hist.groupBy("pid").agg(
        F.min("score").alias("first"), F.max("score").alias("last"), F.sum("n").alias("n_part"), F.sum(mass).alias("m_part"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.desc("pid")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = parts.select(
        "pid",
        *[F.coalesce(F.sum(f"{c}_part").over(w), F.lit(0)).alias(f"{c}_{name}")
          for c in ("n", "m") for w, name in ((before, "before"), (after, "after"))],
        F.lead("first").over(Window.orderBy("pid")).alias("next_first"),
        F.min("first").over(whole).alias("least"), F.max("last").over(whole).alias("most"),
    )
    up = Window.partitionBy("pid").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    falling = Window.partitionBy("pid").orderBy(F.desc("score"))
    beyond = falling.rowsBetween(Window.unboundedPreceding, -1)
    own = hist.select(
        "pid", "score", F.lag("score").over(falling).alias("above"),
        F.sum("n").over(up).alias("n_up"), F.sum(mass).over(up).alias("m_up"),
        F.coalesce(F.sum("n").over(beyond), F.lit(0)).alias("n_on"), F.coalesce(F.sum(mass).over(beyond), F.lit(0.0)).alias("m_on"),
    ).join(F.broadcast(offsets), "pid")
    return own.select(
        "score", F.coalesce("above", "next_first").alias("above"), "least", "most",
        ((F.col("m_before") + F.col("m_up")) / (F.col("n_before") + F.col("n_up"))).alias("lo"),
        F.try_divide(F.col("m_after") + F.col("m_on"), F.col("n_after") + F.col("n_on")).alias("hi"),
    ).select("score", "above", "least", "most", score_key("lo").alias("lo"), score_key("hi").alias("hi"))


def lloyd_two(scores: DataFrame) -> tuple[float, float] | None:
    """1-D two-means (Lloyd) from the extreme scores, without a job for each round.

    A round cuts the sorted scores somewhere and moves the cut to the middle of
    the two means, which only rises as the cut rises. So the cuts of the rounds
    all go one way from the first one and end at the nearest cut on that side
    that a round leaves where it is. The means at every cut are one scan
    (:func:`_cuts`), and the end is one aggregate over it."""
    rises = F.coalesce(_nearer(F.col("lo"), F.col("hi"), F.col("above")), F.lit(False))
    stays = F.coalesce(_nearer(F.col("lo"), F.col("hi")) & ~rises, F.lit(False))
    at_first = _nearer(F.col("least"), F.col("most"))
    cut = F.struct("score", "lo", "hi", stays.alias("stays"), rises.alias("rises"))
    row = _cuts(scores).agg(
        F.max("least").alias("least"), F.max("most").alias("most"),
        F.max(F.when(at_first, cut)).alias("start"),
        F.min(F.when(stays & ~at_first, cut)).alias("up"), F.max(F.when(stays & at_first, cut)).alias("down"),
    ).first()
    if row["least"] is None or row["most"] - row["least"] <= TIE * abs(row["most"]):  # one score, but for noise
        return None
    start = row["start"]
    end = start if start["stays"] else row["up"] if start["rises"] else row["down"]
    if end is None:
        raise ArithmeticError("two-means found no cut that stays: scores are not finite")
    return end["lo"], end["hi"]


def split_scores(scores: DataFrame, method: str = "two_means") -> DataFrame:
    """``scores(node_id, score)`` -> ``(node_id, change_type)``.

    ``two_means``: true 1-D two-means from (min, max), the documented intent.
    ``two_seeds``: a threshold midway between the first two distinct scores
    in text-key order, which is what the original code computes.
    One distinct score -> all Modified; no rows -> no rows."""
    scores = scores.select("node_id", "score")
    if method == "two_means":
        centroids = lloyd_two(scores)
    elif method == "two_seeds":
        seeds = seeds_two(scores)
        centroids = (min(seeds), max(seeds)) if len(seeds) == 2 else None
    else:
        raise ValueError(f"unknown split method {method!r}")
    if centroids is None:
        return scores.select("node_id", F.lit(MODIFIED).alias("change_type"))
    return _label(scores, *centroids)


def classify(matches: DataFrame, method: str = "two_means") -> DataFrame:
    """Matches -> ``changes(change_type, node_id)``."""
    below = matches.where(F.col("score") < 1)
    orig = below.where(F.col("side") == ORIGINAL).select("node_id", "score")
    split = cut_lineage(split_scores(orig, method))
    modified = split.where(F.col("change_type") == MODIFIED).select("node_id")
    added = (
        below.where(F.col("side") != ORIGINAL)
        .select("node_id")
        .distinct()
        .join(modified, "node_id", "left_anti")
        .select(F.lit(ADDED).alias("change_type"), "node_id")
    )
    return split.select("change_type", "node_id").unionByName(added)


__all__ = ["ADDED", "MODIFIED", "REMOVED", "classify", "split_scores", "seeds_two", "lloyd_two"]
