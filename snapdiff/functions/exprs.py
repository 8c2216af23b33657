"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Side labels used in match keys (`original_7`, `perturbed_12`).
ORIGINAL = "original"
PERTURBED = "perturbed"

# Reported scores have this many decimals. Comparisons never use them: an
# absolute rounding would turn the small scores of hubs into zeros.
SCORE_DP = 12


def score_round(c: Column | str) -> Column:
    """For output only."""
    return F.round(F.col(c) if isinstance(c, str) else c, SCORE_DP)


def score_shown(c: Column | str) -> Column:
    """A score as results carry it: 12 decimals, but small ones (hubs) in full, so that a
    match never shows a score of zero."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x >= 1e-6, F.round(x, SCORE_DP)).otherwise(x)


def score_key(c: Column | str) -> Column:
    """A double rounded to its 40 leading bits, whatever its size, so that noise in
    the last bits does not decide a tie or a cluster boundary."""
    x = F.col(c) if isinstance(c, str) else c
    high = x * F.lit(float(2**13 + 1))
    return high - (high - x)


def half_up(c: Column | str, dp: int = 4) -> Column:
    """Decimal HALF_UP rounding of a double (Spark's ``round``)."""
    return F.round(F.col(c) if isinstance(c, str) else c, dp)


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den, or 0.0 when the denominator is zero (ANSI-safe)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def match_key(side: Column, node_id: Column) -> Column:
    """Text key `{side}_{id}`."""
    return F.concat_ws("_", side, node_id.cast("string"))


def match_value(match_id: Column, score: Column) -> Column:
    """Text value `{match}_{score}`; a missing match is written as -1 so the
    value always has two parts."""
    return F.concat_ws("_", F.coalesce(match_id, F.lit(-1)).cast("string"), score.cast("string"))


def skip_counts(good: Column, reasons: dict[str, Column]) -> list[Column]:
    """Counts for ``DataFrame.observe`` in a lenient scan: lines ``read`` and ``kept``, and
    under each reason's name the skipped lines that it is the first to hold for."""
    out = [F.count(F.lit(1)).alias("read"), F.count_if(F.coalesce(good, F.lit(False))).alias("kept")]
    left = ~F.coalesce(good, F.lit(False))
    for name, reason in reasons.items():
        held = F.coalesce(reason, F.lit(False))
        out.append(F.count_if(left & held).alias(name))
        left = left & ~held
    return out
