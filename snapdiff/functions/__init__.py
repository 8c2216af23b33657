"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from snapdiff.functions.exprs import (
    ORIGINAL,
    PERTURBED,
    SCORE_DP,
    guarded_ratio,
    half_up,
    match_key,
    match_value,
    score_key,
    score_round,
)

__all__ = [
    "ORIGINAL",
    "PERTURBED",
    "SCORE_DP",
    "guarded_ratio",
    "half_up",
    "match_key",
    "match_value",
    "score_key",
    "score_round",
]
