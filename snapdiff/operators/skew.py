"""Equi-joins whose output can be quadratic inside one key group.

Value-equal neighbour pairs (and the neighbour pairs of a hub) are all
needed, so nothing may be dropped; but a single hot key must not land in
one task. ``salted_join`` counts rows per key on both sides, and every key
whose pair count exceeds ``pairs_per_task`` is spread over an s_l x s_r grid
of salts: left rows pick a row of the grid by hash and are copied across
its columns, right rows pick a column and are copied down its rows, so each
(left, right) pair meets in exactly one cell.

The hot-key table holds at most (output pairs / pairs_per_task) rows; its
row count is checked before it is broadcast, otherwise it is shuffle-joined.
Only where there are such keys is the join repartitioned explicitly on (key,
salt): it explodes, and keeps ``spark.sql.shuffle.partitions`` tasks even when
its inputs are small enough for adaptive coalescing to squeeze them into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdiff.session import cut_lineage

# Output pairs one task should produce for a single key.
PAIRS_PER_TASK = 2_000_000
# The hot-key table is broadcast only below this many rows (a few MB).
BROADCAST_MAX_ROWS = 200_000


def _grid(nl: F.Column, nr: F.Column, budget: int) -> tuple[F.Column, F.Column]:
    cells = F.ceil(nl.cast("double") * nr.cast("double") / F.lit(float(budget)))
    s_l = F.least(F.ceil(F.sqrt(cells)), nl).cast("int")
    s_r = F.least(F.ceil(cells / s_l), nr).cast("int")
    return s_l, s_r


def hot_keys(left: DataFrame, right: DataFrame, on: list[str], pairs_per_task: int | None = None) -> DataFrame:
    """``(*on, _sl, _sr)`` for every key whose pair count exceeds the budget."""
    pairs_per_task = pairs_per_task or PAIRS_PER_TASK
    lc = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_nl"))
    rc = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_nr"))
    # pair counts in double: two sides of ~3e9 rows would overflow a long
    pairs = F.col("_nl").cast("double") * F.col("_nr").cast("double")
    both = lc.join(rc, on).where(pairs > F.lit(float(pairs_per_task)))
    s_l, s_r = _grid(F.col("_nl"), F.col("_nr"), pairs_per_task)
    return both.select(*on, s_l.alias("_sl"), s_r.alias("_sr"), pairs.alias("_pairs"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: list[str],
    right_id: list[str],
    pairs_per_task: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join of ``left`` and ``right`` on ``on``; ``left_id`` / ``right_id``
    are columns that spread a side's rows of one key over salts. ``hot`` may
    pass a precomputed :func:`hot_keys` table."""
    spark = left.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        hot = cut_lineage(hot_keys(left, right, on, pairs_per_task))  # counted and joined
    n_hot = hot.count()
    if n_hot == 0:
        return left.join(right, on)  # no key is large: the planner picks the width
    grid = F.broadcast(hot) if n_hot <= BROADCAST_MAX_ROWS else hot
    one = F.lit(1)
    lg = left.join(grid, on, "left").select(
        "*", F.coalesce("_sl", one).alias("_l"), F.coalesce("_sr", one).alias("_r")
    )
    ls = lg.select(
        *left.columns,
        F.pmod(F.xxhash64(*left_id), F.col("_l").cast("long")).alias("_i"),
        F.col("_r"),
        F.explode(F.sequence(F.lit(0), F.col("_r") - 1)).alias("_j"),
    ).select(*left.columns, (F.col("_i") * F.col("_r") + F.col("_j")).alias("_salt"))
    rg = right.join(grid, on, "left").select(
        "*", F.coalesce("_sl", one).alias("_l"), F.coalesce("_sr", one).alias("_r")
    )
    rs = rg.select(
        *right.columns,
        F.pmod(F.xxhash64(*right_id), F.col("_r").cast("long")).alias("_j"),
        F.col("_r"),
        F.explode(F.sequence(F.lit(0), F.col("_l") - 1)).alias("_i"),
    ).select(*right.columns, (F.col("_i") * F.col("_r") + F.col("_j")).alias("_salt"))
    keys = [*on, "_salt"]
    return ls.repartition(n, *keys).join(rs.repartition(n, *keys), keys).drop("_salt")
