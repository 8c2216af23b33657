"""The match table and its text form ``original_7<TAB>12_0.315``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapdiff import schemas
from snapdiff.functions.exprs import match_key, match_value, skip_counts


def encode_matches(matches: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``(key, value)`` text columns (plus ``keep``); a missing match is written as -1."""
    return matches.select(
        *(keep or []),
        match_key(F.col("side"), F.col("node_id")).alias("key"),
        match_value(F.col("match_id"), F.col("score")).alias("value"),
    )


def _two_parts(arr: F.Column) -> F.Column:
    return (F.size(arr) == 2) & (F.length(F.get(arr, F.lit(0))) > 0) & (F.length(F.get(arr, F.lit(1))) > 0)


def decode_matches(lines: DataFrame, col: str = "value", report: Observation | None = None) -> DataFrame:
    """P2/S6, lenient: a line needs exactly one tab, and each half exactly one
    underscore with both parts non-empty and numeric; anything else is
    skipped. -1 as the match id decodes to NULL (no positive candidate).

    ``report`` observes how many lines were ``read``, ``kept`` and skipped: ``no_tab`` (not
    two halves), ``bad_key``, ``bad_value`` (a half without two parts), ``no_number``."""
    halves = F.split(F.col(col), "\t", -1)
    parsed = lines.select(halves.alias("h")).select(
        _two_parts(F.col("h")).alias("tab"), F.split(F.get("h", F.lit(0)), "_", -1).alias("k"), F.split(F.get("h", F.lit(1)), "_", -1).alias("v"))
    typed = parsed.select(
        "tab",
        _two_parts(F.col("k")).alias("key"),
        _two_parts(F.col("v")).alias("val"),
        F.get("k", F.lit(0)).alias("side"),
        F.get("k", F.lit(1)).try_cast("long").alias("node_id"),
        F.get("v", F.lit(0)).try_cast("long").alias("match_id"),
        F.get("v", F.lit(1)).try_cast("double").alias("score"),
    )
    number = F.col("node_id").isNotNull() & F.col("match_id").isNotNull() & F.col("score").isNotNull()
    good = F.col("tab") & F.col("key") & F.col("val") & number
    if report is not None:
        typed = typed.observe(report, *skip_counts(good, {
            "no_tab": ~F.coalesce("tab", F.lit(False)), "bad_key": ~F.coalesce("key", F.lit(False)),
            "bad_value": ~F.coalesce("val", F.lit(False)), "no_number": ~number}))
    return typed.where(good).select(
        "side", "node_id", F.when(F.col("match_id") != -1, F.col("match_id")).alias("match_id"), "score"
    )


def write_matches(matches: DataFrame, path: str, text: bool = False, ordered: bool = True) -> None:
    """Typed parquet, or the tab-separated text form (``text=True``).

    ``ordered`` sorts the text form by key in byte order with a distributed
    range-partitioned sort: the part files, read in name order, are one
    key-ordered sequence (what a single sorted output file would hold)."""
    if text:
        enc = encode_matches(matches)
        if ordered:
            enc = enc.orderBy("key")
        enc.select(F.concat_ws("\t", "key", "value").alias("value")).write.mode("overwrite").text(path)
    else:
        matches.select(*[f.name for f in schemas.MATCHES.fields]).write.mode("overwrite").parquet(path)


def read_matches(spark: SparkSession, path: str, text: bool = False, report: Observation | None = None) -> DataFrame:
    """Typed parquet, or the text form (``report``: see :func:`decode_matches`)."""
    if text:
        return decode_matches(spark.read.text(path), report=report)
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in schemas.MATCHES.fields])
