"""The score report sink (JSON; the nested layout of ``score_report(nested=True)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_scores(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)  # one row by construction
