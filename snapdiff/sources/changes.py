"""True / predicted changes, flat or as nested documents.

Nested form, one JSON document per line (tabs are tolerated and cleaned):
``{"Nodes": {"Modified": [ids], "Removed": [ids], "Added": {"key": id, ...}}}``.
For Added only the map values are ids. A file may hold many such documents;
their rows are unioned, so a large truth set is split over many bounded lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdiff import schemas

# A written document holds at most this many ids per change type.
DOC_CHUNK = 1024


def flatten_change_docs(lines: DataFrame, col: str = "value") -> DataFrame:
    """Text lines -> ``changes(change_type, node_id)``; malformed lines drop out."""
    cleaned = F.regexp_replace(F.col(col), "\t", " ")  # P6
    doc = lines.select(F.from_json(cleaned, schemas.CHANGES_DOC).alias("d")).where(F.col("d.Nodes").isNotNull())
    nodes = doc.select("d.Nodes.*")
    modified = nodes.select(F.lit("Modified").alias("change_type"), F.explode("Modified").alias("node_id"))
    removed = nodes.select(F.lit("Removed").alias("change_type"), F.explode("Removed").alias("node_id"))
    added = nodes.select(F.lit("Added").alias("change_type"), F.explode(F.map_values("Added")).alias("node_id"))
    return modified.unionByName(removed).unionByName(added).where(F.col("node_id").isNotNull())


def read_changes(spark: SparkSession, path: str, nested: bool = True, fmt: str = "parquet") -> DataFrame:
    """Read changes from nested JSON documents (``nested=True``) or a flat table."""
    if nested:
        return flatten_change_docs(spark.read.text(path))
    df = spark.read.format(fmt).load(path) if fmt in ("parquet", "orc") else spark.read.format(fmt).schema(schemas.CHANGES).load(path)
    return df.select(F.col("change_type").cast("string"), F.col("node_id").cast("long"))


def change_docs(changes: DataFrame) -> DataFrame:
    """Flat changes -> nested documents, one per id block of DOC_CHUNK ids,
    so no line grows with the data. Changes are a set: repeated rows count once. Column ``value`` holds the JSON text."""
    block = F.floor(F.col("node_id") / DOC_CHUNK).alias("block")
    grouped = changes.select("change_type", "node_id").distinct().groupBy(block).agg(
        F.sort_array(F.collect_list(F.when(F.col("change_type") == "Modified", F.col("node_id")))).alias("Modified"),
        F.sort_array(F.collect_list(F.when(F.col("change_type") == "Removed", F.col("node_id")))).alias("Removed"),
        F.map_from_entries(
            F.collect_list(
                F.when(
                    F.col("change_type") == "Added",
                    F.struct(F.col("node_id").cast("string").alias("k"), F.col("node_id").alias("v")),
                )
            )
        ).alias("Added"),
    )
    doc = F.struct(F.struct("Modified", "Removed", "Added").alias("Nodes"))
    return grouped.select(F.to_json(doc).alias("value"))


def write_change_docs(changes: DataFrame, path: str) -> None:
    change_docs(changes).write.mode("overwrite").text(path)
