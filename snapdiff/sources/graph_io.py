"""Node / edge scans, the mixed component table, node counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdiff import schemas


def _reader(spark: SparkSession, fmt: str, schema):
    r = spark.read.format(fmt)
    # self-describing formats keep their own types; text formats get ours
    return r if fmt in ("parquet", "orc") else r.schema(schema)


def read_nodes(spark: SparkSession, path: str, fmt: str = "parquet", id_col: str = "node_id", value_col: str = "stored_value") -> DataFrame:
    """``(node_id BIGINT, stored_value STRING)``; any value type is rendered as text."""
    df = _reader(spark, fmt, schemas.NODES).load(path)
    return df.select(F.col(id_col).cast("long").alias("node_id"), F.col(value_col).cast("string").alias("stored_value"))


def read_edges(spark: SparkSession, path: str, fmt: str = "parquet", src_col: str = "src", dst_col: str = "dst") -> DataFrame:
    """Endpoints only, ``(src BIGINT, dst BIGINT)``; any edge payload is ignored."""
    df = _reader(spark, fmt, schemas.EDGES).load(path)
    return df.select(F.col(src_col).cast("long").alias("src"), F.col(dst_col).cast("long").alias("dst"))


def split_components(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: one tagged component table -> (nodes, edges); other kinds are dropped."""
    nodes = df.where(F.col("kind") == "node").select(
        F.col("node_id").cast("long").alias("node_id"), F.col("stored_value").cast("string").alias("stored_value")
    )
    edges = df.where(F.col("kind") == "edge").select(
        F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")
    )
    return nodes, edges


def stack_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Inverse of :func:`split_components` (one heterogeneous table)."""
    return nodes.select(
        F.lit("node").alias("kind"),
        "node_id",
        "stored_value",
        F.lit(None).cast("long").alias("src"),
        F.lit(None).cast("long").alias("dst"),
    ).unionByName(
        edges.select(
            F.lit("edge").alias("kind"),
            F.lit(None).cast("long").alias("node_id"),
            F.lit(None).cast("string").alias("stored_value"),
            "src",
            "dst",
        )
    )


def node_counts(nodes_o: DataFrame, nodes_p: DataFrame) -> DataFrame:
    """One row ``(n_original, n_perturbed)`` over all nodes, isolated included."""
    tagged = nodes_o.select(F.lit(1).alias("o"), F.lit(0).alias("p")).unionByName(
        nodes_p.select(F.lit(0).alias("o"), F.lit(1).alias("p"))
    )
    return tagged.agg(
        F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("n_original"),
        F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("n_perturbed"),
    )


def node_count_values(nodes_o: DataFrame, nodes_p: DataFrame) -> tuple[int, int]:
    """The two counts as scalars (one aggregate job)."""
    row = node_counts(nodes_o, nodes_p).first()
    return int(row["n_original"]), int(row["n_perturbed"])
