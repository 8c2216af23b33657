"""Shard sink and scan.

Written form: folders ``side=.../part=...`` of JSON lines, one record per (node,
chunk of at most LIST_CHUNK neighbours) — a part is never one document, and
reading some parts opens no file of the others. The reader also
imports the legacy document form (one shard pair per line,
``{"originalGraph": {...}, "perturbedGraph": {...}}`` in files named
``..._{i}-{j}.json``) and explodes it back to rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapdiff import schemas
from snapdiff.functions.exprs import ORIGINAL, PERTURBED, skip_counts
from snapdiff.operators.graph import chunked_lists


def shard_records(shard_nodes: DataFrame, shard_adj: DataFrame, side: str) -> DataFrame:
    lists = chunked_lists(shard_adj.select("part", "src", "dst"), ["part", "src"], "dst").withColumnRenamed(
        "src", "node_id"
    )
    rec = shard_nodes.join(lists, ["part", "node_id"], "left")
    return rec.select(
        F.lit(side).alias("side"),
        F.col("part").cast("int").alias("part"),
        "node_id",
        "stored_value",
        "is_subject",
        F.coalesce("chunk", F.lit(0)).cast("int").alias("chunk"),
        F.coalesce("neighbors", F.array().cast("array<bigint>")).alias("neighbors"),
    )


def write_shards(shards_o: tuple[DataFrame, DataFrame], shards_p: tuple[DataFrame, DataFrame], path: str) -> None:
    """Both snapshots' shards as JSON lines under ``path``, a folder for each side and part.

    Rows are dealt by ranges of (side, part, node), so a task writes to few folders
    and a large part is many files."""
    recs = shard_records(*shards_o, ORIGINAL).unionByName(shard_records(*shards_p, PERTURBED))
    recs = recs.repartitionByRange("side", "part", "node_id").sortWithinPartitions("side", "part", "node_id", "chunk")
    recs.write.mode("overwrite").partitionBy("side", "part").json(path)


def _from_records(recs: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = recs.select("side", "part", "node_id", "stored_value", "is_subject").distinct()
    adj = recs.select("side", "part", F.col("node_id").alias("src"), F.explode("neighbors").alias("dst")).distinct()
    return nodes, adj


def read_shards(
    spark: SparkSession,
    path: str,
    nested: bool = False,
    parts: list[int] | None = None,
    side: str | None = None,
    report: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """-> ``shard_nodes(side, part, node_id, stored_value, is_subject)`` and
    ``shard_adj(side, part, src, dst)``.

    ``parts`` and ``side`` limit the scan to their folders (partition filters). Lines
    that do not decode are skipped; ``report`` observes how many lines were
    ``read``, ``kept`` and skipped as ``no_json`` or ``no_node`` once the nodes are computed."""
    lines = spark.read.text(path)
    if nested:
        return _from_documents(lines)
    stored = "part" in lines.columns and "side" in lines.columns
    own = ["side", "part"] if stored else []
    recs = lines.select(*own, F.from_json("value", schemas.SHARD_RECORD).alias("r"))
    recs = recs.select(
        *([F.col("side").cast("string"), F.col("part").cast("int")] if stored else ["r.side", "r.part"]),
        "r.node_id", "r.stored_value", "r.is_subject", "r.neighbors",
        F.coalesce(F.col("r.node_id").cast("string"), F.col("r.stored_value"), F.col("r.is_subject").cast("string")).isNull().alias("bare"),
    )
    if parts is not None:
        recs = recs.where(F.col("part").isin([int(p) for p in parts]))
    if side is not None:
        recs = recs.where(F.col("side") == side)
    good = F.col("node_id").isNotNull() & F.col("side").isNotNull()
    nodes_of = recs if report is None else recs.observe(report, *skip_counts(good, {"no_json": F.col("bare"), "no_node": ~F.col("bare")}))
    return _from_records(nodes_of.where(good))[0], _from_records(recs.where(good))[1]


def _from_documents(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and adjacency of the document form: each document is parsed once for either,
    its list and its two maps exploded together into one row an entry.

    Plain ``from_json``, not VARIANT: a document holds a whole shard pair, and VARIANT
    parsing turns documents beyond its size limit into nulls. Of a node with several
    values the least counts. A document without subjects on both sides is skipped."""
    pair = r"_(\d+)-(\d+)\.json$"  # shard pair ids from the file name
    docs = lines.select(
        F.from_json("value", schemas.SHARD_DOC).alias("d"),
        F.regexp_extract(F.input_file_name(), pair, 1).cast("int").alias("i"),
        F.regexp_extract(F.input_file_name(), pair, 2).cast("int").alias("j"),
    ).where(
        F.col("d.originalGraph.subjectNodes").isNotNull() & F.col("d.perturbedGraph.subjectNodes").isNotNull()
    )
    half = lambda side, part, name: F.struct(F.lit(side).alias("side"), F.col(part).alias("part"), F.col(name).alias("h"))
    halves = docs.select(F.inline(F.array(half(ORIGINAL, "i", "d.originalGraph"), half(PERTURBED, "j", "d.perturbedGraph"))))

    def entry(node, value=None, nbrs=None, subject=False, member=True):
        value = F.lit(None).cast("string") if value is None else value
        nbrs = F.lit(None).cast("array<bigint>") if nbrs is None else nbrs
        return F.struct(node.alias("node_id"), value.alias("stored_value"), nbrs.alias("nbrs"),
                        F.lit(subject).alias("is_subject"), F.lit(member).alias("member"))

    listed = lambda entries: F.coalesce(entries, F.array())
    key = lambda e: e["key"].try_cast("long")
    entries = halves.select("side", "part", F.inline(F.concat(
        F.transform("h.subjectNodes", lambda x: entry(x, subject=True)),
        listed(F.transform(F.map_entries("h.adjList"), lambda e: entry(key(e), nbrs=e["value"]))),
        listed(F.transform(F.map_entries("h.storedValues"), lambda e: entry(key(e), value=e["value"], member=False))),
    )))
    nodes = entries.groupBy("side", "part", "node_id").agg(
        F.min("stored_value").alias("stored_value"), F.bool_or("is_subject").alias("is_subject"), F.bool_or("member").alias("member"))
    adj = entries.select("side", "part", F.col("node_id").alias("src"), F.explode("nbrs").alias("dst")).distinct()
    return nodes.where("member").drop("member"), adj


def side_of(df: DataFrame, side: str) -> DataFrame:
    return df.where(F.col("side") == side).drop("side")
