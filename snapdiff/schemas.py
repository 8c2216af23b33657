"""Explicit schemas (never inferred)."""

from pyspark.sql import types as T

NODES = T.StructType(
    [
        T.StructField("node_id", T.LongType()),
        T.StructField("stored_value", T.StringType()),
    ]
)

EDGES = T.StructType(
    [
        T.StructField("src", T.LongType()),
        T.StructField("dst", T.LongType()),
    ]
)

# One heterogeneous component table; kind is 'node', 'edge' or anything else (dropped).
COMPONENTS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("stored_value", T.StringType()),
        T.StructField("src", T.LongType()),
        T.StructField("dst", T.LongType()),
    ]
)

MATCHES = T.StructType(
    [
        T.StructField("side", T.StringType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("match_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)

CHANGES = T.StructType(
    [
        T.StructField("change_type", T.StringType()),
        T.StructField("node_id", T.LongType()),
    ]
)

# Nested ground-truth document: Added is a map whose *values* are the ids.
CHANGES_DOC = T.StructType(
    [
        T.StructField(
            "Nodes",
            T.StructType(
                [
                    T.StructField("Modified", T.ArrayType(T.LongType())),
                    T.StructField("Removed", T.ArrayType(T.LongType())),
                    T.StructField("Added", T.MapType(T.StringType(), T.LongType())),
                ]
            ),
        )
    ]
)

# Flat shard record, one per (side, part, node, chunk of neighbours).
SHARD_RECORD = T.StructType(
    [
        T.StructField("side", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("node_id", T.LongType()),
        T.StructField("stored_value", T.StringType()),
        T.StructField("is_subject", T.BooleanType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("neighbors", T.ArrayType(T.LongType())),
    ]
)

# Import form of one shard half: {subjectNodes, adjList, storedValues}.
SHARD_HALF_DOC = T.StructType(
    [
        T.StructField("subjectNodes", T.ArrayType(T.LongType())),
        T.StructField("adjList", T.MapType(T.StringType(), T.ArrayType(T.LongType()))),
        T.StructField("storedValues", T.MapType(T.StringType(), T.StringType())),
    ]
)

SHARD_DOC = T.StructType(
    [
        T.StructField("originalGraph", SHARD_HALF_DOC),
        T.StructField("perturbedGraph", SHARD_HALF_DOC),
    ]
)
