"""Two graph snapshots and their true changes, derived from the driver's tables.

* original nodes: one per customer, value = account balance in cents (as text);
* original edges: the customers of every pair of consecutive orders
  (``o_orderkey`` and ``o_orderkey + 1``), all orders, self pairs dropped;
* perturbed snapshot: deterministic removals, value edits, additions and edge
  cuts chosen by id arithmetic, so the truth is known exactly.

The id rules below define *which* nodes change; every node and edge of the
whole tables is still processed by every query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdiff.session import stored

# Fixed values of the perturbation (also used verbatim by the SQL oracles).
REMOVE_MOD, REMOVE_REM = 17, 3  # node_id % 17 = 3  -> removed
MODIFY_MOD, MODIFY_REM = 13, 5  # node_id % 13 = 5  -> value edited ('#m' appended)
ADD_MOD, ADD_REM = 19, 7  # node_id % 19 = 7  -> a new node, id + ADD_OFFSET, value + '#a'
CUT_MUL, CUT_MOD = 31, 23  # (src * 31 + dst) % 23 = 0 -> edge cut
# Added ids live far above any customer key (TPC-H keys stay below 1.5e10 at SF 100k).
ADD_OFFSET = 1_000_000_000_000


@dataclass
class Snapshots:
    nodes_o: DataFrame
    edges_o: DataFrame
    nodes_p: DataFrame
    edges_p: DataFrame
    truth: DataFrame


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def original_nodes(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("long").alias("node_id"),
        F.round(F.col("c_acctbal") * 100).cast("long").cast("string").alias("stored_value"),
    )


def original_edges(orders: DataFrame) -> DataFrame:
    a = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("long").alias("src"))
    b = orders.select((F.col("o_orderkey") - 1).alias("k"), F.col("o_custkey").cast("long").alias("dst"))
    return a.join(b, "k").where(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def perturbed_nodes(nodes_o: DataFrame) -> DataFrame:
    nid = F.col("node_id")
    kept = nodes_o.where(nid % REMOVE_MOD != REMOVE_REM).select(
        "node_id",
        F.when(nid % MODIFY_MOD == MODIFY_REM, F.concat("stored_value", F.lit("#m")))
        .otherwise(F.col("stored_value"))
        .alias("stored_value"),
    )
    added = nodes_o.where(nid % ADD_MOD == ADD_REM).select(
        (nid + ADD_OFFSET).alias("node_id"), F.concat("stored_value", F.lit("#a")).alias("stored_value")
    )
    return kept.unionByName(added)


def perturbed_edges(edges_o: DataFrame, nodes_o: DataFrame, nodes_p: DataFrame) -> DataFrame:
    s, d = F.col("src"), F.col("dst")
    kept = edges_o.where(
        (s % REMOVE_MOD != REMOVE_REM) & (d % REMOVE_MOD != REMOVE_REM) & ((s * CUT_MUL + d) % CUT_MOD != 0)
    )
    nid = F.col("node_id")
    new = nodes_o.where(nid % ADD_MOD == ADD_REM).select(
        (nid + ADD_OFFSET).alias("src"), (nid + 1).alias("dst")
    )
    new = new.join(nodes_p.select(F.col("node_id").alias("dst")), "dst", "left_semi").select("src", "dst")
    return kept.unionByName(new)


def true_changes(nodes_o: DataFrame) -> DataFrame:
    nid = F.col("node_id")
    removed = nodes_o.where(nid % REMOVE_MOD == REMOVE_REM).select(F.lit("Removed").alias("change_type"), "node_id")
    modified = nodes_o.where((nid % MODIFY_MOD == MODIFY_REM) & (nid % REMOVE_MOD != REMOVE_REM)).select(
        F.lit("Modified").alias("change_type"), "node_id"
    )
    added = nodes_o.where(nid % ADD_MOD == ADD_REM).select(
        F.lit("Added").alias("change_type"), (nid + ADD_OFFSET).alias("node_id")
    )
    return removed.unionByName(modified).unionByName(added)


def sparse_edges(customer: DataFrame) -> DataFrame:
    """A second edge relation of small degree and many components: each customer and the
    next by key if their nations are both even or both odd, and the third next
    if they share the market segment. At most four neighbours a node."""
    c = customer.select(F.col("c_custkey").cast("long").alias("src"), (F.col("c_nationkey") % 2).alias("n"), F.col("c_mktsegment").alias("m"))
    d = c.select(F.col("src").alias("dst"), F.col("n").alias("n2"), F.col("m").alias("m2"))
    near = c.join(d, F.col("dst") == F.col("src") + 1).where(F.col("n") == F.col("n2"))
    far = c.join(d, F.col("dst") == F.col("src") + 3).where(F.col("m") == F.col("m2"))
    return near.select("src", "dst").union(far.select("src", "dst"))


def hot_nodes(customer: DataFrame) -> DataFrame:
    """The original nodes with two values that a third of them hold each."""
    nation = F.col("c_nationkey") % 3
    value = F.when(nation == 0, "hot").when(nation == 1, "warm").otherwise(F.round(F.col("c_acctbal") * 100).cast("long").cast("string"))
    return customer.select(F.col("c_custkey").cast("long").alias("node_id"), value.alias("stored_value"))


def snapshots(spark: SparkSession, sf_dir: str, sparse: bool = False, hot: bool = False) -> Snapshots:
    """Derive both snapshots and the truth from the tables in ``sf_dir``, anew on every call.

    Only the original edges, which several relations build on, are stored
    (as a table); the rest is read from the tables by each query."""
    customer = load_table(spark, sf_dir, "customer")
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    nodes_o = hot_nodes(customer) if hot else original_nodes(customer)
    edges_o = stored(sparse_edges(customer) if sparse else original_edges(orders), "edges")
    nodes_p = perturbed_nodes(nodes_o)
    edges_p = perturbed_edges(edges_o, nodes_o, nodes_p)
    return Snapshots(nodes_o, edges_o, nodes_p, edges_p, true_changes(nodes_o))
