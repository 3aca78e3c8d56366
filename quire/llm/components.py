"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import join_small

from .common import materialize


def _parents(edges: DataFrame) -> DataFrame:
    """(node, label): each node with a smaller neighbour and the end of the chain of least
    neighbours that starts at it."""
    parents = materialize(edges.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node"), "parents")
    while True:
        nxt = parents.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        jumped = materialize(_with(parents, nxt, "label").withColumn("_moved", F.col("_next").isNotNull()), "jumped")
        moved = jumped.filter("_moved").limit(1).count()
        parents = jumped.select("node", F.coalesce("_next", "label").alias("label"))
        if not moved:
            return parents


def _with(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Left join with a table of one row per key; a key with many rows is salted."""
    counts = lambda: big.groupBy(key).agg(F.count("*").alias("_n"))
    return join_small(big, small, key, "left", counts=counts)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b: bigint) that are not the smallest of
    their component; label is the smallest.

    Each round joins every node to the end of its chain of least neighbours and contracts
    the edges to the ends, which at least halves the nodes that still have edges.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = materialize(edges, "edges")
    labels = None
    while not edges.isEmpty():
        parents = _parents(edges)
        step = parents.select(F.col("node").alias("label"), F.col("label").alias("_to"))
        if labels is None:
            labels = parents
        else:
            labels = _with(labels, step, "label").select("node", F.coalesce("_to", "label").alias("label")).unionByName(parents)
            labels = materialize(labels, "labels")
        moved = edges
        for end in ("u", "v"):
            to = parents.select(F.col("node").alias(end), F.col("label").alias("_to"))
            moved = _with(moved, to, end).withColumn(end, F.coalesce("_to", end)).drop("_to")
        moved = moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
        edges = materialize(moved, "edges")
    return labels if labels is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
