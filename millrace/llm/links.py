"""Connected components of a graph of links, without collecting it anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import kept

MOST_ROUNDS = 60


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A few links that connect what the given ones connect: each node with its least one."""
    nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = flat[: len(left)], flat[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``component`` (least node reachable) for every node with a link.

    Nodes are whole numbers. Two steps in turn: each node's larger neighbours are linked to
    the least node around it, then its smaller ones. Each is one aggregate per node, merged
    before the shuffle, and one join that adaptive execution may split, so a node with very
    many links lands in no single task. Rounds are written to the shared folder; their number
    grows with the logarithm of the longest chain.
    """
    edges = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    edges = kept(_shrunk(edges.where("a <> b")).distinct(), "links")
    for _ in range(MOST_ROUNDS):
        if _all_stars(edges):
            break
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        # Larger neighbours go to the least node of the neighbourhood.
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = kept(large.where("a <> b"), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, F.col("a") == F.col("n"))
        edges = kept(
            small.select("b", "m").union(small.select("a", "m")).toDF("a", "b").where("a <> b").distinct(),
            "links",
        )
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _all_stars(edges: DataFrame) -> bool:
    """Whether each node has one link down, to a node that has none: then all is found."""
    parents = edges.select(F.col("b").alias("a"), F.lit(True).alias("is_parent")).distinct()
    down = edges.groupBy("a").agg(F.count("*").alias("n"))
    return down.join(parents, "a", "left").where("n > 1 or is_parent").isEmpty()


def _shrunk(edges: DataFrame) -> DataFrame:
    """Each task's links cut down to a forest, batch by batch."""

    def run(batches):
        for pdf in batches:
            if len(pdf):
                a, b = forest(pdf["a"].to_numpy(), pdf["b"].to_numpy())
                yield pdf.iloc[: len(a)].assign(a=a, b=b)

    return edges.mapInPandas(run, edges.schema)
