"""Connected components of an edge table, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.models import materialize


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``node, root`` for the nodes of some edges whose component's smallest node is another one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while (label[label] != label).any():
            label = label[label]
        if (before == label).all():
            break
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``edges`` (``a, b``, no nulls); ``root`` is the component's smallest node.

    Each round lets every node point to its smallest neighbour (if smaller than itself),
    follows pointers twice, and replaces edges by those between the nodes pointed to. At
    least every second node of a component disappears in a round. Rounds are written tables,
    so a lost executor costs a read, and a node with many edges is one key of a join that
    AQE can split. An empty edge table gives no rows.
    """
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "cc-edges")
    root = None
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        step = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("to")), "cc-step"
        )
        for _ in range(2):
            onward = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
            step = materialize(step.join(onward, "to").select("node", F.col("far").alias("to")), "cc-step")
        if root is None:
            root = step.withColumnRenamed("to", "root")
        else:
            onward = step.select(F.col("node").alias("root"), F.col("to").alias("_to"))
            root = root.join(onward, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
        root = materialize(root, "cc-root")
        left = step.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        edges = materialize(
            edges.join(left, "a")
            .join(right, "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(),
            "cc-edges",
        )
    return root if root is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
