"""Connected components of an edge table, by alternating large and small stars.

Every round is one aggregation and one join per star over the edges alone, after which every
task joins what its own rows connect (at most ``ROWS`` rows at a time), and is written to shared
storage, so lineage stays short and lost executors cost one round. As soon as no more than
``ROWS`` edges are left, what a task may hold at a time anyway, one task joins them and no further
round is run. Nothing is collected but the number of edges and whether they are stars already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framesift.llm.text import map_arrow
from framesift.workspace import stage

#: Edges that a task joins at a time.
ROWS = 500_000


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node that some edges connect with a smaller one, and the smallest such node."""
    names, number = np.unique(np.r_[a, b], return_inverse=True)
    a, b = number[: len(a)], number[len(a) :]
    least = np.arange(len(names))
    while (apart := least[a] != least[b]).any():
        x, y = least[a[apart]], least[b[apart]]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (further := least[least] != least).any():
            least[further] = least[least[further]]
    moved = np.flatnonzero(least != np.arange(len(names)))
    return names[moved], names[least[moved]]


def _contracted(batches):
    def stars():
        found = contracted(*(np.concatenate(column) for column in zip(*edges)))
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in found], ["a", "b"])

    edges, held = [], 0
    for batch in batches:
        edges.append([np.asarray(column) for column in batch.columns])
        held += batch.num_rows
        if held >= ROWS:
            yield stars()
            edges, held = [], 0
    if held:
        yield stars()


def _joined(edges: DataFrame) -> DataFrame:
    return map_arrow(edges, _contracted, "a bigint, b bigint")


def _round(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Large star: the smaller end of every edge gives way to its own smallest neighbour.
    Small star: all smaller neighbours of a node move to the smallest one. ``least`` is a
    written table, so that Spark may broadcast it or split the rows of a hot end."""
    edges = edges.join(least, edges["b"] == least["node"], "left").select(
        "a", F.coalesce("m", "b").alias("b")
    )
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m"))
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``: any integers) that is
    linked with another one; the root is the smallest node of its component and has no row
    of its own. Loops and nulls are ignored, repeated edges count once."""
    ends = edges.where(F.col("a") != F.col("b")).select(*(F.col(c).cast("bigint") for c in ("a", "b")))
    edges = stage(_joined(ends).distinct(), "edges")
    while True:
        if edges.count() <= ROWS:
            edges = stage(_joined(edges.coalesce(1)), "edges")
            break
        least = stage(
            edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("ends")),
            "least",
        )
        if least.where("ends > 1").isEmpty() and edges.join(least, F.col("b") == F.col("node"), "left_semi").isEmpty():
            break  # every node has one edge, to a node that has none
        edges = stage(_joined(_round(edges, least.drop("ends"))), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
