"""Connected components: links are contracted within each task, then across tasks by large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import drop, release, save

#: Links a task contracts at a time; bounds its memory, not the graph.
CHUNK = 1 << 20


def smallest_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links and the smallest node that each reaches through them."""
    node, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y, up = at[: len(a)], at[len(a) :], np.arange(len(node))
    while (up[x] != up[y]).any():
        i, j = up[x], up[y]
        np.minimum.at(up, np.maximum(i, j), np.minimum(i, j))
        while (up[up] != up).any():
            up = up[up]
    return node, node[up]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same components with one link (node, smallest local node) for each node of a chunk."""
    held, size = [], 0

    def stars() -> pa.RecordBatch:
        node, root = smallest_reached(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in "ab"))
        child = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[child]), pa.array(root[child])], ["a", "b"])

    for b in batches:
        held.append(b)
        size += len(b)
        if size >= CHUNK:
            yield stars()
            held, size = [], 0
    if size:
        yield stars()


def _contracted(edges: DataFrame) -> DataFrame:
    return edges.mapInArrow(_contract, "a long, b long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one: then all is done."""
    ends = edges.select(F.col("a").alias("n"), F.col("b").alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(None).cast("long"), F.lit(1)))
    odd = ends.groupBy("n").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("down").alias("down")).where("low < high or (low is not null and down = 1)")
    return odd.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it reaches.

    Links may repeat, run either way or loop; null ends are ignored. A task first
    turns its own links into one link a node. Every step between tasks is a join
    and a pre-aggregated minimum, so a node with very many links never meets in
    one task. Steps never add links, and equal links of several tasks do no harm.
    """
    edges = save(_contracted(links.select("a", "b").where("a <> b")))
    while not _stars(edges):
        spent, edges = edges, save(_small_star(_large_star(_contracted(edges))))
        drop(spent)
        release(links.sparkSession)
    leaves = edges.distinct()
    roots = edges.select(F.col("b").alias("node")).distinct()
    return leaves.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
