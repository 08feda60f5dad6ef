"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.arrays import task
from corpusmill.session import materialize

FOLD_LINKS = 250_000  # links that a task folds at a time


def _neighbours(edges: DataFrame) -> DataFrame:
    """Of every node the smallest node around, itself included; ``open`` unless it is a root or tied to one root alone."""
    ends = _pairs(edges, ("u", "v"), ("v", "u"))
    lower = F.when(F.col("v") < F.col("u"), F.col("v"))
    found = ends.groupBy("u").agg(F.min(lower).alias("first"), F.max(lower).alias("last"), F.max("v").alias("high"))
    return found.select("u", F.coalesce("first", "u").alias("m"), F.expr("first is not null and (first <> last or high > u)").alias("open"))


def _large_star(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Tie every larger neighbour to the smallest node around."""
    return edges.join(low.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every smaller neighbour, and the node itself, to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return _pairs(edges.join(low, "u"), ("v", "m"), ("u", "m")).filter("u <> v")


def _pairs(rows: DataFrame, *names: tuple[str, str]) -> DataFrame:
    """(u, v) of each of some pairs of columns."""
    made = F.explode(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in names)))
    return rows.select(made.alias("pair")).select("pair.u", "pair.v")


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of some links as links of each node to the smallest one; never more links than were given."""
    names, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(names))
    while True:
        x, y = root[a], root[b]
        new = root.copy()
        np.minimum.at(new, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(far := new[new], new):
            new = far
        if np.array_equal(new, root):
            break
        root = new
    tied = np.flatnonzero(root != np.arange(len(names)))
    return names[tied], names[root[tied]]


def _folded(edges: DataFrame) -> DataFrame:
    """The links of ``edges`` with those of each task as stars, some at a time: shorter ways and no repeated link."""

    @task()
    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= FOLD_LINKS:
                yield fold(held)
                held, n = [], 0
        if n:
            yield fold(held)

    def fold(held):
        u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(u, v)], ["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node in a link; nodes are 64-bit numbers, the root is the component's smallest.

    Each round is two grouped joins and three written tables; tasks fold the links they write, so links that fit a few
    tasks need few rounds. Rounds grow with the logarithm of the longest chain. Ends when every node is a root or tied to
    one root alone, which the smallest and largest neighbours of the nodes tell.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    edges = materialize(_folded(edges), "links")
    while True:
        low = materialize(_neighbours(edges), "neighbours")
        if not low.agg(F.bool_or("open")).first()[0]:
            return low.select(F.col("u").alias("node"), F.col("m").alias("root"))
        edges = materialize(_folded(_large_star(edges, low)), "links")
        edges = materialize(_folded(_small_star(edges)), "links")
