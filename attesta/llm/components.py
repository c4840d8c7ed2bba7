"""Connected components of an edge table. Parts of at most PART edges are contracted to stars in their tasks; if there are several
parts, alternating large and small stars join them. Nothing is collected."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch, stored

#: Edges that a task holds to contract them.
PART = 500_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[label]
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _stars(batches):
    """The whole task's edges (u, v) -> (u, v), v the least node of u's component in them, for each node."""
    parts = [[c.to_numpy() for c in b.columns] for b in batches if len(b)]
    if parts:
        nodes, least = contracted(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
        yield pa.record_batch([pa.array(nodes), pa.array(least)], ["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours below the least of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, part: int = PART) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (u, v: long) that have others; the root is the least node of the component."""
    with scratch(edges.sparkSession):
        now = stored(edges.where("u <> v").select("u", "v"), "edges")
        parts = math.ceil(now.count() / part)
        stars = (now.coalesce(1) if parts <= 1 else now.repartition(parts)).mapInArrow(_stars, "u long, v long")
        if parts <= 1:
            return stored(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "roots", outer=True)
        now = stored(stars.where("u <> v").distinct(), "edges")
        last = None
        while True:
            mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if mark == last:
                break
            last, old = mark, now
            now = stored(_star(_star(old, True), False), "edges")
            discard(old)
        roots = now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")))
        return stored(roots.groupBy("node").agg(F.min("root").alias("root")), "roots", outer=True)
