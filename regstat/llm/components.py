"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat.llm.common import written

#: Edges that are joined where they lie, before any are dealt by their nodes.
SLICE_EDGES = 1 << 15


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the smallest node reachable) for the nodes of
    ``edges`` (``a, b``, read twice).

    First every slice of at most ``SLICE_EDGES`` edges is replaced by the stars
    of its own components, each slice for itself. If there was more than one,
    two steps alternate until only stars are left: larger neighbours are tied
    to the smallest one, then smaller neighbours are. There the neighbours of a
    node meet only in a partial ``min`` and in joins, so a node with very many
    neighbours is never gathered in one task."""
    edges = edges.where("a <> b").select("a", "b")
    slices = max(1, -(-edges.count() // SLICE_EDGES))
    stars = written(edges.coalesce(slices).mapInArrow(_sliced, "a long, b long"), name)
    if slices == 1:
        return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    links = written(_ordered(stars), name)
    while not _only_stars(links):
        links = written(_ordered(_tie(_tie(_both(links), "n > v"), "true")), name)
    star = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return star.unionByName(roots)


def extended(found: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """The components ``found`` so far, with further links. The stars found
    stand for all earlier links."""
    known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(links.select("a", "b")), name)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stars of each slice of at most ``SLICE_EDGES`` edges: every node of
    the slice, itself included, with the smallest one that it reaches there."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, SLICE_EDGES - n)
            held.append([part.column(k).to_numpy() for k in ("a", "b")])
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == SLICE_EDGES:
                yield _stars(*map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
    if n:
        yield _stars(*map(np.concatenate, zip(*held, strict=True)))


def _stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = list(range(len(nodes)))  # nodes ascend, so the smallest is the first

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        x, y = top(x), top(y)
        root[max(x, y)] = min(x, y)
    least = nodes[[top(x) for x in range(len(nodes))]]
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], ["a", "b"])


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges, larger node first, without loops."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _tie(directed: DataFrame, keep: str) -> DataFrame:
    """For each node v: its neighbours n that satisfy ``keep``, and v itself,
    tied to the smallest of v and all its neighbours."""
    least = directed.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = (
        directed.join(least, "a")
        .select(F.col("a").alias("v"), F.col("b").alias("n"), "m")
        .where(keep)
        .select(F.col("n").alias("a"), F.col("m").alias("b"))
    )
    own = least.select("a", F.col("m").alias("b"))
    return tied.unionByName(own).where("a <> b")


def _only_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge, to a node that has none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up + down > 1").agg(F.count("*")).first()[0] == 0
