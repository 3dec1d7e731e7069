"""Graph projections: the vertices and edges an algorithm works on."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.sources.graph import PropertyGraph


@dataclass
class Projection:
    vertices: DataFrame  # id
    edges: DataFrame  # src, dst and, when asked for, weight


def project(
    graph: PropertyGraph, labels: list[str], rel_types: list[str], orientation: str = "natural",
    weight: str | None = None, distinct: bool = True,
) -> Projection:
    """Vertices by label, edges by type; only edges with both ends among the vertices.

    ``natural`` keeps directions, ``reverse`` turns them, ``undirected`` has both directions of each
    distinct pair and no self loops. Parallel edges are merged, keeping the lowest weight, before the
    second direction is added, so the shuffle sees every pair once.
    """
    vertices = reduce(
        DataFrame.unionByName, (graph.nodes(name).select(F.col("vid").alias("id")) for name in labels)
    )
    columns = ["src", "dst"] + ([F.col(weight).alias("weight")] if weight else [])
    edges = reduce(DataFrame.unionByName, (graph.rels(name).select(*columns) for name in rel_types))
    if graph.id_has_label is not None:
        edges = edges.where(graph.id_has_label(F.col("src"), labels) & graph.id_has_label(F.col("dst"), labels))
    else:
        for end in ("src", "dst"):
            edges = edges.join(vertices.select(F.col("id").alias(end)), end, "left_semi")
    return Projection(vertices, orient(edges, orientation, distinct))


def orient(edges: DataFrame, orientation: str, distinct: bool = True) -> DataFrame:
    weighted = "weight" in edges.columns
    if orientation == "reverse":
        edges = edges.withColumnsRenamed({"src": "dst", "dst": "src"})
    if orientation in ("natural", "reverse"):
        return merge_parallel(edges) if distinct else edges
    pairs = edges.where("src <> dst").select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), *(["weight"] if weighted else [])
    )
    return both_directions(merge_parallel(pairs))


def merge_parallel(edges: DataFrame) -> DataFrame:
    if "weight" in edges.columns:
        return edges.groupBy("src", "dst").agg(F.min("weight").alias("weight"))
    return edges.select("src", "dst").distinct()


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each pair as two directed edges, without another shuffle."""
    rest = [c for c in pairs.columns if c not in ("src", "dst")]
    ways = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    return pairs.select(F.inline(ways), *rest)


def degrees(edges: DataFrame, end: str = "src") -> DataFrame:
    return edges.groupBy(F.col(end).alias("id")).agg(F.count("*").alias("degree"))
