"""Paths. A path of a fixed pattern is one value; a path of unknown length stays one row per segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.session import checkpointed


# -- as values, for patterns of fixed length --------------------------------------------------
def path_value(start: Column, steps: list[tuple[Column, Column]], optional: bool = False) -> Column:
    """A start node and (relationship, next node) steps in traversal order. No steps give the empty path.

    With ``optional``, steps may be missing: those with a null relationship are left out.
    """
    segments, current = [], start
    for rel, end in steps:
        segments.append(F.struct(current.alias("start"), rel.alias("relationship"), end.alias("end")))
        current = end
    held = F.array(*segments)
    if optional and segments:
        held = F.filter(held, lambda s: s["relationship"]["element_id"].isNotNull())
    return F.struct(start.alias("start"), held.alias("segments"))


def path_start(path: Column) -> Column:
    return path["start"]


def path_end(path: Column, field: str | None = None) -> Column:
    """The last node, or one field of it.

    With ``field``, here as in the accessors below, only that field of each node is taken. Of a path that is an
    expression, not a column that was made before, the optimizer then drops whatever else its nodes are built from.
    """
    if field is None:
        return F.coalesce(F.try_element_at(path["segments"], F.lit(-1))["end"], path["start"])
    ends = path["segments"]["end"][field]
    return F.when(F.size(ends) > 0, F.try_element_at(ends, F.lit(-1))).otherwise(path["start"][field])


def path_nodes(path: Column, field: str | None = None) -> Column:
    if field is None:
        return F.concat(F.array(path["start"]), F.transform(path["segments"], lambda s: s["end"]))
    return F.concat(F.array(path["start"][field]), path["segments"]["end"][field])


def path_relationships(path: Column, field: str | None = None) -> Column:
    if field is None:
        return F.transform(path["segments"], lambda s: s["relationship"])
    return path["segments"]["relationship"][field]


def path_length(path: Column) -> Column:
    """The number of segments, counted by what costs nothing to build."""
    return F.size(path["segments"]["relationship"]["rel_type"])


def path_contains_node(path: Column, node: Column) -> Column:
    """Membership by value, not by id."""
    return (path["start"] == node) | F.exists(path["segments"], lambda s: s["end"] == node)


def path_contains_rel(path: Column, rel: Column) -> Column:
    return F.exists(path["segments"], lambda s: s["relationship"] == rel)


# -- as rows, for paths of any length ---------------------------------------------------------
def segments_of(points: DataFrame, path_id: str, pos: str) -> DataFrame:
    """Consecutive points of each path as segments: ``pos``, ``start``, ``end`` and ``end_pos``.

    Points are consecutive by the order of their positions, which may leave gaps. The points are sorted over ranges of
    (path, position), so a path of any length is spread over many tasks; the next point is found within the range,
    and for the last point of a range it is the head of the next range of the path. A path with a single point has one
    row whose ``end`` is null.
    """
    point = F.struct(*[c for c in points.columns if c != path_id])
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = points.repartitionByRange(parts, path_id, pos).sortWithinPartitions(path_id, pos)
    placed = checkpointed(spread.withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    within = Window.partitionBy(path_id, "_part").orderBy("_place")
    here = placed.select(
        path_id, "_part", F.col(pos).alias("pos"), point.alias("start"), F.lead(point).over(within).alias("near")
    )
    heads = placed.groupBy(path_id, "_part").agg(F.min_by(point, "_place").alias("head"), F.count("*").alias("n"))
    ranges = Window.partitionBy(path_id)  # a row per range that the path reaches into
    following = heads.select(
        path_id, "_part", F.lead("head").over(ranges.orderBy("_part")).alias("next"), F.sum("n").over(ranges).alias("n")
    )
    end = F.coalesce("near", "next")
    joined = here.join(following, [path_id, "_part"]).select(
        path_id, "pos", "start", end.alias("end"), end[pos].alias("end_pos"), "n"
    )
    return joined.where("end IS NOT NULL OR n = 1").drop("n")


def summarise(segments: DataFrame, path_id: str) -> DataFrame:
    """Start, end and length of every path, by aggregates of constant size."""
    has_end = F.col("end").isNotNull()
    return segments.groupBy(path_id).agg(
        F.min_by("start", "pos").alias("start"),
        F.max_by(F.coalesce("end", "start"), "pos").alias("end"),
        F.sum(F.when(has_end, 1).otherwise(0)).alias("length"),
    )


def nodes_in_order(segments: DataFrame, path_id: str) -> DataFrame:
    """The nodes of every path, one row each: the start and every segment end."""
    ends = segments.where(F.col("end").isNotNull()).select(
        path_id, F.col("end_pos").alias("pos"), F.col("end").alias("node")
    )
    lowest = segments.groupBy(path_id).agg(F.min_by("start", "pos").alias("node"), F.min("pos").alias("pos"))
    return lowest.select(path_id, "pos", "node").unionByName(ends)
