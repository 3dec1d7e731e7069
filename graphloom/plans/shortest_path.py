"""Weighted shortest paths by frontier relaxation; weights must not be negative."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.projection import Projection
from graphloom.plans.skew import hot_keys, salted_join
from graphloom.session import checkpointed

# A frontier of at most this many counted rows (three numbers each) is broadcast.
BROADCAST_ROWS = 200_000


def distances(graph: Projection, sources: DataFrame, target: int | None = None) -> DataFrame:
    """``id, cost, hops, pred`` of every vertex that can be reached from ``sources`` (a frame with ``id``).

    Among paths of equal cost the one with fewer hops is taken, then the one whose last vertex but
    one, ``pred``, has the lowest id.

    Each round relaxes only the edges of vertices improved in the round before. A small frontier,
    known by its count, is broadcast to the edges, so no edge moves; a larger one is joined by key
    with hubs spread out. With a ``target``, work that cannot improve the target is left out.
    """
    edges = checkpointed(graph.edges.select("src", "dst", "weight")).persist(StorageLevel.MEMORY_AND_DISK)
    if edges.where("weight < 0").limit(1).count():
        raise ValueError("negative weight")
    hot = checkpointed(hot_keys(edges, "src"))
    state = checkpointed(
        sources.select("id").distinct().select(
            "id", F.lit(0.0).alias("cost"), F.lit(0).cast("bigint").alias("hops"),
            F.lit(None).cast("bigint").alias("pred"), F.lit(True).alias("fresh"),
        )
    )
    while True:
        frontier = state.where("fresh").select(F.col("id").alias("at"), "cost", "hops")
        if target is not None:
            best = state.where(F.col("id") == target).agg(F.min("cost")).first()[0]
            frontier = frontier if best is None else frontier.where(F.col("cost") < best)
        size = frontier.count()
        if size == 0:
            break
        if size <= BROADCAST_ROWS:
            reached = edges.join(F.broadcast(frontier), F.col("src") == F.col("at"))
        else:
            reached = salted_join(edges, frontier, "src", "at", hot)
        offered = reached.select(
            F.col("dst").alias("id"), (F.col("cost") + F.col("weight")).alias("cost"),
            (F.col("hops") + 1).alias("hops"), F.col("at").alias("pred"), F.lit(True).alias("fresh"),
        )
        # An old entry sorts before a fresh one that is equal, so only real improvements stay fresh.
        known = state.withColumn("fresh", F.lit(False))
        label = F.min(F.struct("cost", "hops", "pred", "fresh")).alias("label")
        state = checkpointed(offered.unionByName(known).groupBy("id").agg(label).select("id", "label.*"))
    edges.unpersist()
    return state.drop("fresh")


def path_to(reached: DataFrame, target: int) -> DataFrame:
    """``total_cost, node_ids`` of the path to ``target``; one row, or none when it was not reached.

    The path is followed back in steps of doubling length: with the vertices 1, 2, 4, ... hops before each reached
    vertex, a path of n hops is found by log n joins, and nothing of it passes the driver. Edges are not read again.
    """
    spark = reached.sparkSession
    end = reached.where(F.col("id") == target).select("hops").first()
    if end is None:
        return spark.createDataFrame([], "total_cost double, node_ids array<bigint>")
    on_path = spark.createDataFrame([(target,)], "id bigint")
    jump = reached.where("pred is not null").select("id", "pred")
    step = 1
    while step <= end["hops"]:
        before = on_path.join(jump, "id").select(F.col("pred").alias("id"))
        on_path = checkpointed(on_path.union(before).distinct())
        step *= 2
        if step <= end["hops"]:
            further = jump.select(F.col("id").alias("pred"), F.col("pred").alias("far"))
            jump = checkpointed(jump.join(further, "pred").select("id", F.col("far").alias("pred")))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("hops", "id"))), lambda v: v["id"])
    return reached.join(on_path, "id").agg(F.max("cost").alias("total_cost"), ids.alias("node_ids"))
