"""Weighted shortest paths by delta-stepping (Meyer and Sanders 2003); weights must not be negative.

Costs are taken in buckets of width delta. Edges not heavier than delta may lead back into the bucket and are relaxed
until nothing in it improves; then its vertices are settled, and their heavier edges are relaxed once. What leads
beyond the bucket is only appended. So a round shuffles the vertices of one bucket: settled ones are not shuffled
again, and neither are those that wait.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.projection import Projection
from graphloom.plans.skew import hot_keys, salted_join
from graphloom.session import checkpointed

#: Rows of a few numbers that are broadcast; more are shuffled.
BROADCAST_ROWS = 200_000
#: Tables that are read side by side before they are written as one.
MOST_TABLES = 16
_STATE = "id bigint, cost double, hops bigint, pred bigint"


class _Tables:
    """A growing table: rows are appended as tables of their own and now and then written as one."""

    def __init__(self, spark):
        self._empty, self._parts = spark.createDataFrame([], _STATE), []

    def add(self, rows: DataFrame) -> None:
        self._parts.append(rows)
        if len(self._parts) >= MOST_TABLES:
            self._parts = [checkpointed(self.all())]

    def keep(self, condition) -> None:
        """Forget rows, at the time the tables are written as one."""
        if len(self._parts) >= MOST_TABLES - 1:
            self._parts = [checkpointed(self.all().where(condition))]

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self._parts, self._empty)


def distances(
    graph: Projection, sources: DataFrame, target: int | None = None, delta: float | None = None, rounds: list | None = None
) -> DataFrame:
    """``id, cost, hops, pred`` of every vertex that can be reached from ``sources`` (a frame with ``id``).

    Among paths of equal cost the one with fewer hops is taken, then the one whose last vertex but one, ``pred``, has
    the lowest id. ``delta`` is by default the mean weight. With a ``target``, buckets beyond it are left out.
    ``rounds`` receives (bucket's bound, vertices relaxed, rows grouped) of each round.
    """
    spark = graph.edges.sparkSession
    edges = checkpointed(graph.edges.select("src", "dst", "weight")).persist(StorageLevel.MEMORY_AND_DISK)
    low, mean = edges.agg(F.min("weight"), F.avg("weight")).first()
    if low is not None and low < 0:
        raise ValueError("negative weight")
    delta = delta or mean or 1.0
    hot = checkpointed(hot_keys(edges, "src"))
    light, heavy = edges.where(F.col("weight") <= delta), edges.where(F.col("weight") > delta)

    def relaxed(frontier: DataFrame, size: int, some_edges: DataFrame) -> DataFrame:
        at = frontier.select(F.col("id").alias("at"), "cost", "hops")
        if size <= BROADCAST_ROWS:
            reached = some_edges.join(F.broadcast(at), F.col("src") == F.col("at"))
        else:
            reached = salted_join(some_edges, at, "src", "at", hot)
        return reached.select(
            F.col("dst").alias("id"), (F.col("cost") + F.col("weight")).alias("cost"), (F.col("hops") + 1).alias("hops"),
            F.col("at").alias("pred"),
        )

    def best(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(F.min(F.struct("cost", "hops", "pred", "fresh")).alias("l")).select("id", "l.*")

    def unsettled(rows: DataFrame) -> DataFrame:
        """Rows of vertices that are not settled. Few are sent to the settled ones, which then stay where they are."""
        done = settled.all()
        if rows.count() > BROADCAST_ROWS:
            return rows.join(done.select("id"), "id", "left_anti")
        known = done.join(F.broadcast(rows.select("id").distinct()), "id", "left_semi").select("id")
        return rows.join(F.broadcast(known), "id", "left_anti")

    settled, waiting = _Tables(spark), _Tables(spark)
    waiting.add(checkpointed(sources.select(
        "id", F.lit(0.0).alias("cost"), F.lit(0).cast("bigint").alias("hops"), F.lit(None).cast("bigint").alias("pred")
    ).distinct()))
    bound, end = 0.0, None  # all costs below the bound are settled
    while True:
        ahead = waiting.all().where(F.col("cost") >= bound)
        least = ahead.agg(F.min("cost")).first()[0]
        if least is None or (end is not None and least > end):
            break
        upper = (math.floor(least / delta) + 1) * delta
        while upper <= least:  # rounding
            upper = math.nextafter(upper, math.inf) if upper + delta == upper else upper + delta
        entering = checkpointed(ahead.where(F.col("cost") < upper))
        bucket = checkpointed(best(unsettled(entering).withColumn("fresh", F.lit(True))))
        while True:
            frontier = bucket.where("fresh")
            size = frontier.count()
            if not size:
                break
            offers = checkpointed(relaxed(frontier, size, light))
            beyond = F.col("cost") >= upper
            waiting.add(offers.where(beyond))
            inside = checkpointed(unsettled(offers.where(~beyond)).withColumn("fresh", F.lit(True)))
            # an old entry sorts before a fresh one that is equal, so only real improvements stay fresh
            merged = bucket.withColumn("fresh", F.lit(False)).unionByName(inside)
            if rounds is not None:
                rounds.append((upper, size, merged.count()))
            bucket = checkpointed(best(merged))
        bucket = bucket.drop("fresh")
        size = bucket.count()
        if size:
            settled.add(bucket)
            far = relaxed(bucket, size, heavy)
            reduced = far.groupBy("id").agg(F.min(F.struct("cost", "hops", "pred")).alias("l")).select("id", "l.*")
            waiting.add(checkpointed(reduced))
            if target is not None and end is None:
                found = bucket.where(F.col("id") == target).select("cost").first()
                end = found[0] if found else None
        bound = upper
        waiting.keep(F.col("cost") >= bound)
    edges.unpersist()
    return settled.all()
