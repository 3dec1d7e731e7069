"""ArticleRank to convergence by residual push (Andersen, Chung and Lang 2006, for whole graphs).

A vertex has a residual, the rank it was given and has not passed on. Vertices whose residual exceeds a bound add it to
their rank and send it along their edges; the others keep it. What a round shuffles are the sums sent in it, so rounds
get smaller as the graph settles; ranks and kept residuals are only appended to, and summed by vertex when nobody sends
any more. Vertices whose kept residuals exceed the bound together then send again.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.article_rank import HOT_SHARE
from graphloom.plans.projection import Projection, degrees
from graphloom.session import checkpointed

#: Rows of two numbers that are broadcast; more are shuffled.
BROADCAST_ROWS = 200_000
#: Tables that are read side by side before they are summed into one.
MOST_TABLES = 16


class _Sums:
    """Amounts by vertex, appended as tables of their own and now and then summed into one."""

    def __init__(self, spark):
        self._empty, self._parts = spark.createDataFrame([], "id bigint, amount double"), []

    def add(self, rows: DataFrame) -> None:
        self._parts.append(rows)
        if len(self._parts) >= MOST_TABLES:
            self._parts = [checkpointed(self.all())]

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self._parts, self._empty).groupBy("id").agg(F.sum("amount").alias("amount"))


def article_rank(
    graph: Projection, damping: float = 0.85, tolerance: float = 1e-7, scaler: str | None = "L1Norm",
    rounds: list | None = None,
) -> DataFrame:
    """``id, score`` of every vertex; each rank is below the exact one by at most ``tolerance`` of it.

    With base rank b no vertex keeps more than ``tolerance * b``. As the exact ranks are what residuals of b give, what
    kept ones would still give is at most ``tolerance`` of them. Edges are laid out by source once and stay put.
    Edges of hot sources, at most 1,000, meet a broadcast. ``rounds`` receives (senders, vertices sent to) of each round.
    A graph without edges ranks all alike; one without vertices has no rows.
    """
    if not 0 < tolerance < 1 or not 0 <= damping < 1:
        raise ValueError("tolerance must lie between 0 and 1, damping from 0 below 1")
    if scaler not in (None, "L1Norm"):
        raise ValueError(f"unknown scaler {scaler}")
    spark = graph.edges.sparkSession
    base = 1.0 - damping
    bound = tolerance * base
    edges = checkpointed(graph.edges.select("src", "dst"))
    out = checkpointed(degrees(edges))
    n_edges, n_vertices = edges.count(), graph.vertices.count()
    average = n_edges / n_vertices if n_vertices else 0.0
    shares = out.select(
        F.col("id").alias("src"), (F.lit(damping) / (F.col("degree") + F.lit(average))).alias("share"),
        (F.col("degree") > F.lit(n_edges * HOT_SHARE)).alias("hot"),
    )
    hubs = F.broadcast(shares.where("hot").drop("hot"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = edges.join(hubs.select("src"), "src", "left_anti").repartition(partitions, "src")
    cold = cold.join(shares.where("not hot").drop("hot"), "src").persist(StorageLevel.MEMORY_AND_DISK)
    hot = edges.join(hubs, "src").persist(StorageLevel.MEMORY_AND_DISK)

    def sent(senders: DataFrame, size: int) -> DataFrame:
        at = senders.select(F.col("id").alias("src"), "amount")
        if size <= BROADCAST_ROWS:
            met = cold.join(F.broadcast(at), "src").unionByName(hot.join(F.broadcast(at), "src"))
        else:
            few = at.join(hubs.select("src"), "src", "left_semi")
            met = cold.join(at, "src").unionByName(hot.join(F.broadcast(few), "src"))
        given = met.select(F.col("dst").alias("id"), (F.col("amount") * F.col("share")).alias("amount"))
        return given.groupBy("id").agg(F.sum("amount").alias("amount"))

    ranks, kept = _Sums(spark), _Sums(spark)
    active = checkpointed(graph.vertices.select("id", F.lit(base).alias("amount")))
    while True:
        while True:
            senders = active.where(F.col("amount") > bound)
            kept.add(active.where(F.col("amount") <= bound))
            size = senders.count()
            if not size:
                break
            ranks.add(senders)
            active = checkpointed(sent(senders, size))
            if rounds is not None:
                rounds.append((size, active.count()))
        active = checkpointed(kept.all())
        if active.where(F.col("amount") > bound).isEmpty():
            break
        kept = _Sums(spark)
    cold.unpersist()
    hot.unpersist()
    ranks.add(active)
    found = graph.vertices.select("id").join(ranks.all(), "id", "left")
    scores = checkpointed(found.select("id", F.coalesce("amount", F.lit(0.0)).alias("score")))
    if scaler is None:
        return scores
    norm = scores.agg(F.sum("score")).first()[0]
    return scores.select("id", (F.col("score") / F.lit(norm)).alias("score"))
