"""ArticleRank (Li and Willett 2009): citations from sparsely citing vertices weigh less than in PageRank.

    r(v) = (1 - d) + d * sum over u -> v of r(u) / (out(u) + average out-degree)
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.plans.projection import Projection, degrees
from graphloom.session import checkpointed

# A source is hot when it holds more than this share of the edges, so there are at most 1,000 in any graph.
HOT_SHARE = 0.001


def article_rank(
    graph: Projection, max_iterations: int = 20, damping: float = 0.85, tolerance: float = 1e-7,
    scaler: str | None = "L1Norm",
) -> DataFrame:
    """``id, score``. Stops early once no rank moves by ``tolerance`` or more.

    Edges are laid out once and stay put; each round moves only vertex rows. Edges of hot sources, a
    number of sources with a fixed bound, meet a broadcast of those sources' ranks instead, so no
    task holds a hub's whole edge list. Sums per target are reduced before their shuffle.
    """
    edges = checkpointed(graph.edges.select("src", "dst"))
    out = degrees(edges)
    totals = out.agg(F.sum("degree").alias("edges")).first()["edges"] or 0
    n_vertices = graph.vertices.count()
    base = 1.0 - damping
    average = totals / n_vertices if n_vertices else 0.0

    vertices = graph.vertices.join(out, "id", "left").select(
        "id",
        (F.coalesce("degree", F.lit(0)) + F.lit(average)).alias("spread"),
        (F.coalesce("degree", F.lit(0)) > F.lit(totals * HOT_SHARE)).alias("hot"),
    )
    state = checkpointed(vertices.select("*", F.lit(base).alias("rank"), F.lit(0.0).alias("moved")))
    hot_ids = state.where("hot").select(F.col("id").alias("src"))
    any_hot = not hot_ids.isEmpty()
    cold = edges.join(F.broadcast(hot_ids), "src", "left_anti") if any_hot else edges
    # as many as a shuffle has, so that a join with the ranks leaves the edges where they are
    partitions = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = cold.repartition(partitions, "src").sortWithinPartitions("src").persist(StorageLevel.MEMORY_AND_DISK)
    hot = edges.join(F.broadcast(hot_ids), "src", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)

    rounds = max_iterations if totals else 0  # without edges every rank is the base
    for _ in range(rounds):
        share = state.select(F.col("id").alias("src"), "hot", (F.col("rank") / F.col("spread")).alias("share"))
        given = cold.join(share.drop("hot"), "src").select("dst", "share")
        if any_hot:
            hubs = F.broadcast(share.where("hot").drop("hot"))
            given = given.unionAll(hot.join(hubs, "src").select("dst", "share"))
        # A vertex's own row travels with what it receives, so one shuffle makes the new state.
        own = state.select("id", F.lit(0.0).alias("share"), "spread", "hot", "rank")
        mail = given.withColumnRenamed("dst", "id").unionByName(own, allowMissingColumns=True)
        received = mail.groupBy("id").agg(
            F.sum("share").alias("received"), *[F.max(c).alias(c) for c in ("spread", "hot", "rank")]
        )
        rank = F.lit(base) + F.lit(damping) * F.col("received")
        state = checkpointed(
            received.where(F.col("rank").isNotNull()).select(
                "id", "spread", "hot", rank.alias("rank"), F.abs(rank - F.col("rank")).alias("moved")
            )
        )
        if tolerance > 0 and (state.agg(F.max("moved")).first()[0] or 0.0) < tolerance:
            break

    cold.unpersist()
    hot.unpersist()
    scores = state.select("id", F.col("rank").alias("score"))
    if scaler is None:
        return scores
    if scaler != "L1Norm":
        raise ValueError(f"unknown scaler {scaler}")
    norm = state.agg(F.sum(F.abs("rank"))).first()[0]
    return scores.select("id", (F.col("score") / F.lit(norm)).alias("score"))
