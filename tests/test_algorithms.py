"""Graph algorithms against published results, brute force on random graphs, and graphs with hubs."""

import heapq
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators.patterns import ids_to_props
from graphloom.plans.article_rank import article_rank
from graphloom.plans.projection import Projection, orient
from graphloom.plans.shortest_path import distances, path_to
from graphloom.plans.similarity import adamic_adar, jaccard
from graphloom.plans.skew import hot_keys, salted_join
from graphloom.plans.triangles import global_triangles, local_clustering, triangle_count

PAPERS = [(1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (3, 2), (4, 0), (4, 1), (4, 2), (4, 3), (5, 1), (5, 4), (6, 1), (6, 4)]
# Alice 0, Michael 1, Karin 2, Chris 3, Will 4, Mark 5
KNOWS = [(1, 2), (1, 3), (4, 1), (5, 1), (5, 4), (0, 1), (4, 3), (3, 2)]
# Zhen 0, Praveena 1, Michael 2, Arya 3, Karin 4
FRIENDS = [(0, 3), (0, 1), (1, 4), (1, 2), (2, 4), (3, 4)]
ROADS = [(0, 1, 50), (0, 2, 60), (0, 3, 100), (1, 3, 40), (2, 3, 50), (2, 4, 80), (3, 4, 30), (3, 5, 80), (4, 5, 40)]
# Cuisines 0-4; Zhen 10, Praveena 11, Michael 12, Arya 13, Karin 14
LIKES = [(11, 2), (11, 4), (10, 0), (10, 2), (12, 0), (12, 1), (12, 2), (13, 3), (13, 1), (13, 4), (14, 3), (14, 1)]


def edges_of(spark, rows, ddl="src long, dst long"):
    return spark.createDataFrame(rows, ddl)


def undirected(spark, rows):
    return orient(edges_of(spark, rows), "undirected")


def random_edges(seed, n, m, hub=True):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
    if hub:  # one vertex that touches almost everything
        pairs |= {(0, v) for v in range(1, n) if rng.random() < 0.9}
    return sorted(pairs)


def neighbours(pairs):
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
        out.setdefault(b, set()).add(a)
    return out


def test_article_rank_of_papers(spark):
    scores = article_rank(Projection(spark.range(7), edges_of(spark, PAPERS)))
    top = scores.orderBy(F.desc("score")).limit(5).collect()
    assert [(r["id"], round(100 * r["score"])) for r in top] == [(0, 22), (1, 20), (4, 14), (2, 13), (3, 11)]


def test_article_rank_with_a_hub(spark):
    edges = [(a, b) for a, b in random_edges(1, 60, 120)] + [(b, a) for a, b in random_edges(2, 60, 60, hub=False)]
    edges = sorted(set(edges))
    n, out = 60, {}
    for a, _ in edges:
        out[a] = out.get(a, 0) + 1
    average, rank = len(edges) / n, {v: 0.15 for v in range(n)}
    for _ in range(7):
        got = {v: 0.0 for v in range(n)}
        for a, b in edges:
            got[b] += rank[a] / (out[a] + average)
        rank = {v: 0.15 + 0.85 * got[v] for v in range(n)}
    graph = Projection(spark.range(n), edges_of(spark, edges))
    scores = article_rank(graph, max_iterations=7, tolerance=0.0, scaler=None).collect()
    assert {r["id"]: round(r["score"], 9) for r in scores} == {v: round(x, 9) for v, x in rank.items()}


def test_article_rank_without_edges(spark):
    scores = article_rank(Projection(spark.range(3), edges_of(spark, [])), scaler=None).collect()
    assert [r["score"] for r in scores] == pytest.approx([0.15] * 3)


def test_triangles_of_people(spark):
    graph = Projection(spark.range(6), undirected(spark, KNOWS))
    got = {r["id"]: (r["triangles"], round(100 * r["coefficient"])) for r in local_clustering(graph).collect()}
    assert got == {0: (0, 0), 1: (3, 30), 2: (1, 100), 3: (2, 67), 4: (2, 67), 5: (1, 100)}
    assert global_triangles(triangle_count(graph)).first()["triangles"] == 3


@pytest.mark.parametrize("seed", [3, 4])
def test_triangles_brute_force(spark, seed):
    pairs = random_edges(seed, 40, 150)
    near = neighbours(pairs)
    expected = {v: 0 for v in range(40)}
    for a, b, c in itertools.combinations(range(40), 3):
        if b in near.get(a, ()) and c in near.get(a, ()) and c in near.get(b, ()):
            for v in (a, b, c):
                expected[v] += 1
    # Both directions, copies and self loops are cleaned by the undirected projection.
    noisy = pairs + [(b, a) for a, b in pairs[::2]] + [(5, 5)]
    got = triangle_count(Projection(spark.range(40), undirected(spark, noisy))).collect()
    assert {r["id"]: r["triangles"] for r in got} == expected


def test_adamic_adar_of_friends(spark):
    pairs = edges_of(spark, [(2, 4)], "a long, b long")
    score = adamic_adar(pairs, undirected(spark, FRIENDS)).first()["score"]
    assert round(100 * score) == 91


def test_jaccard_of_tastes(spark):
    pairs = edges_of(spark, [(14, 13)], "a long, b long")
    assert round(100 * jaccard(pairs, edges_of(spark, LIKES)).first()["score"]) == 67


@pytest.mark.parametrize("seed", [5, 6])
def test_similarity_brute_force(spark, seed):
    edges = random_edges(seed, 50, 200)
    near = neighbours(edges)
    rng = random.Random(seed)
    pairs = sorted({(rng.randrange(55), rng.randrange(55)) for _ in range(200)} | {(0, v) for v in range(1, 50)})
    pairs = [(a, b) for a, b in pairs if a != b] + [(7, 3), (3, 7), (7, 3)]
    frame, graph = edges_of(spark, pairs, "a long, b long"), undirected(spark, edges)
    none = set()
    aa = {(a, b): sum(1 / math.log(len(near[z])) for z in near.get(a, none) & near.get(b, none)) for a, b in pairs}
    jc = {}
    for a, b in pairs:
        union = near.get(a, none) | near.get(b, none)
        jc[a, b] = len(near.get(a, none) & near.get(b, none)) / len(union) if union else 0.0
    assert {(r["a"], r["b"]): round(r["score"], 9) for r in adamic_adar(frame, graph).collect()} == {
        k: round(v, 9) for k, v in aa.items()
    }
    assert {(r["a"], r["b"]): round(r["score"], 9) for r in jaccard(frame, graph).collect()} == {
        k: round(v, 9) for k, v in jc.items()
    }


def test_shortest_path_of_locations(spark):
    graph = Projection(spark.range(6), edges_of(spark, ROADS, "src long, dst long, weight long"))
    for target in (None, 5):
        route = path_to(distances(graph, spark.range(1), target), 5)
        names = spark.createDataFrame([(i, c) for i, c in enumerate("ABCDEF")], "id long, name string")
        shown = ids_to_props(route, "total_cost", "node_ids", names, "id", "name").first()
        assert (shown["total_cost"], shown["names"]) == (160.0, ["A", "B", "D", "E", "F"])


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_shortest_path_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr("graphloom.plans.shortest_path.BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(9)
    edges = [(a, b, rng.randrange(0, 20)) for a, b in random_edges(8, 40, 100)]
    near = {}
    for a, b, w in edges:
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    best, queue = {}, [(0, 0, 3)]
    while queue:
        cost, hops, v = heapq.heappop(queue)
        if v in best:
            continue
        best[v] = (cost, hops)
        for u, w in near.get(v, ()):
            heapq.heappush(queue, (cost + w, hops + 1, u))
    both = edges + [(b, a, w) for a, b, w in edges]
    graph = Projection(spark.range(45), edges_of(spark, both, "src long, dst long, weight long"))
    reached = distances(graph, spark.range(3, 4))
    assert {r["id"]: (r["cost"], r["hops"]) for r in reached.collect()} == best
    assert path_to(reached, 44).count() == 0
    weight = {(a, b): w for a, b, w in both}
    for target in (0, 17, 39):
        row = path_to(reached, target).first()
        steps = list(zip(row["node_ids"], row["node_ids"][1:]))
        assert sum(weight[s] for s in steps) == best[target][0] == row["total_cost"]


def test_negative_weights_are_refused(spark):
    graph = Projection(spark.range(2), edges_of(spark, [(0, 1, -1)], "src long, dst long, weight long"))
    with pytest.raises(ValueError):
        distances(graph, spark.range(1))


def test_rank_edges_stay_put(spark):
    """No round shuffles the cached edges again, whatever the number of shuffle partitions."""
    import graphloom.plans.article_rank as module

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plans, real = [], module.checkpointed

    def recorded(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    module.checkpointed = recorded
    try:
        for partitions in ("3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            edges = edges_of(spark, [(i, (i * 7 + k) % 60) for i in range(60) for k in range(1, 4)], "src long, dst long")
            article_rank(Projection(spark.range(60), edges), max_iterations=2, tolerance=0.0).collect()
            rounds = [p for p in plans if "InMemoryTableScan" in p]
            assert rounds
            for plan in rounds:
                lines = plan.splitlines()
                at = next(i for i, line in enumerate(lines) if "InMemoryTableScan" in line)
                above = lines[:at][::-1]
                joined = next(i for i, line in enumerate(above) if "Join" in line)
                assert not any("Exchange" in line for line in above[:joined])
            plans.clear()
    finally:
        module.checkpointed = real
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_equals_plain_join(spark):
    rng = random.Random(11)
    left = spark.createDataFrame(
        [(7 if rng.random() < 0.5 else rng.randrange(3000), i) for i in range(6000)], "k long, v long"
    )
    right = spark.range(0, 2900).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w"))
    hot = hot_keys(left, "k", rows_per_task=100)
    assert [(r["k"], r["salts"] > 20) for r in hot.collect()] == [(7, True)] and hot_keys(left, "k").isEmpty()
    plain = left.join(right, F.col("k") == F.col("rk"))
    salted = salted_join(left, right, "k", "rk", hot)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_hot_key_rows_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(20000).select(F.lit(1).cast("long").alias("k"), "id")
        right = spark.range(5).select(F.col("id").alias("rk"))
        joined = salted_join(left, right, "k", "rk", hot_keys(left, "k", rows_per_task=500))
        sizes = [n for n in joined.select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"]]
        assert sum(sizes) == 20000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
