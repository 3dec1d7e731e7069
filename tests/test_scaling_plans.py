"""Delta-stepping and triangles by colours, against plain Python and the plans that were there before."""

import heapq
import itertools
import random

import pytest
from pyspark.sql import functions as F

from graphloom.plans import colour_triangles, delta_stepping, shortest_path
from graphloom.plans.projection import Projection, orient


def _graph(spark, rows):
    edges = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    ids = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    return Projection(ids, edges)


def _labels(rows, source):
    """id -> (cost, hops, pred), the least of these labels, by Dijkstra's rule."""
    out, best, heap = {}, {}, [(0.0, 0, -1, source)]
    for a, b, w in rows:
        out.setdefault(a, []).append((b, w))
    while heap:
        cost, hops, pred, at = heapq.heappop(heap)
        if at in best:
            continue
        best[at] = (cost, hops, None if pred < 0 else pred)
        for b, w in out.get(at, []):
            heapq.heappush(heap, (cost + w, hops + 1, at, b))
    return best


def _got(df):
    return {r.id: (r.cost, r.hops, r.pred) for r in df.collect()}


@pytest.mark.parametrize("seed,delta,rows_broadcast", [(1, 2.0, 10**6), (4, 100.0, 3)])
def test_delta_stepping_on_random_graphs(spark, monkeypatch, seed, delta, rows_broadcast):
    monkeypatch.setattr(delta_stepping, "BROADCAST_ROWS", rows_broadcast)
    rng = random.Random(seed)
    rows = [(rng.randrange(25), rng.randrange(25), float(rng.choice([0, 1, 1, 2, 3, 7, 12]))) for _ in range(70)]
    graph, start = _graph(spark, rows), spark.createDataFrame([(rows[0][0],)], "id bigint")
    assert _got(delta_stepping.distances(graph, start, delta=delta)) == _labels(rows, rows[0][0])


def test_a_chain_shuffles_its_bucket_only(spark):
    rows = [(i, i + 1, 1.0) for i in range(12)] + [(i, 100 + i, 30.0) for i in range(12)]
    rounds = []
    graph, start = _graph(spark, rows), spark.createDataFrame([(0,)], "id bigint")
    got = delta_stepping.distances(graph, start, delta=3.0, rounds=rounds)
    assert _got(got) == _labels(rows, 0) == _got(shortest_path.distances(graph, start))
    assert max(grouped for _, _, grouped in rounds) <= 6  # the state of all vertices would be up to 25 rows


def test_a_hub_and_a_target(spark):
    rows = [(0, i, float(i % 5)) for i in range(1, 300)] + [(i, 1000, 10.0 + i % 7) for i in range(1, 300)] + [(1000, 2000, 1.0), (2000, 3000, 500.0)]
    graph, start = _graph(spark, rows), spark.createDataFrame([(0,), (0,)], "id bigint")
    assert _got(delta_stepping.distances(graph, start)) == _labels(rows, 0)
    near = _got(delta_stepping.distances(graph, start, target=2000))
    assert near[2000] == _labels(rows, 0)[2000] and 3000 not in near
    route = shortest_path.path_to(delta_stepping.distances(graph, start, 3000), 3000).first()
    assert route.node_ids[0] == 0 and route.node_ids[-2:] == [2000, 3000] and route.total_cost == _labels(rows, 0)[3000][0]


def test_no_source_and_negative_weights(spark):
    graph = _graph(spark, [(1, 2, 1.0)])
    assert delta_stepping.distances(graph, spark.createDataFrame([], "id bigint")).count() == 0
    assert _got(delta_stepping.distances(graph, spark.createDataFrame([(9,)], "id bigint"))) == {9: (0.0, 0, None)}
    with pytest.raises(ValueError):
        delta_stepping.distances(_graph(spark, [(1, 2, -1.0)]), spark.createDataFrame([(1,)], "id bigint"))


@pytest.mark.parametrize("colours", [1, 3, None])
def test_triangles_by_colours(spark, colours):
    rng = random.Random(colours or 0)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(260)} | {(0, i) for i in range(1, 40)}
    expected = dict.fromkeys(range(45), 0)
    for three in itertools.combinations(range(40), 3):
        if all(p in pairs for p in itertools.combinations(three, 2)):
            for v in three:
                expected[v] += 1
    noisy = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in pairs for _ in range(rng.randint(1, 2))]
    edges = orient(spark.createDataFrame(noisy + [(3, 3)], "src bigint, dst bigint"), "undirected")
    got = colour_triangles.triangle_count(Projection(spark.range(45), edges), colours=colours)
    assert {r.id: r.triangles for r in got.collect()} == expected


def test_edges_are_dealt_to_as_many_tasks_as_there_are_colours(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert colour_triangles.dealt(edges, 6).count() == 6 * 200
    assert colour_triangles.colours_for(0) == 1 and colour_triangles.colours_for(6_000_000) == 6
    paths = list(colour_triangles._paths(None, *[__import__("numpy").array(x) for x in ([0, 2, 3], [2, 1, 0], [1, 2, 0, 1])]))
    assert sum(len(a) for a, _ in paths) == 1 + 0 + 2 + 1
