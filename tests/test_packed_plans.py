"""Plans over packed rows: similarities of pairs and triangles, cut into many places, against brute force."""

import math
import random

import numpy as np
import pytest

from graphloom.plans import colour_triangles, packed, similarity, triangles
from graphloom.plans.projection import Projection, orient


def shuffled_rows(df):
    """Rows that the query's exchanges wrote, once it has run."""
    df.collect()
    left, rows = [df._jdf.queryExecution().executedPlan()], 0
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                rows += node.metrics().get("shuffleRecordsWritten").get().value()
            left += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_packed_rows_come_back():
    rng = np.random.default_rng(5)
    far = np.array([-(2**63), -(2**63), 2**63 - 1]), np.array([-(2**63), 2**63 - 1, 5])
    near = np.sort(rng.integers(0, 40, 500)), rng.integers(-9, 10**7, 500), rng.integers(0, 70000, 500)
    for columns in (far, near, (np.zeros(0, np.int64), np.zeros(0, np.int64))):
        order = np.lexsort(columns[1::-1])
        columns = [c[order] for c in columns]
        assert all((a == b).all() for a, b in zip(packed.unpack(packed.pack(columns)), columns, strict=True))
    lists = np.repeat(np.arange(1000), 20), np.tile(np.arange(20) * 8, 1000)
    assert len(packed.pack(list(lists))) < 20_000  # a byte a row; as two longs they are 16
    assert set(packed.colour(np.arange(-50, 50), 3)) == {0, 1, 2}


def tastes(seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(20), rng.randrange(100, 160)) for _ in range(300)} | {(50 + rng.randrange(12), rng.randrange(100, 160)) for _ in range(200)}
    edges |= {(0, z) for z in range(100, 158)}
    pairs = [(rng.randrange(22), 50 + rng.randrange(13)) for _ in range(150)] + [(a, b) for a in (0, 3) for b in (1, 0)]
    return sorted(edges), pairs


@pytest.mark.parametrize("cut", [True, False])
def test_similarity_in_many_places(spark, monkeypatch, cut):
    if cut:
        for name, value in (("EDGES_PER_TASK", 60), ("EDGES_PER_PLACE", 40), ("PAIRS_PER_PLACE", 9), ("PROBES_AT_ONCE", 16)):
            monkeypatch.setattr(similarity, name, value)
    edges, pairs = tastes(1)
    near = {}
    for a, z in edges:
        near.setdefault(a, set()).add(z)
        near.setdefault(z, set()).add(a)
    near[0].add(None), near[51].add(None)  # a null is a neighbour, but none that two have in common
    both = lambda a, b: (near.get(a, set()) & near.get(b, set())) - {None}
    either = lambda a, b: len(near.get(a, ())) + len(near.get(b, ())) - len(both(a, b))
    graph = orient(spark.createDataFrame(edges, "src long, dst long"), "undirected").unionAll(
        spark.createDataFrame([(0, None), (51, None), (None, 0), (None, 51)], "src long, dst long")
    )
    frame = spark.createDataFrame(pairs + pairs[:5] + [(3, None), (None, None), (3, None)], "a long, b long")
    got = {(r.a, r.b): r.score for r in similarity.adamic_adar(frame, graph).collect()}
    want = {(a, b): sum(1 / math.log(len(near[z])) for z in both(a, b) if len(near[z]) > 1) for a, b in pairs}
    assert got == pytest.approx(want | {(3, None): 0.0, (None, None): 0.0})
    scores = similarity.jaccard(frame, graph).collect()
    want = {(a, b): len(both(a, b)) / either(a, b) if either(a, b) else 0.0 for a, b in pairs}
    assert {(r.a, r.b): r.score for r in scores} == pytest.approx(want | {(3, None): 0.0, (None, None): 0.0})
    assert len(scores) == len(got) == len(set(pairs)) + 2


def test_ids_that_are_far_apart(spark):
    edges = [(1, -(2**62)), (1, 2**62), (2, 2**62), (2, 7), (2, -(2**62))]
    graph = orient(spark.createDataFrame(edges, "src long, dst long"), "undirected")
    frame = spark.createDataFrame([(1, 2), (2, 9)], "a long, b long")
    assert {(r.a, r.b): r.score for r in similarity.jaccard(frame, graph).collect()} == {(1, 2): 2 / 3, (2, 9): 0.0}


def test_neighbours_that_are_looked_up_are_no_rows(spark):
    edges = [(a, 1000 + (a * 7 + k) % 90) for a in range(60) for k in range(40)]
    graph = orient(spark.createDataFrame(edges, "src long, dst long"), "undirected")
    frame = spark.createDataFrame([(a, b) for a in range(30) for b in range(30, 60)], "a long, b long")
    for score in (similarity.adamic_adar, similarity.jaccard):
        assert shuffled_rows(score(frame, graph)) < 5000  # 36,000 neighbours are looked up


def brute_force(pairs, vertices):
    """Triangles of each vertex."""
    near, found = {}, dict.fromkeys(vertices, 0)
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for a, b in pairs:
        for c in near[a] & near[b]:
            found[c] += 1
    return found


def random_pairs(seed, ids):
    rng = random.Random(seed)
    return sorted({tuple(sorted(rng.sample(ids, 2))) for _ in range(len(ids) * 7)} | {(ids[0], v) for v in ids[1:]})


@pytest.mark.parametrize("far", [False, True])
def test_packed_triangles_by_colours(spark, monkeypatch, far):
    monkeypatch.setattr(colour_triangles, "PROBES_AT_ONCE", 50)
    monkeypatch.setattr(colour_triangles, "VERTICES_PER_TASK", 100)
    ids = [v * (10**15 if far else 1) - 2**60 for v in range(60)]  # numbered by searching, or by bits
    pairs = random_pairs(2, ids)
    graph = Projection(spark.createDataFrame([(v,) for v in [*ids, 5]], "id long"), orient(spark.createDataFrame(pairs, "src long, dst long"), "undirected"))
    got = colour_triangles.triangle_count(graph, per_task=100)
    assert {r.id: r.triangles for r in got.collect()} == brute_force(pairs, [*ids, 5])


def test_edges_go_packed_to_their_tasks(spark):
    ids = list(range(60))
    edges = orient(spark.createDataFrame(random_pairs(3, ids), "src long, dst long"), "undirected")
    assert shuffled_rows(colour_triangles.triangle_count(Projection(spark.range(60), edges), colours=5)) < 5 * edges.count() / 2


def test_triangles_and_clustering_move_packed_edges(spark, monkeypatch):
    monkeypatch.setattr(colour_triangles, "VERTICES_PER_TASK", 100)
    ids = list(range(60))
    pairs = random_pairs(4, ids)
    graph = Projection(spark.range(62), orient(spark.createDataFrame(pairs, "src long, dst long"), "undirected"))
    expected = brute_force(pairs, range(62))
    degree = {v: sum(v in p for p in pairs) for v in range(62)}
    got = triangles.local_clustering(graph)
    assert {r.id: (r.triangles, r.degree) for r in got.collect()} == {v: (expected[v], degree[v]) for v in range(62)}
    assert got.where("coefficient < 0 OR coefficient > 1 OR (degree < 2 AND coefficient <> 0)").isEmpty()
    assert triangles.global_triangles(triangles.triangle_count(graph)).first().triangles == sum(expected.values()) // 3
    # vertices and their counts are rows, edges are not: less than a row for each
    assert shuffled_rows(triangles.triangle_count(graph)) < len(pairs)
