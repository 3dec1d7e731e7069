"""Residual push against the solution of the linear system and against the rounds that were there before."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.plans import article_rank, residual_rank
from graphloom.plans.projection import Projection


def _graph(spark, n, pairs):
    return Projection(spark.range(n), spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src bigint, dst bigint, weight double"))


def _exact(n, pairs, damping=0.85):
    out = np.zeros(n)
    for a, _ in pairs:
        out[a] += 1
    m = np.eye(n)
    for a, b in pairs:
        m[b, a] -= damping / (out[a] + len(pairs) / n)
    return np.linalg.solve(m, np.full(n, 1 - damping))


def _pairs(seed, n=40):
    rng = random.Random(seed)
    pairs = [(rng.randrange(n - 5), rng.randrange(n - 5)) for _ in range(100)]  # loops, repeats, five lone vertices
    return pairs + [(0, i) for i in range(1, 30)] + [(i, 1) for i in range(2, 30)]


@pytest.mark.parametrize("seed,rows_broadcast,tolerance", [(1, 10**6, 1e-9), (2, 0, 1e-6), (3, 10**6, 1e-3)])
def test_ranks_are_within_the_tolerance(spark, monkeypatch, seed, rows_broadcast, tolerance):
    monkeypatch.setattr(residual_rank, "BROADCAST_ROWS", rows_broadcast)
    monkeypatch.setattr(residual_rank, "HOT_SHARE", 0.1)  # vertex 0 is a hub
    pairs = _pairs(seed)
    got = residual_rank.article_rank(_graph(spark, 40, pairs), tolerance=tolerance, scaler=None).collect()
    want = _exact(40, pairs)
    assert sorted(r.id for r in got) == list(range(40))
    assert all(-1e-12 < want[r.id] - r.score <= tolerance * want[r.id] + 1e-12 for r in got)


def test_late_rounds_move_fewer_rows(spark, monkeypatch):
    """Far from a dense part a chain settles after the rest; tables are summed in between."""
    monkeypatch.setattr(residual_rank, "MOST_TABLES", 3)
    pairs = [(a, b) for a in range(8) for b in range(8) if a != b] + [(i, i + 1) for i in range(7, 59)]
    rounds = []
    graph = _graph(spark, 60, pairs)
    got = {r.id: r.score for r in residual_rank.article_rank(graph, tolerance=1e-7, rounds=rounds).collect()}
    assert rounds[0] == (60, 60) and sum(rounds[-1]) < sum(rounds[0]) / 4
    assert sum(s for s, _ in rounds) < 60 * len(rounds)
    old = article_rank.article_rank(graph, max_iterations=200, tolerance=1e-12).collect()
    assert all(abs(got[r.id] - r.score) < 1e-7 for r in old)


def test_graphs_without_edges_or_vertices(spark):
    edges = spark.createDataFrame([], "src bigint, dst bigint, weight double")
    got = residual_rank.article_rank(Projection(spark.range(4), edges)).collect()
    assert [r.score for r in got] == [0.25] * 4
    assert residual_rank.article_rank(Projection(spark.range(0), edges)).count() == 0
    with pytest.raises(ValueError):
        residual_rank.article_rank(Projection(spark.range(0), edges), tolerance=0.0)
    assert residual_rank.article_rank(Projection(spark.range(3), edges), scaler=None).agg(F.max("score")).first()[0] == pytest.approx(0.15)
