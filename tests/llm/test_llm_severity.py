"""The cumulative-link model against its likelihood written out, and scores against sums by hand."""

import math
import random

import numpy as np
import pytest

from graphloom.llm import severity
from graphloom.llm.common import word_list


def _chance(score, thresholds, grade):
    """P(grade), from the definition: the difference of two logistic steps."""
    def above(k):
        if k <= 0:
            return 1.0
        return 0.0 if k > len(thresholds) else 1 / (1 + math.exp(thresholds[k - 1] - score))

    return above(grade) - above(grade + 1)


def _loss(rows, grades, weights, thresholds):
    total = sum(-math.log(max(_chance(sum(weights[j] for j in cols), thresholds, g), 1e-12)) for cols, g in zip(rows, grades))
    return total / len(rows) + severity.PENALTY * sum(abs(w) for w in weights)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_step_lowers_the_loss(seed):
    """The loss is convex, so where no step along an axis, or along a random direction, lowers it, it is the least."""
    rng = random.Random(seed)
    width, steps = 5, len(severity.GRADES)
    truth = [rng.uniform(-1, 2) for _ in range(width)]
    rows, grades = [], []
    for _ in range(160):
        cols = [j for j in range(width) if rng.random() < 0.4]
        noisy = sum(truth[j] for j in cols) + math.log(rng.random() / rng.random())
        rows.append(cols)
        grades.append(sum(noisy > 0.3 + k for k in range(steps)))
    row = np.repeat(np.arange(len(rows)), [len(c) for c in rows])
    column = np.array([j for c in rows for j in c])
    weights, thresholds = severity._descend(row, column, np.array(grades), width)
    assert all(a < b for a, b in zip(thresholds, thresholds[1:]))
    least = _loss(rows, grades, weights, thresholds)
    for _ in range(60):
        for size in (0.3, 0.03):
            move = [rng.gauss(0, size) for _ in range(width + steps)]
            axis = rng.randrange(width + steps)
            for step in (move, [m if i == axis else 0.0 for i, m in enumerate(move)]):
                w = [a + b for a, b in zip(weights, step)]
                t = [a + b for a, b in zip(thresholds, step[width:])]
                if t == sorted(t):
                    assert _loss(rows, grades, w, t) > least - 1e-5


def test_scores_by_hand(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = severity.train(docs, labels)
    got = {r.doc_id: r for r in severity.severity(docs, labels).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and model.number
    for r in rows:
        present = {f for w in word_list(r.text) for f in severity.features_of(w)}
        score = sum(model.weights[model.number[f]] for f in present if f in model.number)
        steps = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        mine = got[r.doc_id]
        assert mine.score == pytest.approx(score, abs=1e-9)
        assert [mine.p1, mine.p2, mine.p3] == pytest.approx(steps, abs=1e-9)
        assert mine.expected_severity == pytest.approx(sum(steps), abs=1e-9)
        assert mine.grade == sum(p > 0.5 for p in steps) and mine.toxic == (sum(steps) >= severity.ABUSIVE)
