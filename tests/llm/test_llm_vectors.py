"""Whitening and near-duplicate vectors, against numpy over all rows."""

import math

import numpy as np
import pytest

from graphloom.llm import nn_descent, qdwh_whitening
from graphloom.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["spread", "pairs", "half zero", "graded", "tight", "equal"])
def test_divide_finds_eigenvectors(n, kind):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    e = {
        "spread": rng.random(n) * 10, "pairs": np.repeat(rng.random((n + 1) // 2), 2)[:n], "graded": 10.0 ** -np.arange(n),
        "half zero": np.r_[np.zeros(n // 2), rng.random(n - n // 2)], "tight": 1 + np.arange(n) * 1e-9, "equal": np.ones(n),
    }[kind]
    a = q * e @ q.T
    a = (a + a.T) / 2
    values, vectors = qdwh_whitening.divide(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * 10
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13 and np.abs(a @ vectors - vectors * values).max() < 1e-12


def test_polar_factor_is_orthogonal():
    a = np.random.default_rng(2).standard_normal((30, 30))
    a = a + a.T
    u, _, v = np.linalg.svd(a)
    assert np.abs(qdwh_whitening.polar_factor(a) - u @ v).max() < 1e-11


def whitened_by_hand(vectors, components=32):
    """vec_id, component -> (n, deviation, whitened, explained), by numpy's own eigenvectors."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = (n * x - s).astype(float) / n
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    w = centred @ v / np.sqrt(np.where(e > 1e-9 * e[0], e, np.inf))
    return {
        (i, k + 1): (n, int(deviation[r]), w[r, k], e[k] / np.trace(cov))
        for r, (i, _) in enumerate(kept) for k in range(min(components, len(e))) if e[k] > 1e-9 * e[0]
    }


def assert_whitened(rows, expected):
    assert {(r.vec_id, r.component) for r in rows} == set(expected) and len(rows) == len(expected)
    sign = {}
    for r in sorted(rows, key=lambda r: -abs(r.whitened)):
        n, deviation, whitened, explained = expected[(r.vec_id, r.component)]
        sign.setdefault(r.component, 1.0 if r.whitened * whitened >= 0 else -1.0)
        assert (r.n, r.deviation) == (n, deviation)
        assert r.whitened == pytest.approx(sign[r.component] * whitened, abs=1e-8)
        assert r.explained == pytest.approx(explained, rel=1e-9) and 0 <= r.identity_error < 1e-4
    assert len({r.identity_error for r in rows}) <= 1


def test_whitening_query(spark, folder):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    rows = QUERIES["op11_qdwh_whitening"](spark, folder).collect()
    assert_whitened(rows, whitened_by_hand(vectors))


CLASHING = "vec_id long, embedding array<float>, label int, _v int, n int, component int, whitened int, total int"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, *[7] * 6) for i, v in rows], CLASHING)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.standard_normal(5)]) for i in range(60)]
    rows += [rows[0], rows[1], (100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4)]
    odd = [(104, []), (105, [1.0, 2.0])]  # no length that the fit has
    got = qdwh_whitening.whiten(_vectors(spark, rows + odd)).collect()
    by_hand = whitened_by_hand(rows)
    assert len(got) == 62 * 5 and {(r.vec_id, r.component) for r in got} == set(by_hand)
    assert all(r.deviation == by_hand[(r.vec_id, r.component)][1] and r.n == 62 for r in got)
    assert all(abs(abs(r.whitened) - abs(by_hand[(r.vec_id, r.component)][2])) < 1e-8 for r in got)


def test_whitening_of_little(spark):
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(8)]  # one direction only
    got = qdwh_whitening.whiten(_vectors(spark, flat)).collect()
    assert {r.component for r in got} == {1} and all(r.explained == pytest.approx(1.0) for r in got)
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]):
        assert qdwh_whitening.whiten(_vectors(spark, few)).collect() == []
    huge = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])]
    assert len(qdwh_whitening.whiten(_vectors(spark, huge)).collect()) >= 3


def near_by_hand(rows, threshold=0.95):
    """Place -> (n_links, component_id, kept) by all pairs. A null id is larger than all."""
    def norm(v):
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            return None
        v = np.array(v, float)
        return v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) if v.any() else None

    units = [norm(v) for _, v in rows]
    widths = [len(u) for u in units if u is not None]
    width = max(set(widths), key=lambda w: (widths.count(w), w), default=0)
    units = [u if u is not None and len(u) == width else None for u in units]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    usable = [i for i, u in enumerate(units) if u is not None]
    z = np.array([units[i] for i in usable]) if usable else np.zeros((0, 1))
    near = z @ z.T >= threshold
    for a, i in enumerate(usable):
        links[i] = int(near[a].sum()) - 1
        for b in np.flatnonzero(near[a]):
            root[find(usable[b])] = find(i)
    least = {}
    for i, (name, _) in enumerate(rows):
        r = find(i)
        least[r] = name if r not in least or least[r] is None else least[r] if name is None else min(least[r], name)
    return sorted(
        ((name, links[i], least[find(i)], name == least[find(i)]) for i, (name, _) in enumerate(rows)), key=str
    )


def near_found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_near_vectors_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert near_found(QUERIES["op12_nn_descent"](spark, folder)) == near_by_hand(rows)


def test_near_vectors_of_pairs_chains_and_dense_groups(spark):
    """Pairs, chains, a tight group larger than any list, and a wide one whose members are not all linked."""
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v)
    vectors = [unit(rng.standard_normal(24)) for _ in range(500)]
    for spread, count in ((0.03, 60), (0.075, 80)):
        centre = unit(rng.standard_normal(24))
        vectors += [unit(centre + spread * rng.standard_normal(24)) for _ in range(count)]
    for v in vectors[:60]:
        vectors.append(unit(v + 0.04 * rng.standard_normal(24)))
    a, b = unit(rng.standard_normal(24)), unit(rng.standard_normal(24))
    vectors += [unit(np.cos(t) * a + np.sin(t) * b) for t in np.arange(0, 1.5, 0.2)]
    order = rng.permutation(len(vectors))
    rows = [(int(order[i]), [float(c) for c in v]) for i, v in enumerate(vectors)]
    got = nn_descent.near_vectors(_vectors(spark, rows))
    exact = near_by_hand([(i, [float(np.float32(c)) for c in v]) for i, v in rows])
    assert near_found(got) == exact and got.select("recall").distinct().count() == 1
    assert max(n for _, n, _, _ in exact) >= 59


def test_near_vectors_of_odd_rows(spark):
    same = [0.5, -0.25, 1.0]
    rows = [
        (5, same), (3, same), (3, same), (None, same), (7, [1.0, -0.5, 2.0]), (1, [0.0, 0.0, 0.0]), (2, None), (4, [float("nan"), 1.0, 1.0]),
        (6, [None, 1.0, 1.0]), (8, [1.0, 2.0]), (9, []), (None, [0.0, 1.0, 0.0]), (10, [1e-30, 2e-30, -3e-30]), (11, [1e30, 2e30, -3e30]),
        (12, [float("inf"), 0.0, 0.0]),
    ]
    stored = [(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    assert near_found(nn_descent.near_vectors(_vectors(spark, rows))) == near_by_hand(stored)
    assert near_found(nn_descent.near_vectors(_vectors(spark, []))) == []
    assert near_found(nn_descent.near_vectors(_vectors(spark, [(1, None)]))) == [(1, 0, 1, True)]
    assert near_found(nn_descent.near_vectors(_vectors(spark, [(1, [2.0])]))) == [(1, 0, 1, True)]
