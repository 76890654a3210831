import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcurate.llm import forest_search, whitening

S = "vec_id long, embedding array<float>, label int, x string, row string, component string"


def table(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", "r", "c") for i, v in zip(ids, vectors, strict=True)], S)


def whole(vectors):
    return [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]


def brute_whitening(vectors, most=16):
    """x of each vector, the fit list's size and sums, eigenvalues and vectors by falling eigenvalue."""
    x = whole(vectors)
    fit = np.array(sorted(set(x)), dtype=float)
    centred = fit - fit.mean(0)
    e, v = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, len(fit), np.array(sorted(set(x)), dtype=object).sum(0), e[::-1][:most], v[:, ::-1][:, :most], e.sum()


def check_whitening(got, vectors, ids, most=16):
    x, n, sums, e, v, trace = brute_whitening(vectors, most)
    k = int((e > 1e-12 * trace).sum())
    assert len(got) == k * len(vectors)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    signs = {}
    for i, xi in zip(ids, x, strict=True):
        rows = by[i]
        assert sorted(rows) == list(range(1, k + 1))
        for c, r in rows.items():
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(xi, sums, strict=True))
            expected = float((np.array(xi, float) - np.array([s / n for s in sums])) @ v[:, c - 1] / math.sqrt(e[c - 1]))
            sign = signs.setdefault(c, 1 if abs(expected) < 1e-3 or r.whitened * expected > 0 else -1) if abs(expected) > 1e-3 else signs.get(c, 1)
            assert abs(expected) <= 1e-3 or abs(r.whitened - sign * expected) < 1e-6
            assert r.explained == pytest.approx(e[c - 1] / trace, rel=1e-9) and r.identity_error < 1e-8


def test_whitening(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 40)) * np.linspace(1, 3, 40)).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:50], np.repeat(vectors[:1], 100, axis=0)])
    got = whitening.whiten(table(spark, vectors).repartition(5)).collect()
    check_whitening(got, vectors, range(len(vectors)))


def test_whitening_of_many_dimensions(spark):
    """More dimensions than three blocks span, so that it takes steps."""
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((400, 150)) * np.geomspace(4, 0.5, 150)).astype(np.float32)
    got = whitening.whiten(table(spark, vectors)).collect()
    check_whitening(got, vectors, range(len(vectors)))


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1, 2, 3], [1, 2, 3], [0, 5, -1], [2, 2, 2.5], [7, 1, 0]]
    rows = [*good, None, [], [1, None, 2], [nan, 1, 2], [1, inf, 2], [1, 2], [-inf, 0, 0]]
    got = whitening.whiten(table(spark, rows)).collect()
    check_whitening([r for r in got], good, range(5))
    got = whitening.whiten(table(spark, good + good[:2], ids=[None, 4, 4, 5, 6, None, 7])).collect()
    assert len(got) == 7 * 3 and {r.vec_id for r in got} == {None, 4, 5, 6, 7}
    for few in ([], [None], good[:2]):
        found = whitening.whiten(table(spark, few))
        assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = [[k, 2 * k, 1, 1] for k in range(5)]  # all on one line: one component
    got = whitening.whiten(table(spark, flat)).collect()
    assert {r.component for r in got} == {1} and len(got) == 5


def test_lobpcg_certifies():
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.concatenate([[5, 5, 5, 4.9, 4.89], np.linspace(4, 0, 195)])
    matrix = (basis * values) @ basis.T
    e, x, steps = whitening.lobpcg(lambda b: matrix @ b, 200, components=8)
    assert np.abs(e - values[:8]).max() < 1e-10
    assert np.linalg.norm(matrix @ x - x * e, axis=0).max() < 1e-11 and np.abs(x.T @ x - np.eye(8)).max() < 1e-12
    with pytest.raises(ArithmeticError):
        whitening.lobpcg(lambda b: matrix @ b, 200, components=8, steps=3)


def test_deviations_are_exact():
    x = np.array([[1_000_000, 1_000_040], [999_960, 1_000_000]])
    for n in (2, 3, 1_000_000, 40_000_000, 400_000_000):
        sums = np.array([1_000_001 * n + 1, 1_000_000 * n - 1])
        for row, got in zip(x.tolist(), whitening._deviations(x, n, sums), strict=True):
            exact = sum((n * a - int(s)) ** 2 for a, s in zip(row, sums, strict=True))
            assert got == (exact if exact < 1 << 63 else None)


def brute_nearest(vectors, ids, asked, k=5):
    """{(query, vector): [(score, id)...]}, of rows that differ in id or vector."""
    rows = sorted({(i is None, i or 0, tuple(map(float, np.float32(v)))) for i, v in zip(ids, vectors, strict=True)})
    out = {}
    x = np.array([r[2] for r in rows])
    for n, (none, i, v) in enumerate(rows):
        if not none and asked(i):
            s = (x * np.array(v)).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((np.array(v) ** 2).sum()))
            order = sorted((-s[m], rows[m][0], rows[m][1]) for m in range(len(rows)) if m != n)[:k]
            out[i, v] = [(-a, None if b else c) for a, b, c in order]
    return out


def by_query(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_forest_finds_neighbours(spark, monkeypatch):
    """Recall against brute force, on noise and on clusters, with groups cut into pieces; what is found has the exact score."""
    monkeypatch.setattr(forest_search, "POINTS", 70)
    monkeypatch.setattr(forest_search, "VISITS", 5)
    monkeypatch.setattr(forest_search, "FIT_ROWS", 400)
    rng = np.random.default_rng(4)
    noise = rng.standard_normal((700, 12))
    near = np.repeat(rng.standard_normal((15, 12)) * 3, 60, axis=0) + rng.standard_normal((900, 12)) * 0.3
    vectors = np.concatenate([noise, near, np.repeat(noise[:2], 300, axis=0)]).astype(np.float32)
    ids = list(range(len(vectors)))
    got = forest_search.nearest(table(spark, vectors, ids).repartition(6), F.col("vec_id") % 10 == 0, leaf=40).collect()
    truth = {i: x for (i, _), x in brute_nearest(vectors, ids, lambda i: i % 10 == 0).items()}
    found = by_query(got)
    assert set(found) == set(truth)
    hits = sum(len({i for _, i in found[q]} & {i for _, i in truth[q]}) for q in truth)
    assert hits >= 0.9 * sum(map(len, truth.values())) and got[0].recall >= 0.95
    for q, rows in found.items():
        assert len(rows) == 5 and rows == sorted(rows, key=lambda x: (-x[0], x[1])) and q not in {i for _, i in rows}
        for s, i in rows:
            a, b = vectors[q].astype(float), vectors[i].astype(float)
            assert s == pytest.approx(float(a @ b / np.sqrt((a @ a) * (b @ b))), abs=1e-14)


def test_forest_odd_rows(spark):
    nan = float("nan")
    good = [(0, [1, 0, 0]), (1, [1, 0, 0]), (2, [1, 0, 0]), (3, [0.5, 0.5, 0]), (50, [1, 0, 0]), (100, [0, 0, -2]), (100, [0, 0, 1e30]), (7, [0, 1e-30, 0]), (None, [0, 1, 0]), (None, [1, 0, 0]), (4, [1, 0, 0]), (5, [1, 0, 0]), (6, [2, 0, 0]), (1, [1, 0, 0])]
    bad = [(150, None), (200, []), (8, [0, 0, 0]), (9, [1, None, 1]), (10, [nan, 1, 1]), (11, [float("inf"), 1, 1]), (12, [1, 2])]
    ids, vectors = zip(*good, *bad, strict=True)
    got = forest_search.nearest(table(spark, vectors, ids), F.col("vec_id") % 50 == 0).collect()
    truth = brute_nearest([v for _, v in good], [i for i, _ in good], lambda i: i % 50 == 0)
    expected = Counter((i, rank, j, round(s, 12)) for (i, _), rows in truth.items() for rank, (s, j) in enumerate(rows, 1))
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in got) == expected
    two = forest_search.nearest(table(spark, [[1, 2], [2, 1]], [50, 3]), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in two] == [(50, 1, 3)]
    for few, ids in (([], []), ([None], [50]), ([[1, 2]], [50]), ([[1, 2], [3, 4]], [1, 2])):
        found = forest_search.nearest(table(spark, few, ids), F.col("vec_id") % 50 == 0)
        assert found.columns == ["query_id", "rank", "vec_id", "score", "recall"] and found.collect() == []


def test_one_queue_opens_all_leaves():
    rng = np.random.default_rng(8)
    rows = forest_search.unit(rng.standard_normal((500, 6)))
    forest = [forest_search.grown(rows, seed, 30) for seed in range(3)]
    sizes = [np.bincount(forest_search.leaf_of(t, rows), minlength=t.leaves) for t in forest]
    assert all(s.sum() == 500 and s.max() <= 30 for s in sizes)
    met = list(forest_search.visited(forest, sizes, rows[3], float("inf"), 0))
    assert len({(t, leaf) for t, leaf, _ in met}) == sum(t.leaves for t in forest) and met[-1][2] == 1500
    # the own leaves come first, in order of nothing between
    assert {(t, leaf) for t, leaf, _ in met[:3]} == {(t, int(forest_search.leaf_of(tree, rows[3:4])[0])) for t, tree in enumerate(forest)}
