"""Clusters, nearest neighbours and whitening against brute force, and their special cases."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from stopclock.llm import centroids, cross_polytope, whitening

SCHEMA = "vec_id bigint, embedding array<float>, x int, key string, vector string, block int, id int"


def frame(spark, rows, schema=SCHEMA):
    """Rows of (id, vector), beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, v, 1, "k", "v", 2, 3) for i, v in rows], schema)


def unit(seed: int, n: int, d: int = 64) -> np.ndarray:
    x = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def listed(matrix) -> list[list[float]]:
    return [[float(c) for c in row] for row in matrix]


UNUSABLE = [
    (900, None),
    (901, []),
    (902, [0.5] * 63 + [float("nan")]),
    (903, [0.5] * 63 + [float("inf")]),
    (904, [0.5] * 63 + [None]),
]


# --- clusters -------------------------------------------------------------------------------


def test_bit_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for top in (1, 2, 700, (1 << 27) - 1):
        v = rng.integers(-top, top + 1, (50, 64))
        c = rng.integers(-top, top + 1, (3, 64))
        planes, marks = centroids.bit_planes(v), centroids.bit_planes(c)
        assert centroids.squares(planes).tolist() == (v * v).sum(axis=1).tolist()
        for k in range(3):
            assert centroids.dots(planes, marks[:, k]).tolist() == (v @ c[k]).tolist()
        best, least = centroids.nearest(planes, centroids.squares(planes), c)
        far = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        assert best.tolist() == far.argmin(axis=1).tolist() and least.tolist() == far.min(axis=1).tolist()


def brute_clusters(rows):
    rows = [(i, [int(np.floor(1024 * np.float64(np.float32(c)))) for c in v]) for i, v in rows]
    marked = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in rows if i is not None)
    places = [x for _, x in marked[:8]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(places))

    for _ in range(10):
        mine = {}
        for _, x in rows:
            mine.setdefault(best(x)[1], []).append(x)
        places = [[sum(col) // len(mine[k]) for col in zip(*mine[k])] if k in mine else c for k, c in enumerate(places)]
    return sorted(((i is None, i), *best(x)[::-1], places[best(x)[1]]) for i, x in rows)


def test_clusters_are_those_of_plain_rounds(spark):
    plain = [(i, v) for i, v in enumerate(listed(unit(2, 120) * 3))]
    copies = [(200 + i, plain[5][1]) for i in range(60)] + [(7, plain[8][1]), (7, plain[8][1]), (None, plain[9][1])]
    short = [(905, [0.1] * 63), (906, [0.1] * 65)]
    rows = plain + copies
    got = centroids.cluster(frame(spark, rows + UNUSABLE + short)).collect()
    assert sorted(((r.vec_id is None, r.vec_id), r.cluster, r.distance, list(r.centroid)) for r in got) == brute_clusters(rows)
    spread = {}
    for r in got:
        spread[r.cluster] = spread.get(r.cluster, 0) + r.distance
    assert all(r.cluster_inertia == spread[r.cluster] and r.inertia == sum(spread.values()) for r in got)


def test_few_vectors_ties_and_none(spark):
    same = [(i, [0.25] * 64) for i in range(20)]
    got = centroids.cluster(frame(spark, same)).collect()
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)} and len(got) == 20
    two = centroids.cluster(frame(spark, same[:1] + [(5, [-0.25] * 64)])).collect()
    assert {r.distance for r in two} == {0} and len({r.cluster for r in two}) == 2
    assert centroids.cluster(frame(spark, UNUSABLE)).collect() == []
    assert centroids.cluster(frame(spark, [])).collect() == []
    assert centroids.cluster(frame(spark, [(None, [0.5] * 64)])).collect() == []


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(frame(spark, [(1, [1e9] * 64)])).collect()


# --- nearest neighbours ---------------------------------------------------------------------


def brute_neighbours(rows, queries, k=10):
    out = {}
    for q, v in queries:
        gap = [(float(np.sqrt(np.square(np.array(v) - np.array(w)).sum())), i) for i, w in rows if i != q]
        out[q] = sorted(set(gap))[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_rotations_keep_lengths_and_angles():
    x = unit(3, 40).T
    y = cross_polytope.rotate(x, cross_polytope.signs(64, 1)[0]) / 64**1.5
    assert np.allclose(y.T @ y, x.T @ x, atol=1e-5)
    own = cross_polytope.hashes(x.T, 8)
    assert (cross_polytope.probes_of(x.T, 3, 8)[:, :, 0] == own).all()


def test_lookups_fall_with_the_rows():
    counts = [sum(cross_polytope.probe_counts(n)) for n in (0, 1, 500, 2_000, 50_000, 10**6, 10**9)]
    assert counts == sorted(counts, reverse=True) and counts[2] == 160 and counts[-1] >= 1
    assert all(0 not in cross_polytope.probe_counts(n) for n in (1, 500, 10**6, 10**12))


@pytest.mark.parametrize("n", [300, 3000])
def test_recall_of_vectors_without_structure(spark, n):
    rows = list(enumerate(listed(unit(4, n))))
    queries = rows[:: n // 60]
    want, got = brute_neighbours(rows, queries), found(cross_polytope.search(frame(spark, rows), frame(spark, queries)))
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.93 * 10 * len(want)
    exact = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        assert len(near) == 10
        for score, i in near:
            assert score == pytest.approx(float(np.linalg.norm(exact[q] - exact[i])), abs=1e-12)


def test_unrelated_rows_do_not_change_what_is_found(spark):
    rows = list(enumerate(listed(unit(4, 300))))
    others = [(10_000 + i, [float(i), 1.0]) for i in range(20_000)]  # of another length: they never meet
    alone, among = (
        found(cross_polytope.search(frame(spark, r), frame(spark, rows[::10]), lookups=32)) for r in (rows, rows + others)
    )
    assert alone == among


def test_every_bucket_probed_is_brute_force_whatever_the_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.integers(-2, 3, (400, 8)))]  # many ties
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [rows[3], rows[3], (3, rows[4][1])]
    rows = [r for r in rows if any(r[1])]
    queries = [r for r in rows if r[0] % 20 == 0 or r[0] == 7]
    want = brute_neighbours(rows, queries)
    for size in (1 << 24, 400):
        got = cross_polytope.search(frame(spark, rows + [(2000, [0.0] * 8)]), frame(spark, queries), lookups=4000, block_values=size)
        assert found(got) == want


def test_unlike_rows_stay_apart(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.5, 0.5, 0.1]), (None, [1.0, 0.0]), (3, [0.0, 0.0]), *UNUSABLE]
    got = found(cross_polytope.search(frame(spark, rows), frame(spark, rows)))
    assert {q: [i for _, i in near] for q, near in got.items()} == {0: [1], 1: [0]}
    none = frame(spark, [])
    assert cross_polytope.search(none, none).collect() == []
    assert cross_polytope.search(frame(spark, rows), none).collect() == []
    assert cross_polytope.search(none, frame(spark, rows)).collect() == []


def test_equal_distances_beyond_the_settled_number(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "TIED", 8)
    corners = [[float(2 * (i >> b & 1) - 1) for b in range(8)] + [1.0] * 8 for i in range(256)]
    rows = [(i, [c[j] if j < 8 else c[j] * (1 + i % 2) for j in range(16)]) for i, c in enumerate(corners)]
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32)
    block = cross_polytope.Block(ids, matrix, 10, 4, 7)
    q, near, space = block.search(ids[:20], matrix[:20], [32] * 4)
    want = brute_neighbours(rows, rows[:20])
    for k in range(20):
        assert list(zip(space[q == k].tolist(), near[q == k].tolist())) == want[k]


# --- whitening ------------------------------------------------------------------------------


def check_components(matrix, count):
    values, rows = whitening.leading_components(matrix, count)
    want = np.linalg.eigvalsh(matrix)[::-1][:count]
    size = np.abs(np.linalg.eigvalsh(matrix)).max() or 1.0
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-12
    assert np.abs(matrix @ rows.T - rows.T * values).max() <= 1e-12 * size


def test_eigenvectors_of_symmetric_matrices():
    rng = np.random.default_rng(6)
    for d in (1, 2, 3, 8, 40):
        a = rng.normal(size=(d, d))
        check_components(a @ a.T, 8)
        q, _ = np.linalg.qr(a)
        close = np.sort(rng.random(d))[::-1].copy()
        close[: d // 2] = 1.0  # equal eigenvalues
        check_components((q * close) @ q.T, 8)
        close[: d // 2] += np.arange(d // 2) * 1e-9
        check_components((q * close) @ q.T, 8)
        check_components(np.diag(rng.integers(0, 3, d).astype(float)), 8)
    check_components(np.zeros((5, 5)), 3)
    check_components(np.ones((6, 6)), 2)


def test_sturm_counts():
    d, e = np.array([2.0, -1.0, 3.0, 0.5]), np.array([0.3, 0.0, 1.2])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    for x in (-5.0, -1.0, 0.0, 0.7, 2.0, 3.1, 9.0):
        assert whitening.below(d, e, x, 1e-30) == int((values < x).sum())


def test_whole_products_are_exact():
    rng = np.random.default_rng(7)
    for top in (3, 10**5, 10**8):
        x = rng.integers(-top, top, (300, 5))
        want = x.astype(object).T @ x.astype(object)
        assert (whitening.whole_products(x) == want).all()


def whole(v):
    return [int(np.floor(1024 * np.float64(np.float32(c)))) + 100_000 for c in v]


@pytest.mark.parametrize("d", [2, 6, 64])
def test_whitened_values(spark, d):
    rng = np.random.default_rng(d)
    rows = list(enumerate(listed(unit(8, 300, d) @ rng.normal(size=(d, d)) / 4)))
    rows += [(500 + i, rows[0][1]) for i in range(100)] + [rows[1], (None, rows[2][1])]
    got = whitening.whiten(frame(spark, rows + UNUSABLE + [(906, [0.1] * (d + 1))])).collect()
    x = np.array([whole(v) for _, v in rows])
    n, sums, k = len(x), x.sum(axis=0), min(8, d)
    covariance = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    assert len(got) == n * k and {r.n for r in got} == {n}
    want = (x - x.mean(axis=0)) @ vectors / np.sqrt(values)
    signs = {}
    by_id = {}
    for (i, _), row, w in zip(rows, x.tolist(), want):
        by_id.setdefault(i, (sum((n * a - int(b)) ** 2 for a, b in zip(row, sums)), w))
    for r in got:
        deviation, w = by_id[r.vec_id]
        assert r.deviation == deviation
        assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-9
        if abs(r.whitened) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(w[r.component - 1]))
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-10)
        assert r.identity_error < 1e-10
    assert all(len(s) == 1 for s in signs.values())


def test_directions_without_variance_are_left_out(spark):
    line = [(i, [0.1 * i, 0.2, 0.1 * i]) for i in range(30)]
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 30 and got[0].explained == pytest.approx(1)
    for rows in ([], UNUSABLE, [(1, [0.5, 0.5])], [(i, [0.5, 0.5]) for i in range(9)]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_the_most_frequent_length_counts(spark):
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(20)] + [(50 + i, [1.0 * i]) for i in range(10)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(20))
