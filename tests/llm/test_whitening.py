import numpy as np
import pytest

from lodestar.llm import whitening

from .test_codes import frame


def vectors(seed, n, size=48):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) * 0.3 + rng.normal(size=size)
    return [(i, v, 0) for i, v in enumerate(mixed.astype(np.float32).tolist())]


def awkward():
    rows = vectors(1, 300)
    rows += [(400, None, 1), (401, [], 1), (402, [float("nan")] * 48, 1), (403, [1.0] * 47 + [float("-inf")], 2),
             (404, [None] * 48, 2), (405, [1.0] * 16, 3), (None, [0.25] * 48, None)]
    return rows + [rows[7], rows[7], (500, rows[8][1], 0)]


def brute(rows, components=32):
    good = [(i, v) for i, v, _ in rows if v and len(v) == 48 and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(64 * np.array([v for _, v in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return [i for i, _ in good], n, ((n * x - s) ** 2).sum(1), c @ u[:, :components] / np.sqrt(e[:components]), (e / e.sum())[:components]


def test_awkward_rows_against_brute_force(spark):
    got = whitening.whiten(frame(spark, awkward()).repartition(7)).collect()
    ids, n, deviation, white, explained = brute(awkward())
    assert len(got) == len(ids) * 32
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = np.ones(32)
    for row, i in enumerate(ids):
        found = by_id[i]
        assert sorted(found) == list(range(1, 33)) and {len(x) for x in found.values()} == {ids.count(i)}
        assert {r.deviation for x in found.values() for r in x} == {deviation[row]}
        values = np.array([found[c][0].whitened for c in range(1, 33)])
        if not row:
            signs = np.sign(values * white[0])
        assert np.allclose(values * signs, white[row], atol=1e-8)
        assert np.allclose([found[c][0].explained for c in range(1, 33)], explained, rtol=1e-10)


def test_directions_without_variance_have_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).count() == 0
    line = [(i, [float(i), 2.0 * i, 5.0], 0) for i in range(10)]
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 10
    assert abs(got[0].explained - 1) < 1e-12 and got[0].identity_error < 1e-10


def test_factor_tree_has_several_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_STACK", 1)  # two factors a task
    want = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(frame(spark, vectors(2, 200)).coalesce(1)).collect()}
    for r in whitening.whiten(frame(spark, vectors(2, 200)).repartition(13)).collect():
        assert abs(r.whitened - want[r.vec_id, r.component]) < 1e-8


def test_deviation_beyond_64_bits_is_null():
    centre = whitening._Centre(1 << 28, [0, 0], 64, 0)
    assert centre.deviations(np.array([[12, 1], [2, 3]])).to_pylist() == [None, 13 << 56]
    assert centre.deviations(np.array([[1, 1], [2, 3]])).to_pylist() == [2 << 56, 13 << 56]


@pytest.mark.parametrize("kind", ["random", "graded", "clustered", "split", "equal", "zero"])
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(5)
    n = 40
    r = np.triu(rng.normal(size=(n, n)))
    if kind == "graded":
        r *= 10.0 ** -np.linspace(0, 8, n)[:, None]
    elif kind == "clustered":
        q, _ = np.linalg.qr(rng.normal(size=(n, n)))
        r = np.linalg.qr(np.diag(np.repeat([1.0, 1 + 1e-9, 3.0, 3 + 1e-13, 7.0], 8)) @ q, mode="r")
    elif kind == "split":
        r[:20, 20:] = 0
    elif kind == "equal":
        r = np.eye(n) * 2.5
    elif kind == "zero":
        r[:, 5] = 0
        r[30:, :] = 0
    vectors, squares, total = whitening.directions(r, n)
    want = np.linalg.svd(r, compute_uv=False)
    want = want[want > 1e-10 * want[0]]
    assert len(squares) == len(want)
    assert np.allclose(np.sqrt(squares), want, rtol=1e-11, atol=1e-14 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-9
    assert np.abs(r.T @ (r @ vectors) - vectors * squares).max() < 1e-10 * squares[0]
    assert np.isclose(total, (want ** 2).sum())


def test_small_singular_values_keep_their_digits():
    diagonal, above = 10.0 ** -np.arange(0.0, 30, 2), np.full(14, 1e-40)
    found = whitening.squared_singular_values(diagonal, above)
    assert np.allclose(found, diagonal ** 2, rtol=1e-12, atol=0)
