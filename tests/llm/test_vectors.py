from __future__ import annotations

import math

import numpy as np
import pytest
from tests.llm.helpers import empty
from tidemark.llm import vector_codes, vectors, whitening
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, component int, x string, error long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, None, None, None) for i, v, y in rows], SCHEMA)


def written(spark, path, rows):
    table(spark, rows).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


ODD = [(900, None, 1), (901, [1.0, None, 0.0, 0.0] * 4, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [0.0] * 15, 1), (904, [], 2), (905, [1.0] * 5, 2)]


def some_rows(n, d=16, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((d, d))
    return [(i, (rng.standard_normal(d) @ mix).round(3).tolist(), int(i % 3) or None) for i in range(n)]


def expected_whitening(rows, most=16):
    """Brute force: eigenvectors of the covariance matrix."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in np.float32(v)] for v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (fit * n - s) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    rank = int((values > 1e-12 * values[0]).sum())
    k = min(most, rank)
    far = x * n - s
    return n, (far**2).sum(axis=1), (far / n) @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check_whitening(out, rows):
    n, deviation, white, share = expected_whitening([v for _, v, _ in rows])
    by = {}
    for r in out:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert {r.n for r in out} == {n} and len(out) == len(rows) * len(share)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    got = np.array([[by[i][c + 1].whitened for c in range(len(share))] for i, _, _ in rows])
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-7
    assert all(by[i][1].deviation == d for (i, _, _), d in zip(rows, deviation.tolist(), strict=True))
    assert all(abs(by[rows[0][0]][c + 1].explained / s - 1) < 1e-9 for c, s in enumerate(share))


def test_whitening_equals_eigenvectors(spark, tmp_path):
    rows = some_rows(300, 24)
    twice = [*rows, *((1000 + i, v, y) for i, v, y in rows[:50])]
    odd = [(i, v if v is None or len(v) != 16 else [*v, *v][:24], y) for i, v, y in ODD]
    out = QUERIES["op11_whitening"](spark, written(spark, tmp_path, twice + odd)).collect()
    check_whitening(out, twice)


def test_whitening_of_dependent_and_constant_coordinates(spark, tmp_path):
    rows = [(i, [*v[:6], 0.5, *v[:4]], y) for i, v, y in some_rows(80, 6)]
    out = QUERIES["op11_whitening"](spark, written(spark, tmp_path / "a", rows)).collect()
    assert max(r.component for r in out) == 6
    check_whitening(out, rows)
    few = some_rows(4, 20)
    out = QUERIES["op11_whitening"](spark, written(spark, tmp_path / "b", few)).collect()
    assert max(r.component for r in out) == 3
    check_whitening(out, few)


def test_whitening_without_variance(spark, tmp_path):
    assert QUERIES["op11_whitening"](spark, written(spark, tmp_path / "a", [])).count() == 0
    assert QUERIES["op11_whitening"](spark, written(spark, tmp_path / "b", ODD[:4])).count() == 0
    same = QUERIES["op11_whitening"](spark, written(spark, tmp_path / "c", [(1, [0.5] * 4, 1), (None, [0.5] * 4, 1)]))
    assert same.count() == 0 and same.columns[:2] == ["vec_id", "component"]


def test_whitening_of_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").orderBy("vec_id").collect()]
    out = QUERIES["op11_whitening"](spark, SF).collect()
    check_whitening(out, [(i, v, y) for i, v, y in rows])


@pytest.mark.parametrize("seed", range(8))
def test_singular_values_and_directions(seed):
    """Against the library's, with values that are graded, equal, zero and split."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 40))
    a = rng.standard_normal((n, n))
    if seed % 4 == 1:
        a *= np.logspace(0, -6, n)
    if seed % 4 == 2:
        u, _, v = np.linalg.svd(a)
        a = u * np.repeat([3.0, 1.0], [n // 2, n - n // 2]) @ v
    if seed % 4 == 3:
        a[:, : n // 2] = 0
    diagonal, beside, right = whitening.bidiagonal(np.linalg.qr(a)[1])
    values, z = whitening.directions(diagonal, beside)
    assert np.allclose(np.sqrt(np.maximum(values, 0)), np.linalg.svd(a)[1], rtol=1e-11, atol=1e-13)
    axes = right @ z
    assert np.abs(axes.T @ axes - np.eye(n)).max() < 1e-9
    assert np.abs(a.T @ a @ axes - axes * values).max() < 1e-10 * max(1, values[0])


def test_triangles_join_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = spark.createDataFrame([(v,) for v in np.random.default_rng(3).integers(-50, 50, (200, 5)).tolist()], "x array<long>").repartition(7)
    n, sums = whitening.column_sums(rows)
    r = whitening.reduced(rows, n, sums)
    x = np.array([r.x for r in rows.collect()], dtype=float)
    assert n == 200 and np.allclose(r.T @ r, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)))


def expected_codes(rows, entries=64, rounds=2, parts=16):
    """Brute force: every part against every entry."""
    kept = sorted(((i, tuple(math.floor(256 * c) for c in np.float32(v)), y) for i, v, y in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept]).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for again in range(rounds + 1):
        distance = [((x[:, p, None] - books[p][None]) ** 2).sum(axis=-1) for p in range(parts)]
        codes = [d.argmin(axis=1) for d in distance]
        if again < rounds:
            for p in range(parts):
                for e in set(codes[p].tolist()):
                    books[p][e] = x[codes[p] == e, p].sum(axis=0) // (codes[p] == e).sum()
    error = sum(d.min(axis=1) for d in distance)
    total: dict = {}
    for (_, _, y), e in zip(kept, error.tolist(), strict=True):
        total[y] = total.get(y, 0) + e
    sha = vector_codes.digest(np.stack(books))
    return sorted(((i, "".join(f"{codes[p][k]:02x}" for p in range(parts)), int(error[k]), total[y], sha) for k, (i, _, y) in enumerate(kept)), key=str)


def codes_of(spark, path):
    return sorted(map(tuple, QUERIES["op13_vector_codes"](spark, path).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def test_codes_equal_full_comparison(spark, tmp_path):
    rows = some_rows(400, 32, seed=5)
    rows += [(500 + i, v, None) for i, v, _ in rows[:40]] + [(7, rows[9][1], 4), (None, rows[3][1], 4)]
    odd = [(i, v if v is None or len(v) != 16 else v + v, y) for i, v, y in ODD]
    assert codes_of(spark, written(spark, tmp_path, rows + odd)) == expected_codes(rows)


def test_codes_of_few_equal_and_no_rows(spark, tmp_path):
    few = some_rows(5, 16, seed=6) + [(6, [0.25] * 16, 1)] * 3
    assert codes_of(spark, written(spark, tmp_path / "a", few)) == expected_codes(few)
    ties = [(i, [float(i % 2), 0.0] * 16, i % 2) for i in range(100)]
    assert codes_of(spark, written(spark, tmp_path / "b", ties)) == expected_codes(ties)
    assert codes_of(spark, written(spark, tmp_path / "c", ODD[:4])) == []


def test_balls_skip_work_and_lose_nothing():
    rng = np.random.default_rng(9)
    entries = rng.integers(-200, 200, (64, 4))
    x = entries[rng.integers(0, 64, 3000)] + rng.integers(-12, 13, (3000, 4))
    full = ((x[:, None] - entries) ** 2).sum(axis=-1)
    for start in (np.zeros(3000, np.uint8), full.argmin(axis=1).astype(np.uint8), rng.integers(0, 64, 3000).astype(np.uint8)):
        code, distance = vector_codes.nearest(x, start, entries)
        assert (code == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    big = x.astype(object) * 10**15
    code, _ = vector_codes.nearest(*vector_codes.exact(big[:50], entries.astype(object) * 10**15)[:1], np.zeros(50, np.uint8), entries.astype(object) * 10**15)
    assert (code == full[:50].argmin(axis=1)).all()


def test_vectors_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="component too large"):
        vectors.integer_vectors(table(spark, [(1, [1e30] * 16, 1)]), 256).collect()
    assert vectors.integer_vectors(empty(spark, SCHEMA), 256).count() == 0
