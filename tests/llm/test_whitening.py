"""Whitening by block matrices against whole arrays in numpy and whole numbers in Python."""

from __future__ import annotations

import numpy as np
import pytest

from msgloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x int, n string"


def frame(spark, vectors, parts=3):
    rows = [(i, v, 1, "r", 2, "n") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def random_vectors(n, width, seed=0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, width)) @ rng.normal(size=(width, width)) + 3
    return mixed.astype(np.float32)


def check(got, fitted, ids, vectors, components):
    """Rows of ``components_of`` against numpy; the sign of a component may be either."""
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, turned = np.linalg.eigh(covariance)
    values, turned = values[::-1][:components], turned[:, ::-1][:, :components]
    want = centred @ turned / np.sqrt(values)
    deviations = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n and abs(r.explained - values[r.component - 1] / np.trace(covariance)) < 1e-9
        assert r.identity_error == fitted.identity_error < 1e-6
    assert len(got) == n * len(values) and len(by_row) == len(set(zip(ids, deviations)))
    signs = np.sign((fitted.components * turned).sum(axis=0))
    for key, deviation, row in zip(ids, deviations, want):
        for r in by_row[key, deviation]:
            assert abs(r.whitened * signs[r.component - 1] - row[r.component - 1]) < 1e-6


@pytest.mark.parametrize(("n", "width", "components"), [(300, 8, 8), (90, 40, 32)])
def test_rows_are_those_of_numpy(spark, n, width, components):
    vectors = random_vectors(n, width)
    ids = [None if i == 5 else i for i in range(n)]
    given = list(zip(ids, vectors.tolist()))
    bad = [(900, None), (901, []), (902, [None] * width), (903, [float("nan")] * width),
           (904, [float("inf")] + [0.0] * (width - 1)), (905, [1.0] * (width - 1)), (906, [3e38] * width)]
    rows, fitted = whitening.whiten(frame(spark, given + bad))
    got = whitening.components_of(rows, fitted).collect()
    check(got, fitted, ids, vectors, min(components, 32))


def test_blocks_of_many_rows_and_columns(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 5)
    monkeypatch.setattr(whitening, "rows_in_block", lambda width: 7)
    vectors = random_vectors(100, 12, seed=3)
    rows, fitted = whitening.whiten(frame(spark, list(enumerate(vectors.tolist())), 4), components=6)
    check(whitening.components_of(rows, fitted).collect(), fitted, list(range(100)), vectors, 6)


def test_repeated_rows_and_no_variance(spark):
    vectors = random_vectors(30, 4, seed=1)
    vectors[:, 2] = 1.5  # no variance: one component less
    given = list(enumerate(vectors.tolist()))
    rows, fitted = whitening.whiten(frame(spark, given + given[:10]))
    assert rows.count() == 40 and len(fitted.eigenvalues) == 3 and fitted.identity_error < 1e-9
    same = {}
    for r in rows.collect():
        same.setdefault(r.id, set()).add((r.deviation, tuple(np.round(r.whitened, 9))))
    assert all(len(v) == 1 for v in same.values())


def test_numbers_beyond_64_bits_are_exact(spark):
    given = [(1, [2.0**43, 0.0]), (2, [-(2.0**43), 1.0]), (3, [0.0, 5.0])]
    rows, _ = whitening.whiten(frame(spark, given))
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v in given]
    sums = [sum(c) for c in zip(*x)]
    want = {k: sum((3 * c - s) ** 2 for c, s in zip(row, sums)) for (k, _), row in zip(given, x)}
    assert {r.id: int(r.deviation) for r in rows.collect()} == want


@pytest.mark.parametrize("given", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_tables_without_variance(spark, given):
    rows, fitted = whitening.whiten(frame(spark, given, 1))
    assert fitted is None and rows.count() == 0 and whitening.components_of(rows, fitted).count() == 0
