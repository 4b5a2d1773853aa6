"""Whitening against a plain computation in whole numbers and double precision."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SF = "/root/testdata/sf0.01"


def units(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def plain(vectors):
    """Units of each vector, and of the distinct ones: number, sums, covariance as fractions."""
    distinct = sorted({tuple(units(v)) for v in vectors})
    n = len(distinct)
    total = [sum(column) for column in zip(*distinct)]
    mean = [Fraction(s, n) for s in total]
    cov = [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in distinct) / n for j in range(len(mean))]
           for i in range(len(mean))]
    return n, total, cov


def check(rows, vectors, components=16):
    """``rows`` (id, component, n, deviation, whitened, explained, error) against the vectors by id."""
    n, total, cov = plain(vectors.values())
    wide = np.array([[float(v) for v in row] for row in cov])
    values = np.linalg.eigvalsh(wide)[::-1]
    kept = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == kept * len(vectors)
    by_id = {}
    for key, component, *rest in rows:
        by_id.setdefault(key, {})[component] = rest
    centred = np.array([[float(Fraction(x) - Fraction(s, n)) for x, s in zip(units(v), total)] for v in vectors.values()])
    found = np.array([[by_id[key][c + 1][2] for c in range(kept)] for key in vectors])
    for key, vector in vectors.items():
        assert sorted(by_id[key]) == list(range(1, kept + 1))
        deviation = sum((n * x - s) ** 2 for x, s in zip(units(vector), total))
        assert all(row[:2] == [n, deviation] for row in by_id[key].values())
        for c in range(kept):
            assert math.isclose(by_id[key][c + 1][3], values[c] / np.trace(wide), rel_tol=1e-6)
            assert by_id[key][c + 1][4] <= 1e-9
    # the directions, solved from the rows, are unit eigenvectors
    directions = np.linalg.lstsq(centred, found * np.sqrt(values[:kept]), rcond=None)[0]
    assert np.abs(centred @ directions - found * np.sqrt(values[:kept])).max() < 1e-7 * max(1, np.abs(centred).max())
    return directions, wide, values


def run(spark, rows, kind="array<float>"):
    docs = spark.createDataFrame([(*r, "clash") for r in rows], f"vec_id long, embedding {kind}, whitened string")
    out = whitening.whiten(docs).selectExpr("vec_id", "n", "deviation", "identity_error", "posexplode(whitened) AS (c, w)",
                                            "explained").collect()
    return [(r.vec_id, r.c + 1, r.n, r.deviation, r.w, r.explained[r.c], r.identity_error) for r in out]


def test_query_on_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    found = queries.queries()["op12_whitened"](spark, SF)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    directions, cov, values = check([tuple(r) for r in found.collect()], {r.vec_id: r.embedding for r in rows})
    assert np.abs(cov @ directions - directions * values[:16]).max() < 1e-8 * values[0]


def test_repeats_count_once_and_bad_rows_go(spark):
    rng = np.random.default_rng(5)
    good = {i: rng.normal(size=3).astype(np.float32).tolist() for i in range(40)}
    good |= {40 + i: good[0] for i in range(200)}
    bad = [(900, None), (901, [1.0, None, 2.0]), (902, [1.0, float("nan"), 2.0]), (903, [float("inf"), 0.0, 0.0]),
           (904, []), (905, [1.0]), (906, [1.0, 2.0, 3.0, 4.0])]
    found = run(spark, [*good.items(), *bad])
    check(found, good)
    assert {r[2] for r in found} == {40}
    unnamed = run(spark, [(None, v) for v in good.values()])
    assert len(unnamed) == len(found) and sorted(r[4] for r in unnamed) == sorted(r[4] for r in found)


def test_large_offsets_do_not_lose_digits(spark):
    rng = np.random.default_rng(6)
    vectors = {i: (rng.normal(size=4) * 3 + 2.0e8).tolist() for i in range(60)}
    check(run(spark, list(vectors.items()), "array<double>"), vectors)
    huge = {i: [1e300 * (-1) ** i, float(i % 3), 0.0] for i in range(6)}
    found = run(spark, list(huge.items()), "array<double>")
    assert {r[0] for r in found} == set(huge) and all(r[3] is None and math.isfinite(r[4]) for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert run(spark, rows) == []


def test_dimensions_without_spread_have_no_component(spark):
    vectors = {i: [float(i), 2.0 * i, 7.0, float(i * i % 5)] for i in range(30)}
    found = run(spark, list(vectors.items()))
    assert {r[1] for r in found} == {1, 2}
    check(found, vectors)


def orthonormal(rng, width):
    held = rng.normal(size=(width, width)).astype(np.longdouble)
    for i in range(width):
        for _ in range(3):
            held[:, i] -= held[:, :i] @ (held[:, :i].T @ held[:, i])
            held[:, i] /= np.sqrt((held[:, i] ** 2).sum())
    return held


@pytest.mark.parametrize("gap", [1e-3, 1e-8, 1e-12, 0.0])
def test_clustered_eigenvalues(gap):
    rng = np.random.default_rng(11)
    width = 24
    values = np.sort(rng.uniform(1, 9, width).astype(np.longdouble))[::-1].copy()
    values[3:8] = 5 + gap * np.arange(5, 0, -1, dtype=np.longdouble)
    values = np.sort(values)[::-1]
    true = orthonormal(rng, width)
    matrix = (true * values) @ true.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigen(matrix)
    assert np.abs(found - values.astype(float)).max() < 1e-14
    assert np.abs(vectors.T @ vectors - np.eye(width)).max() < 1e-14
    assert np.abs((matrix @ vectors - vectors * found).astype(float)).max() < 1e-13
    if gap:
        agree = np.abs((true.T @ vectors).astype(float))
        assert np.abs(agree - np.eye(width)).max() < max(1e-14, 1e-16 / gap)


def test_float32_start_alone_would_not_do():
    rng = np.random.default_rng(12)
    base = rng.normal(size=(50, 12))
    matrix = (base.T @ base).astype(np.longdouble)
    rough = np.linalg.eigh(matrix.astype(np.float32))[1].astype(float)
    fine = whitening.eigen(matrix)[1]
    rest = lambda x: np.abs(x.T @ x - np.eye(12)).max()
    assert rest(fine) < 1e-15 * 4 < 1e-8 < rest(rough)
