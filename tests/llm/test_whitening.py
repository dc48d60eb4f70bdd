"""Whitening: against NumPy over the whole table, with skew, odd rows and flat directions."""

import math

import numpy as np
import pytest

from centroidal.llm import registry
from centroidal.llm import whitening
from centroidal.llm.whitening import _deviations, whiten


def brute(rows, components=4):
    """id -> list of (n, deviation, component vector) over (id, vector) rows, from the definition."""
    kept = [(i, [math.floor(256 * float(np.float64(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    x = np.array(fit, float) - np.array([s / n for s in sums])
    cov = x.T @ x / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, row in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        white = (np.array(row) - np.array([s / n for s in sums])) @ vectors / np.sqrt(values)
        out.append((i, n, deviation, white))
    return out, values / np.trace(cov)


def compare(got, rows):
    want, explained = brute(rows)
    k = len(explained)
    assert len(got) == k * len(want)
    by_id = {}
    for r in got:
        by_id.setdefault(r["id"], []).append(r)
    signs = {}
    for i, n, deviation, white in want:
        mine = [r for r in by_id[i] if int(r["deviation"]) == deviation]
        assert mine and all(r["n"] == n and r["identity_error"] <= 1e-6 for r in mine)
        for r in mine:
            c = r["component"] - 1
            assert abs(r["explained"] - explained[c]) <= 1e-9 * explained[c]
            sign = signs.setdefault(c, np.sign(r["whitened"]) * np.sign(white[c])) if abs(white[c]) > 1e-3 else signs.get(c, 1)
            assert abs(r["whitened"] * sign - white[c]) <= 1e-8 * max(1, abs(white[c]))


def test_op11_equals_numpy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    got = registry.op11_whitening(spark, "/root/testdata/sf0.01").withColumnRenamed("vec_id", "id").collect()
    compare(got, [tuple(r) for r in rows])
    assert all(str(r["deviation"]) == r["deviation_exact"] for r in got)


@pytest.mark.parametrize("dim,per_block", [(3, 1024), (6, 7), (19, 16)])
def test_skew_odd_rows_and_small_blocks(spark, monkeypatch, dim, per_block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", per_block)
    rng = np.random.default_rng(dim)
    rows = [(int(k), (rng.normal(size=dim) * rng.uniform(0.1, 3, dim)).tolist()) for k in range(120)]
    rows += [(1000 + k, rows[5][1]) for k in range(90)]  # one vector in a third of the rows
    odd = [(None, rows[1][1]), (7, rows[7][1]), (2000, None), (2001, [None] * dim), (2002, [float("nan")] * dim),
           (2003, [math.inf] + [0.0] * (dim - 1)), (2004, []), (2005, [0.5] * (dim + 1)), (2006, [1e30] * dim)]
    frame = spark.createDataFrame([(i, v, 1, "z") for i, v in rows + odd], "vec_id long, embedding array<double>, id int, x string").repartition(3)
    got = whiten(frame).collect()
    assert {r["id"] for r in got} == {i for i, _ in rows} | {None}
    compare(got, rows + odd[:2])


def test_flat_directions_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    one = whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)).collect()
    assert len(one) == 4 and all(r["whitened"] is None and r["explained"] is None and r["n"] == 1 and r["deviation"] == 0 for r in one)
    line = whiten(spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0]) for k in range(5)], schema)).collect()
    first = {r["id"]: r["whitened"] for r in line if r["component"] == 1}
    assert np.allclose(np.abs([first[k] for k in range(5)]), np.abs(np.arange(5) - 2) / math.sqrt(2))
    assert all(r["whitened"] is None for r in line if r["component"] > 1) and all(r["identity_error"] < 1e-9 for r in line)


def test_deviations_are_exact_beyond_a_long():
    x = np.array([[1 << 40, -5], [3, 4]], np.int64)
    assert [int(v) for v in _deviations(x, 1000, [17, -9]).to_pylist()] == [
        sum((1000 * int(a) - s) ** 2 for a, s in zip(r, (17, -9))) for r in x]
    assert _deviations(np.array([[1, 2]]), 3, [1, 1]).to_pylist() == [29]
