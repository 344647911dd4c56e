import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import eigen, queries, whitening


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
def test_leading_eigenvectors(n):
    rng = np.random.default_rng(n)
    square = rng.normal(size=(n, n))
    turned, _ = np.linalg.qr(rng.normal(size=(n, n)))
    tied = turned @ np.diag(np.repeat([5.0, 1.0], [n - n // 2, n // 2])) @ turned.T
    for a in (square @ square.T, np.eye(n) * 3, (tied + tied.T) / 2, np.outer(square[0], square[0]), np.zeros((n, n)), square @ square.T * 1e150):
        values, vectors = eigen.leading(a, 8)
        true = np.linalg.eigvalsh(a)[::-1][:8]
        scale = max(abs(true).max(), 1e-300)
        assert np.abs(values - true).max() <= 1e-13 * scale and np.abs(a @ vectors - vectors * values).max() <= 1e-13 * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_exact_products():
    rng = np.random.default_rng(1)
    for high in (1 << 10, 1 << 30, 1 << 60):
        z = rng.integers(-high, high, (70, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.exact_products(z).tolist() == want


def check(got, rows, k=8):
    """got: rows of the query; rows: (vec_id, vector) of one length that remain. numpy in double precision, fractions where exact."""
    whole = [[math.floor(c * 1024) + 100_000 for c in v] for _, v in rows]
    n = len(whole)
    sums = [sum(line[i] for line in whole) for i in range(len(whole[0]))]
    z = np.array([[float(Fraction(a * n - s, n)) for a, s in zip(line, sums)] for line in whole])
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    some = values > 1e-12 * values.max()
    want = z @ (vectors[:, some] / np.sqrt(values[some]))
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(line, sums)) for (i, _), line in zip(rows, whole)}
    assert set(by_id) == ({i for i, _ in rows} if some.any() else set())
    for (i, _), w in zip(rows, want):
        mine = by_id.get(i, {})
        assert sorted(mine) == list(range(1, some.sum() + 1))
        for c, r in mine.items():
            assert r.n == n and r.deviation == (deviation[i] if deviation[i] < 1 << 63 else None)
            assert r.explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9) and r.identity_error < 1e-4
            assert abs(r.whitened) == pytest.approx(abs(w[c - 1]), abs=1e-9 * max(1, abs(w).max()))
    # Either sign, but one for all rows.
    for c in range(1, some.sum() + 1):
        signs = {np.sign(by_id[i][c].whitened * w[c - 1]) for (i, _), w in zip(rows, want) if abs(w[c - 1]) > 1e-6}
        assert len(signs) == 1


def test_whole_table(spark, small):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check(queries.op12_whitening(spark, small).collect(), rows)


def test_repeats_bit_for_bit(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    runs = [sorted(map(tuple, whitening.whiten(table.repartition(parts)).collect())) for parts in (1, 7)]
    assert runs[0] == runs[1]


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4) * [3, 1, 1, 0.2]]) for i in range(60)]
    flat = [(100 + i, [float(i), 2.0 * i, 7.0]) for i in range(20)]
    one, long = [(200, [0.5] * 5)], [(300 + i, [float(x) for x in rng.normal(size=130)]) for i in range(150)]
    wide = [(500 + i, [float(x) for x in rng.normal(size=6) * 2.0**48]) for i in range(30)]
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0]), (903, [math.nan] * 4), (904, [math.inf, 0.0, 0.0, 0.0]), (905, [1e300] * 4)]
    rows += [(60, [0.0] * 4)]
    df = spark.createDataFrame(rows + flat + one + long + wide + bad, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "'x' as width", "1 as n", "2 as component", "3 as line").repartition(4)
    got = whitening.whiten(df).collect()
    for part in (rows, flat, one, long, wide):
        check([r for r in got if r.vec_id in {i for i, _ in part}], part)
    assert {r.vec_id for r in got if r.vec_id >= 900} == set()
    assert {r.component for r in got if 100 <= r.vec_id < 200} == {1}  # one line has one direction
    twice = whitening.whiten(df.where("vec_id < 60").unionAll(df.where("vec_id < 60")).selectExpr("nullif(vec_id, 3) as vec_id", "embedding")).collect()
    assert len(twice) == 120 * 4 and {r.n for r in twice} == {120} and sum(r.vec_id is None for r in twice) == 8
    assert whitening.whiten(df.limit(0)).collect() == []
