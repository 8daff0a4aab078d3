import math
from fractions import Fraction

import numpy as np
import pytest

from leafscore.llm import whitening

ROWS = "vec_id bigint, embedding array<float>, label int"


def rotation(rng, d):
    """An orthogonal matrix, right to the last digit of a longdouble: a product of Householder reflections."""
    q = np.eye(d, dtype=np.longdouble)
    for _ in range(d):
        v = rng.normal(size=d).astype(np.longdouble)
        v /= np.sqrt(v @ v)
        q -= 2 * np.outer(q @ v, v)
    return q


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1, 0.5, 0.25, 0.1],
        [5, 4, 1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.4, 0],
        [1 + 3e-12, 1 + 1e-12, 1, 1e-8 + 1e-13, 1e-8, 1e-8 - 1e-13, 0, 0],
        [1e6, 1, 1 - 1e-5, 1 - 2e-5, 1e-6, 1e-7, 1e-8, 1e-9],
    ],
)
def test_refined_vectors_are_those_the_matrix_was_made_of(values):
    rng = np.random.default_rng(1)
    d = np.array(values, np.longdouble)
    q = rotation(rng, len(d))
    matrix = (q * d) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigenvectors(matrix)
    unit = float(np.finfo(np.longdouble).eps)
    assert np.abs(found - d).max() < 50 * unit * d[0]
    for i in range(len(d)):
        gap = min((abs(float(d[i] - d[j])) for j in range(len(d)) if j != i), default=1)
        if gap > 0:
            off = min(np.abs(vectors[:, i] - q[:, i]).max(), np.abs(vectors[:, i] + q[:, i]).max())
            assert off < 2e-16 + 400 * unit * float(d[0]) / gap


def test_equal_eigenvalues_give_a_basis():
    rng = np.random.default_rng(2)
    d = np.array([3, 1, 1, 1, 1, 0.5], np.longdouble)
    q = rotation(rng, 6)
    matrix = (q * d) @ q.T
    values, vectors = whitening.eigenvectors((matrix + matrix.T) / 2)
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-17


def brute(rows, components=16):
    """By rational numbers up to the eigenvectors, which numpy finds in doubles."""
    kept = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    width = max({len(v) for _, v in kept}, key=lambda w: (sum(len(v) == w for _, v in kept), w))
    whole = [(k, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for k, v in kept if len(v) == width]
    fit = sorted({tuple(x) for _, x in whole})
    n = len(fit)
    total = [sum(c) for c in zip(*fit)]
    cov = [[sum((Fraction(x[i]) - Fraction(total[i], n)) * (Fraction(x[j]) - Fraction(total[j], n)) for x in fit) / n for j in range(width)] for i in range(width)]
    values, vectors = np.linalg.eigh(np.array(cov, float))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for k, x in whole:
        shifted = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, total)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, total))
        for c in range(len(values)):
            if values[c] > 1e-9 * values[0]:
                out.append((k, c + 1, n, deviation, shifted @ vectors[:, c] / math.sqrt(values[c]), values[c] / float(sum(cov[i][i] for i in range(width)))))
    return out


def check(found, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    found, want = sorted(map(tuple, found), key=key), sorted(want, key=key)
    assert [(r[0], r[1], r[2], r[3]) for r in found] == [(r[0], r[1], r[2], r[3]) for r in want]
    for c in {r[1] for r in found}:
        a, b = (np.array([r[4] for r in rows if r[1] == c]) for rows in (found, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
    assert all(abs(a[5] / b[5] - 1) < 1e-9 and a[6] < 1e-9 for a, b in zip(found, want))


def test_given_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found = whitening.whitening_report(table).collect()
    assert len(found) == 16 * len(rows)
    check([r for r in found if r[0] < 30], [r for r in brute(rows) if r[0] < 30])


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(100, 3, 5).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]  # a third of all rows is one vector
    rows += [rows[1], (None, rows[2][1]), (200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0])]
    rows += [(203, [math.nan] * 5), (204, [math.inf] + [0.0] * 4), (205, [1.0, 2.0])]
    frame = spark.createDataFrame([(k, v, 0) for k, v in rows], ROWS).repartition(3)
    frame = frame.withColumns({c: frame["vec_id"] for c in ("x", "v", "component", "n", "whitened", "a.b")})
    found = whitening.whitening_report(frame).collect()
    assert len({r[1] for r in found}) == 5
    check(found, brute(rows))


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0], 0) for i in range(10)]
    found = whitening.whitening_report(spark.createDataFrame(rows, ROWS)).collect()
    assert {r[1] for r in found} == {1} and len(found) == 10
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], ROWS)
    assert whitening.whitening_report(same).collect() == []
    assert whitening.whitening_report(spark.createDataFrame([], ROWS)).collect() == []


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(0, [3e38, 0.0], 0), (1, [-3e38, 1.0], 0), (2, [0.0, 5.0], 0)]
    found = whitening.whitening_report(spark.createDataFrame(rows, ROWS)).collect()
    big = (1 << 40) * 3
    assert all(r["deviation"] is None for r in found if r["vec_id"] < 2 and big * big >= 1 << 63)
    assert all(r["deviation"] is not None for r in found if r["vec_id"] == 2)
