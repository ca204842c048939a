import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tablesync.llm import whitening
from tablesync.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, key string, n string, whitened string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "k", "n", "w") for i, v in rows], SCHEMA)


def brute(rows, components=16):
    """Rows kept, their whole numbers, n, exact sums and the eigenpairs of the covariance."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, size = len(distinct), len(distinct[0])
    total = [sum(x[j] for x in distinct) for j in range(size)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, total)] for x in distinct])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, total, values[::-1][:components], basis[:, ::-1][:, :components], values.sum()


def compare(rows, got, tolerance=1e-7):
    kept, n, total, values, basis, trace = brute(rows)
    assert Counter(r["vec_id"] for r in got) == Counter(i for i, _ in kept for _ in values)
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, total)) for i, x in kept}
    centred = {i: np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, total)]) for i, x in kept}
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        k = r["component"] - 1
        want = centred[r["vec_id"]] @ basis[:, k] / math.sqrt(values[k])
        sign = signs.setdefault(k, math.copysign(1, want * r["whitened"]))
        assert abs(sign * r["whitened"] - want) < tolerance
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] - values[k] / trace) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def result(df):
    return [r.asDict() for r in whitening.by_component(whitening.whiten(df, "vec_id", "embedding"), "vec_id").collect()]


def test_query(spark, data):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    compare(rows, [r.asDict() for r in QUERIES["op11_whitening"](spark, data).collect()])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]]) for i in range(60)]
    bad = [(100, None), (101, []), (102, [None] * 6), (103, [1.0, float("nan")] + [0.0] * 4), (104, [float("inf")] + [0.0] * 5), (105, [1e30] + [0.0] * 5)]
    short = [(106, [1.0, 2.0]), (107, [3.0])]
    repeated = [(200 + i, rows[0][1]) for i in range(30)] + [(None, rows[1][1])]
    got = result(vectors(spark, rows + bad + short + repeated))
    compare(rows + repeated, got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_tables_without_components(spark, rows):
    assert result(vectors(spark, rows)) == []


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0, float(i % 3)]) for i in range(20)]
    got = result(vectors(spark, rows))
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-9


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float(2**40 * i), float(i * i)]) for i in range(50)]
    df = whitening.whiten(vectors(spark, rows), "vec_id", "embedding")
    kept, n, total, *_ = brute(rows)
    assert {r.vec_id: int(r.deviation) for r in df.collect()} == {i: sum((n * a - s) ** 2 for a, s in zip(x, total)) for i, x in kept}
    assert {r["deviation"] for r in result(vectors(spark, rows))} == {None}


def spectrum(values, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = q.astype(np.longdouble) @ np.diag(np.array(values, dtype=np.longdouble)) @ q.T.astype(np.longdouble)
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    list(range(1, 33)), [1.0] * 10 + [2.0] * 10, [1 + 1e-9 * i for i in range(12)] + [5.0, 6.0], [1, 1 + 1e-12, 1 + 2e-12, 3],
    [10.0 ** -i for i in range(12)], [0.0] * 5 + [1.0, 2.0], [7.0], [0.0, 0.0],
])
def test_refinement_reaches_more_than_double_precision(values):
    a = spectrum(values, 3)
    found, x = whitening.refined(a)
    scale = max(float(np.abs(a).max()), 1e-300)
    assert float(np.abs(x.T @ x - np.eye(len(a))).max()) < 1e-16
    assert float(np.abs(a @ x - x * found).max()) / scale < 1e-16
    assert np.all(np.diff(found) <= 1e-16 * scale)
    # Vectors of eigenvalues that differ by 1e-9 or less are still told apart.
    assert float(np.abs(x.T @ a @ x - np.diag(found)).max()) / scale < 1e-16


def test_float32_alone_is_not_enough():
    a = spectrum([1 + 1e-9 * i for i in range(12)], 3)
    _, start = np.linalg.eigh(a.astype(np.float32))
    start = start.astype(np.longdouble)
    s = start.T @ a @ start
    assert float(np.abs(s - np.diag(np.diag(s))).max()) > 1e-10
