import math
from fractions import Fraction

import numpy as np
import pytest

from tributary.llm import whitening
from tributary.llm.queries import op12_whitening
from tributary.llm.common import table


def model_of(vectors):
    """Exact covariance by its definition."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    centred = [[Fraction(row[i]) - mean[i] for i in range(d)] for row in x]
    cov = [[sum(r[i] * r[j] for r in centred) / n for j in range(d)] for i in range(d)]
    return x, n, sums, cov


def check(rows, vectors, components=8):
    """``rows``: vec_id, component, ... of the report; ``vectors``: by vec_id."""
    x, n, sums, cov = model_of(list(vectors.values()))
    matrix = np.array([[float(v) for v in row] for row in cov])
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, sum(values > len(cov) * 2.3e-16 * max(values)))
    assert len(rows) == len(vectors) * kept
    x_of = dict(zip(vectors, x))
    table_ = {(r["vec_id"], r["component"]): r for r in rows}
    signs = {}
    for (vec, k), r in table_.items():
        assert r["n"] == n
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x_of[vec], sums))
        assert r["explained"] == pytest.approx(values[k - 1] / np.trace(matrix), rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-4
        want = np.dot([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x_of[vec], sums)], axes[:, k - 1]) / math.sqrt(values[k - 1])
        if abs(want) > 1e-6:
            signs.setdefault(k, np.sign(want) * np.sign(r["whitened"]))
        assert r["whitened"] * signs.get(k, 1) == pytest.approx(want, abs=1e-6)


def test_small_table_by_definition(spark):
    draw = np.random.default_rng(3)
    vectors = {i: list(map(float, draw.normal(size=5) * [1, 2, 3, 4, 50] + 7)) for i in range(40)}
    vectors[40] = vectors[3]  # repeated rows count
    bad = [(50, None), (51, [1.0, None, 1.0, 1.0, 1.0]), (52, [1.0, float("nan"), 1.0, 1.0, 1.0]), (53, [float("inf")] * 5),
           (54, [1.0, 2.0]), (55, []), (56, [1e300] * 5)]
    df = spark.createDataFrame([(i, v, i, "x") for i, v in [*vectors.items(), *bad]],
                               "vec_id long, embedding array<double>, n long, whitened string").repartition(3)
    rows = whitening.report(df).collect()
    assert {r["component"] for r in rows} == {1, 2, 3, 4, 5}
    check(rows, vectors)


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.report(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and out.columns[:4] == ["vec_id", "component", "n", "deviation"]
    # One direction only: one component, also where ids are null or repeated.
    rows = [(None, [0.0, 0.0]), (1, [1.0, 1.0]), (1, [2.0, 2.0])]
    out = whitening.report(spark.createDataFrame(rows, schema)).collect()
    assert [r["component"] for r in out] == [1, 1, 1]
    assert {r["vec_id"] for r in out} == {None, 1}


def test_values_that_overflow_64_bits(spark):
    vectors = {i: [float((-1) ** i * 2 ** 45 * (i + 1)), float(i * i), 3.0 * i] for i in range(9)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    x, n, sums, cov = model_of(list(vectors.values()))
    model = whitening.fit(df)
    assert model.n == n and list(model.sums) == sums
    assert model.trace == pytest.approx(float(sum(cov[i][i] for i in range(3))), rel=1e-15)
    deviations = {r["vec_id"]: r["deviation"] for r in whitening.whitened(df, model).collect()}
    exact = {i: sum((n * c - s) ** 2 for c, s in zip(row, sums)) for i, row in enumerate(x)}
    assert deviations == {i: v if v < 2 ** 63 else None for i, v in exact.items()}
    assert None in deviations.values()


def test_polarisation_is_exact():
    draw = np.random.default_rng(5)
    x = draw.integers(99_000, 101_000, size=(30, 6))
    centre = np.rint(x.mean(axis=0)).astype("i8")
    rest = [int(v) for v in (x - centre).sum(axis=0)]
    scaled = whitening.covariance(30, rest, whitening._squares(centre)(x))
    *_, cov = model_of([[(c - 100_000) / 1024 for c in row] for row in x.tolist()])
    assert [[Fraction(v, 900) for v in row] for row in scaled] == cov


def test_query_against_definition(spark, sf_dir):
    vectors = {r["vec_id"]: r["embedding"] for r in table(spark, sf_dir, "embeddings").collect()}
    vectors = {i: v for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    if len(vectors) <= 300:
        check(op12_whitening(spark, sf_dir).collect(), vectors)
    else:
        assert op12_whitening(spark, sf_dir).count() == 8 * len(vectors)
