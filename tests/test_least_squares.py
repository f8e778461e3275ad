"""Least squares over long-form weights against the normal equations."""

import numpy as np
import pytest
from doctag.operators import least_squares as L


@pytest.mark.parametrize("penalty", [0.0, 0.3])
def test_coefficients(spark, penalty):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 4)) * [1, 1000, 0.01, 5] * (rng.random((30, 4)) < 0.7)
    y = x @ [2, 0.003, 50, -1] + 3 + rng.normal(size=30)
    weights = [(i, "f", f"t{j}", float(x[i, j])) for i in range(30) for j in range(4) if x[i, j]]
    # A row without a label, and one without any term.
    labels = [(i, float(y[i])) for i in range(30)] + [(30, None), (31, 4.0)]
    weights += [(30, "f", "t0", 9e9), (30, "f", "unseen", 1.0)]
    w = spark.createDataFrame(weights, "doc long, field string, term string, weight double")
    model = L.fit_least_squares(w, spark.createDataFrame(labels, "doc long, y double"), "doc", "y", penalty)
    a = np.vstack([np.hstack([x, np.ones((30, 1))]), [0, 0, 0, 0, 1]])
    b = np.append(y, 4.0)
    want = np.linalg.solve(a.T @ a + penalty * 31 * np.diag([1, 1, 1, 1, 0]), a.T @ b)
    got = {r.term: r.coefficient for r in model.terms.collect()}
    assert np.allclose([got[t] for t in ("t0", "t1", "t2", "t3", "")], want, rtol=1e-5)
    assert len(got) == 5 and max(abs(r.residual) for r in model.terms.collect()) < 1e-4
    docs = spark.createDataFrame([(0,), (31,), (77,)], "doc long")
    scores = {r.doc: r.score for r in L.predict_least_squares(w, docs, model, "doc").collect()}
    assert np.allclose([scores[k] for k in (0, 31, 77)], [a[0] @ want, want[4], want[4]])


def test_equal_columns_and_nothing(spark):
    schema = "doc long, field string, term string, weight double"
    w = spark.createDataFrame([(i, "f", t, float(i)) for i in range(4) for t in "ab"], schema)
    y = spark.createDataFrame([(i, 2.0 * i) for i in range(4)], "doc long, y double")
    model = L.fit_least_squares(w, y, "doc", "y")
    assert abs(sum(r.coefficient for r in model.terms.collect() if r.term) - 2) < 1e-6
    none = L.fit_least_squares(w.limit(0), y.limit(0), "doc", "y")
    assert none.terms.collect() == [] and none.rounds == 0
