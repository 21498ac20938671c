"""Whitening against eigenvectors of the covariance of distinct vectors."""

import math
import random

import numpy as np
import pytest
from intake_spark.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, x string, n int, component string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 1, "c") for i, v in rows], SCHEMA).repartition(parts)


def plain(rows, many=4):
    """(n, sums, variances, components, trace) of the usable rows."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = {i: tuple(int(math.floor(256 * np.float64(np.float32(c)))) for c in v) for i, v in good}
    fit = np.array(sorted(set(whole.values())))
    c = fit - fit.sum(axis=0) / len(fit)
    e, q = np.linalg.eigh(c.T @ c / len(fit))
    return whole, fit, e[::-1][:many], q[:, ::-1][:, :many], e.sum()


def held(got, rows, many=4):
    whole, fit, e, q, trace = plain(rows, many)
    n, sums = len(fit), fit.sum(axis=0)
    assert len(got) == len(e) * len(whole)
    signs = {}
    for r in got:
        x = np.array(whole[r.vec_id])
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(map(int, x), map(int, sums)))
        want = (x - sums / n) @ q[:, r.component - 1] / np.sqrt(e[r.component - 1])
        if abs(want) > 1e-3:
            signs.setdefault(r.component, np.sign(want * r.whitened))
        assert r.whitened == pytest.approx(want * signs.get(r.component, 1), abs=2e-7)
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-9) and r.identity_error < 1e-9


def test_query_against_eigenvectors(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(200)]  # a hot vector or three
    rows += [(2000, None), (2001, []), (2002, [float("nan")] * 12), (2003, [1.0] * 11 + [None]), (2004, [float("-inf")] + [0.0] * 11), (2005, [-0.0] * 12)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    held(queries.op11_whitening_gkl(spark, str(tmp_path)).collect(), rows)


def test_equal_variances_are_found_as_often_as_they_occur(spark):
    """One start reaches one vector of each value; here all are equal."""
    rows = [(2 * i + s, [4.0 * (1 - 2 * s) * (i == j) for j in range(6)]) for i in range(6) for s in range(2)]
    usable, model = whitening.train(frame(spark, rows))
    assert len(model.variances) == 4 and np.allclose(model.variances, (4 * 256) ** 2 * 2 / 12) and model.identity_error < 1e-9
    assert np.allclose(model.components @ model.components.T, np.eye(4)) and whitening.whiten(usable, model).count() == 48


def test_converged_before_all_directions(spark):
    """A steep spectrum ends early; a second copy of the largest value is found by what is apart from the first."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 40)) * 0.7 ** np.arange(40) * 20
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    usable, model = whitening.train(frame(spark, rows))
    assert model.steps < 2 * 40
    held(whitening.whiten(usable, model).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0]), (2, [0.5, 1.0])]])
def test_nothing_to_whiten(spark, rows):
    usable, model = whitening.train(frame(spark, rows, 1))
    assert model is None and whitening.whiten(usable, model).collect() == []


def test_few_dimensions_null_ids_and_other_lengths(spark):
    rows = [(None, [1.0, 0.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0]), (2, [3.0, 1.0]), (3, [1.0, 2.0, 3.0])]
    usable, model = whitening.train(frame(spark, rows, 2))
    got = whitening.whiten(usable, model).collect()
    assert len(got) == 2 * 4 and {r.vec_id for r in got} == {None, 1, 2} and {r.n for r in got} == {3}


def test_deviations_beyond_64_bits():
    big = np.array([[1 << 40, 0], [3, 4]])
    assert whitening.deviations(big, 1 << 20, (0, 0)) == [None, ((3 << 20) ** 2) + ((4 << 20) ** 2)]
    assert whitening.deviations(np.array([[3, 4]]), 2, (1, 1)) == [25 + 49]
