import math
from fractions import Fraction

import numpy as np
import pytest

from prefdata.llm import whitening as W
from tests.llm.test_search import SCHEMA, some_vectors

ODD = [
    (7001, None), (7002, [1.0, None] + [0.0] * 6), (7003, [math.nan] * 8), (7050, [math.inf] + [0.0] * 7),
    (7004, []),
]


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 0.5, -1) for i, v in vectors], SCHEMA).repartition(3)


def check(rows, vectors, components=16):
    """Against exact sums over the distinct vectors, and numpy's covariance."""
    numbers = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in vectors]
    distinct = sorted({tuple(x) for _, x in numbers})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(row, sums)] for row in distinct])
    cov = centred.T @ centred / n
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:components]
    by_row = {}
    for r in rows:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    want = {}
    for i, x in numbers:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        want[i, deviation] = want.get((i, deviation), 0) + 1
    assert {k: len(v[1]) for k, v in by_row.items()} == want
    assert {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-4
    for (i, _), found in by_row.items():
        assert sorted(found) == list(range(1, len(values) + 1))
        for c, e in enumerate(values, 1):
            assert found[c][0]["explained"] == pytest.approx(e / np.trace(cov), rel=1e-6)
    # The whitened vectors of the distinct rows are uncorrelated, and made from the centred ones.
    key = {
        tuple(x): (i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in reversed(numbers)
    }
    white = np.array([
        [by_row[key[row]][c][0]["whitened"] for c in range(1, len(values) + 1)] for row in distinct
    ])
    assert np.abs(white.T @ white / n - np.eye(len(values))).max() < 1e-6
    back = np.linalg.lstsq(centred, white, rcond=None)[0]
    assert np.abs(centred @ back - white).max() < 1e-6
    unit = back * np.sqrt(values)
    assert np.abs(unit.T @ unit - np.eye(len(values))).max() < 1e-6


def test_whitened_rows(spark):
    vectors = some_vectors(300)
    vectors += [(1000 + i, vectors[5][1]) for i in range(200)]  # copies count once in the fit
    vectors += [(4, [100.0] * 4 + [-7.5] * 4)]
    check(W.op12_whitening(table(spark, vectors + ODD)).collect(), vectors)


def test_more_dimensions_than_components(spark):
    vectors = some_vectors(120, dim=20)
    check(W.op12_whitening(table(spark, vectors)).collect(), vectors)


def test_bit_planes_give_the_cross_products():
    rng = np.random.default_rng(2)
    for top in (2, 90, 10**6, 1 << 61):
        rows = rng.integers(-top, top, (150, 5))
        rows[:, 3] = 7
        sums, cross = W.scatter(rows)
        exact = rows.astype(object).T @ rows.astype(object)
        assert list(sums) == list(rows.astype(object).sum(axis=0))
        assert (np.triu(exact) == cross).all()


def test_limbs_and_packed_vectors():
    for numbers in (np.array([0, -1, 5, -(1 << 61)]), np.array([3, -(1 << 130), 1 << 125], object)):
        parts = W.limbs(numbers)
        assert [sum(int(p[i]) << 32 * k for k, p in enumerate(parts)) for i in range(len(numbers))] == list(numbers)
    rows = np.array([[0, -1], [127, -128], [128, 0], [40_000, 1], [1 << 40, 1]])
    packed = W.packed(rows)
    assert (W.unpacked(packed) == rows).all() and len(set(packed.to_pylist())) == len(rows)


def test_huge_components_do_not_crash(spark):
    vectors = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])]
    rows = W.op12_whitening(table(spark, vectors)).collect()
    assert {r["vec_id"] for r in rows} == {1, 2, 3} and max(r["deviation"] for r in rows) == 2**63 - 1


def test_nothing_to_whiten(spark):
    assert W.op12_whitening(table(spark, [])).count() == 0
    assert W.op12_whitening(table(spark, ODD)).count() == 0
    assert W.op12_whitening(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    with pytest.raises(ValueError, match="2, 3"):
        W.op12_whitening(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]))
