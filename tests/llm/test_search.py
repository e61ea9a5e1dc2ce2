import math
import random
from collections import defaultdict

import numpy as np
import pytest

from prefdata.llm import ann as A
from prefdata.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, label int, score double, query_id long"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 0.5, -1) for i, v in vectors], SCHEMA).repartition(3)


def some_vectors(n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.6
    return [(i, np.float32(r).tolist()) for i, r in enumerate(rows)]


ODD = [
    (7001, None), (7002, [1.0, None] + [0.0] * 6), (7003, [math.nan] * 8), (7050, [math.inf] + [0.0] * 7),
    (None, [1.0] * 8), (7004, []), (7005, [1.0, 2.0]),
]


def exact_top(vectors, k, score, asked):
    out = {}
    for q, qv in vectors:
        if asked(q):
            near = sorted(((-score(qv, v), i) for i, v in vectors if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def found(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


def whole_product(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))


def test_exact_top_k(spark):
    vectors = some_vectors(400)
    vectors += [(1000 + i, vectors[50][1]) for i in range(120)]  # ties at the top
    vectors += [(2000, [0.0] * 8), (2001, [0.0] * 8)]
    got = found(T.op7_topk(table(spark, vectors + ODD)).collect())
    assert got == exact_top(vectors, 5, whole_product, lambda i: i % 50 == 0)


def test_close_scores_and_early_finished_queries(spark):
    """Scores a few bins apart: a query that is done must not count what lies above its kth."""
    rng = np.random.default_rng(8)
    vectors = [(i, (rng.integers(0, 40, 4) / 256).tolist()) for i in range(600)]
    got = found(T.op7_topk(table(spark, vectors)).collect())
    assert got == exact_top(vectors, 5, whole_product, lambda i: i % 50 == 0)


def test_top_k_block_by_block_and_large_numbers(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 3)
    vectors = some_vectors(200) + [(500, [3e7, 0.0] * 4), (501, [3e7, 1.0] * 4), (502, [-3e7] * 8)]
    got = found(T.op7_topk(table(spark, vectors)).collect())
    def held_at_the_limit(a, b):
        return min(whole_product(a, b), 2**63 - 1)

    assert got == exact_top(vectors, 5, held_at_the_limit, lambda i: i % 50 == 0)


def test_few_or_no_candidates(spark):
    few = table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])])
    assert found(T.op7_topk(few).collect()) == {0: [(1, 128 * 256)]}
    assert [tuple(r)[:3] for r in A.op10_ann(few).collect()] == [(0, 1, 1)]
    for op in (T.op7_topk, A.op10_ann):
        assert op(few.limit(0)).count() == 0
        assert op(few.filter("vec_id = 0")).count() == 0
        twice = op(few.union(few)).collect()
        assert [(r["query_id"], r["vec_id"]) for r in twice] == [(0, 1), (0, 1)]


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


@pytest.mark.parametrize("chunk", [4096, 40])
def test_recall_and_scores(spark, monkeypatch, chunk):
    monkeypatch.setattr(A, "ROWS_PER_LEAF", 50)
    monkeypatch.setattr(A, "EVERY", 10)
    monkeypatch.setattr(A, "CHUNK", chunk)
    vectors = some_vectors(1500, 16) + [(5000 + i, [1.0] * 16) for i in range(700)]  # a hot vector
    got = found(A.op10_ann(table(spark, vectors + [(9000, [0.0] * 16), (9010, None)])).collect())
    want = exact_top(vectors, 5, cosine, lambda i: i % 10 == 0)
    assert got.keys() == want.keys()
    of = dict(vectors)
    hits = 0
    for q, near in got.items():
        assert len(near) == 5 and q not in [i for i, _ in near]
        for i, s in near:
            assert s == pytest.approx(cosine(of[q], of[i]), abs=1e-12)
        hits += sum(s >= want[q][4][1] - 1e-12 for _, s in near)
    assert hits / (5 * len(got)) >= 0.9
    assert got[5000] == [(5001 + i, pytest.approx(1.0)) for i in range(5)]


def test_best_bin_first_visits_every_leaf_once_nearest_first():
    rng = np.random.default_rng(0)
    rows = A.unit(rng.normal(size=(2000, 6)))
    tree = A.Tree(rows, 40)
    leaf = tree.leaf_of(rows)
    assert tree.leaves > 30
    first = 0
    for i in random.Random(1).sample(range(2000), 100):
        order = list(tree.visits(rows[i]))
        assert sorted(order) == list(range(tree.leaves))
        first += order[0] == leaf[i]
    assert first > 90


def test_components_of_any_size(spark):
    vectors = [(0, [1e308, 1.0]), (50, [7e305, -1e308]), (1, [2.0**70, 0.5]), (2, [-3e38, 3.5]), (3, [1e-300, 2.0])]
    schema = "vec_id long, embedding array<double>, label int"
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], schema)

    def exact(a, b):
        whole = [[256 * int(x) if abs(x) > 2**60 else math.floor(256 * x) for x in v] for v in (a, b)]
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(*whole))))

    got = found(T.op7_topk(df).collect())
    assert got == exact_top(vectors, 5, exact, lambda i: i % 50 == 0)
