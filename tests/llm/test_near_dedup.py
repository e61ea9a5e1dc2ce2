import math
import random

import numpy as np
import pytest

from prefdata.llm import near_dedup as N
from prefdata.llm.ann import cosines

SCHEMA = "vec_id long, embedding array<float>, label int, node long, n long, a string, home boolean"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, -1, 7, "x", True) for i, v, label in rows], SCHEMA).repartition(3)


def some_rows(n, dim=16, seed=4, labels=3):
    """Families of near copies among directions from anywhere."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        centre, size = rng.normal(size=dim), int(rng.choice([1, 1, 1, 2, 5, 30]))
        label = int(rng.integers(labels))
        for _ in range(size):
            out.append((len(out), np.float32(centre + 0.18 * rng.normal(size=dim)).tolist(), label))
    return out[:n]


def brute_force(rows):
    """(links, component) by comparing all pairs."""
    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    usable = [i for i, (_, v, label) in enumerate(rows) if good(v, label)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = [0] * len(rows)
    vectors = np.array([rows[i][1] for i in usable], np.float64).reshape(len(usable), -1)
    for place, i in enumerate(usable):
        same = cosines(np.broadcast_to(vectors[place], vectors.shape), vectors) >= N.LINK
        for other in np.flatnonzero(same):
            j = usable[other]
            if j != i and rows[j][2] == rows[i][2]:
                links[i] += 1
                root[find(i)] = find(j)
    names = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            names[find(i)] = min(vec_id, names.get(find(i), vec_id))
    return [(r[0], links[i], names.get(find(i))) for i, r in enumerate(rows)]


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


def test_links_and_components(spark):
    rows = some_rows(900)
    rows += [(5000 + i, rows[3][1], rows[3][2]) for i in range(300)]  # copies
    rows += [(6000 + i, rows[3][1], 9) for i in range(3)]  # the same with another label
    rows += [(7000 + i, [x * 2.0 ** (i % 5 + 1) for x in rows[8][1]], rows[8][2]) for i in range(40)]
    rows += [
        (8001, None, 1), (8002, [0.0] * 16, 1), (8003, [math.nan] * 16, 1), (8004, rows[3][1], None),
        (8005, [None] + [1.0] * 15, 1), (8006, [], 1), (8006, rows[3][1], rows[3][2]), (None, rows[3][1], rows[3][2]),
    ]
    out = N.op11_near_dedup(table(spark, rows))
    assert out.columns[:4] == ["vec_id", "n_links", "component_id", "kept"]
    assert found(out) == sorted(brute_force(rows), key=str)
    assert out.select("recall").distinct().collect()[0][0] == 1.0


def test_overlapping_shards_and_a_family_larger_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 60)
    rng = np.random.default_rng(1)
    rows = some_rows(700, labels=1)
    centre = rng.normal(size=16)
    rows += [(2000 + i, np.float32(centre + 0.2 * rng.normal(size=16)).tolist(), 0) for i in range(400)]
    random.Random(2).shuffle(rows)
    out = N.op11_near_dedup(table(spark, rows))
    got, want = found(out), sorted(brute_force(rows), key=str)
    recall = out.select("recall").distinct().collect()[0][0]
    assert recall >= N.RECALL
    assert sum(n for _, n, _ in got) >= 0.97 * sum(n for _, n, _ in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want))  # none that is no link
    assert sum(a[2] == b[2] for a, b in zip(got, want)) >= 0.99 * len(want)


def test_audit_sees_what_is_missing(spark):
    rows = some_rows(300, labels=1)
    keyed = table(spark, rows).selectExpr("vec_id", "label", "cast(embedding as array<double>) v", "vec_id a", "vec_id b")
    nodes = N.nodes_of(keyed)
    all_found = N.linked(nodes)
    assert N.audit(nodes, all_found) == 1.0
    assert N.audit(nodes, all_found.selectExpr("node", "0 found")) == 0.0


def test_robust_prune_drops_what_a_chosen_one_covers():
    angles = np.array([0.0, 0.1, 0.11, -0.3, 3.0])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    kept = N.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, 1, -1, 0]]))[0]
    assert kept[kept >= 0].tolist() == [1, 3, 4]  # 1 is no nearer to 4 by a fifth than 0 is


def test_empty_and_uneven(spark):
    assert N.op11_near_dedup(table(spark, [])).count() == 0
    assert found(N.op11_near_dedup(table(spark, [(1, None, 1), (None, [1.0], None)]))) == [(1, 0, 1), (None, 0, None)]
    with pytest.raises(ValueError, match="1, 2"):
        N.op11_near_dedup(table(spark, [(1, [1.0], 1), (2, [1.0, 2.0], 1)]))
