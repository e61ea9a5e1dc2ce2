import math
from collections import Counter

import numpy as np
import pytest

from prefdata.llm import jaccard_join as J
from .data import edited, frame, prose


def shingle_set(text, size=4):
    words = (text or "").lower().encode().split()
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def by_hand(rows):
    """Components by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    label, links = {i: i for i in sets}, Counter()
    edges = []
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 85 * len(sets[i] | sets[j]):
                edges.append((i, j))
                links[i] += 1
                links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return {i: (len(sets[i]), label[i], links[i]) for i in sets}


def corpus():
    base = [prose(k, 120) for k in range(4)]
    texts = [*base, None, "", " \t\n", "One two", "one TWO", "one", prose(9, 4000)]
    for k, text in enumerate(base):
        texts += [edited(text, 10 * k + e, e) for e in range(1, 9)]
    texts += [base[0].upper(), edited(texts[10], 1, 30), edited(texts[10], 2, 400)]
    passage = prose(77, 60)  # shared by many, similar to none
    texts += [f"{prose(100 + k, 90)} {passage} {prose(200 + k, 90)}" for k in range(12)]
    return texts


@pytest.mark.parametrize("block", [3, 1024])
def test_equals_all_pairs(spark, monkeypatch, block):
    # Small parts: groups are dealt out and meet part by part.
    monkeypatch.setattr(J, "BLOCK_ROWS", block)
    monkeypatch.setattr(J, "SHARD_ROWS", 200)
    texts = corpus()
    got = {r["doc_id"]: tuple(r)[1:] for r in J.join(frame(spark, texts)).collect()}
    assert got == by_hand(enumerate(texts))
    assert any(c != i for i, (_, c, _) in got.items())


def test_null_ids_repeats_and_empty_table(spark):
    docs = frame(spark, [prose(1, 50), prose(2, 50), prose(1, 50)])
    docs = docs.union(docs.selectExpr("cast(null as long)", *[f"`{c}`" for c in docs.columns[1:]]).limit(1))
    docs = docs.union(docs.filter("doc_id = 1"))
    got = sorted((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in J.join(docs).collect())
    assert got == [(False, 0, 0), (False, 1, 1), (False, 1, 1), (False, 2, 0), (True, None, 0)]
    assert sorted(r["doc_id"] for r in J.keep_one(docs).filter("doc_id is not null").collect()) == [0, 1]
    assert J.keep_one(docs).columns == docs.columns
    assert J.join(docs.limit(0)).count() == 0


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 9, (300, J.GROUPS))
    points[150:] = np.maximum(0, points[:150] + rng.integers(-1, 2, (150, J.GROUPS)) * (rng.random((150, J.GROUPS)) < 0.2))
    sizes = points.sum(axis=1)
    points[7], sizes[7], sizes[8] = J.FULL, 2000, 2000
    points = points.astype(np.uint8)
    found = set()
    for q, r in J.CountTree(points, sizes).search(np.arange(300), 85):
        found |= set(zip(q.tolist(), r.tolist()))
    want = {
        (i, j)
        for i in range(300)
        for j in range(300)
        if i != j
        and 100 * min(sizes[i], sizes[j]) >= 85 * max(sizes[i], sizes[j])
        and (7 in (i, j) or np.minimum(points[i], points[j]).sum() >= math.ceil(85 * (sizes[i] + sizes[j]) / 185))
    }
    assert found == want and len(want) > 100


def test_overlaps():
    sets = [np.unique(np.random.default_rng(k).integers(0, 500, 200).astype(np.uint64)) for k in range(7)]
    got = J.overlaps(sets[:4], sets[3:], columns=64)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[3:]] for a in sets[:4]]


def test_one_row_of_each_group_by_rows(spark):
    """Ids that are null or stand at several texts: every text is judged by itself."""
    t, u, v = prose(1, 60), prose(2, 60), prose(3, 60)
    near = t + " and one more"
    rows = [(1, t), (2, t), (2, u), (None, t), (None, t), (None, u), (None, v), (None, v), (7, near), (None, None), (8, "")]
    docs = spark.createDataFrame([(i, x, "en", 5) for i, x in rows], "doc_id long, text string, row string, n_links int")
    for parts in (1, 4):
        got = J.keep_one(docs.repartition(parts))
        assert got.dtypes == docs.dtypes
        kept = [(r["doc_id"], r["text"]) for r in got.collect()]
        assert sorted(kept, key=str) == sorted([(1, t), (2, u), (None, v), (None, None), (8, "")], key=str)
    assert J.keep_one(docs.limit(0)).count() == 0
