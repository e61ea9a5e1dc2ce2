import math
import random

import pytest
from pyspark.sql import functions as F

from prefdata.llm import quality as Q
from .data import frame, prose


def corpus(spark, n=400):
    rng = random.Random(6)
    texts, good = [], []
    for i in range(n):
        text = prose(i, rng.randint(5, 300)).capitalize()
        bad = i % 4 == 0
        if bad:
            kind = (i // 4) % 3
            words = text.split()
            text = (
                " ".join(f"{w.upper()}!!" for w in words)
                if kind == 0
                else " ".join(w for w in words[:3] for _ in range(40))
                if kind == 1
                else " ".join(f"{w}###" for w in words)
            )
        texts.append(text)
        good.append(int(not bad))
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)], "doc_id long, quality int, toxic int")
    return texts, good, frame(spark, texts), labels


def test_held_out_labels(spark):
    _, good, docs, labels = corpus(spark)
    rows = Q.op1_quality(docs, labels).collect()
    held = [r for r in rows if r["held_out"]]
    right = sum(r["predicted"] == good[r["doc_id"]] for r in held)
    assert len(rows) == 400 and right >= 0.97 * len(held)


def test_posterior_by_hand(spark):
    """Rates of hosts and paths, and the document's odds, from the evidence."""
    _, _, docs, labels = corpus(spark, 120)
    model = Q.train(docs, labels)
    host = F.when(F.col("doc_id") < 60, "a").when(F.col("doc_id") < 119, "b")
    path = (F.col("doc_id") % 7).cast("string")
    rows = Q.assess(docs, model, host, path).collect()
    base = math.log(model["good"] / (1 - model["good"]))
    sites, hosts = {}, {}
    for r in rows:
        h = "a" if r["doc_id"] < 60 else "b" if r["doc_id"] < 119 else None
        p = 1 / (1 + math.exp(-(r["_evidence"] + base)))
        for level, key in ((sites, (h, r["doc_id"] % 7)), (hosts, h)):
            n, g = level.get(key, (0, 0.0))
            level[key] = (n + 1, g + p)
    world = sum(g for _, g in hosts.values()) / 120

    def strength(level, rate):
        seen = sum(n * (g / n - rate(k)) ** 2 for k, (n, g) in level.items())
        chance = [rate(k) * (1 - rate(k)) for k in level]
        between = max(0.0, seen - sum(chance)) / sum(n for n, _ in level.values())
        return 1e4 if between <= 0 else min(max(sum(chance) / len(chance) / between - 1, 2.0), 1e4)

    s = strength(hosts, lambda k: world)
    rate = {h: (g + s * world) / (n + s) for h, (n, g) in hosts.items()}
    t = strength(sites, lambda k: rate[k[0]])
    for r in rows:
        h = "a" if r["doc_id"] < 60 else "b" if r["doc_id"] < 119 else None
        n, g = sites[h, r["doc_id"] % 7]
        want = (g + t * rate[h]) / (n + t)
        assert r["_host_rate"] == pytest.approx(rate[h]) and r["_path_rate"] == pytest.approx(want)
        odds = r["_evidence"] + math.log(want / (1 - want))
        assert r["_posterior"] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_defined_cases(spark):
    _, _, docs, labels = corpus(spark, 100)
    odd = frame(spark, [None, "  "]).selectExpr(
        "cast(null as long) doc_id", "text", "cast(null as string) lang", "cast(null as string) source",
        *[f"`{c}`" for c in docs.columns[4:]],
    )
    both = docs.union(odd).union(docs.limit(2))
    assert Q.op1_quality(both, labels).count() == 104
    assert Q.op1_quality(docs.limit(0), labels).count() == 0
    assert {r["evidence"] for r in Q.op1_quality(docs, labels.limit(0)).collect()} == {0.0}
    kept = Q.keep_good(both, Q.train(docs, labels), F.col("source"), F.col("lang"))
    assert kept.columns == docs.columns and 60 < kept.count() <= 104


def test_input_columns_with_names_of_the_results(spark):
    rows = [(i, prose(i, 20 + i), f"h{i % 3}", "p", 7.0, "x", 1) for i in range(40)] + [(None, None, None, "p", None, None, None)]
    names = "doc_id long, text string, source string, lang string, host_rate double, path_rate string, _evidence int"
    docs = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    rated = Q.assess(docs, model, F.col("source"), F.col("lang"))
    assert rated.columns == [*docs.columns[:-1], "_evidence", "_host_rate", "_path_rate", "_posterior"]
    assert dict(rated.dtypes)["_evidence"] == "double" and rated.count() == 41
    kept = Q.keep_good(docs, model, F.col("source"), F.col("lang"), threshold=0.0)
    assert kept.dtypes == docs.dtypes and sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)


def test_a_very_long_text(spark):
    text = " ".join([prose(1, 500)] * 400)
    assert len(Q.features(text.encode())) == len(Q.FEATURES)
    docs = frame(spark, [text, prose(2, 40)])
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert Q.op1_quality(docs, labels).count() == 2
