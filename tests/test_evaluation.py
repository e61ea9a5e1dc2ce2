import json
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefdata.functions import rouge
from prefdata.operators import evaluation as ev

GOLDEN_ROUGE = [
    ("the cat sat", "the cat sat", 1.0),
    ("The cat, sat!", "the cat sat", 1.0),
    ("the cat sat on the mat", "the cat is on a mat", 0.666666667),
    ("a b c", "c b a", 0.333333333),
    ("P/E is 15.5", "p e 15 5", 0.888888889),
    ("", "x", 0.0),
    ("市盈率", "市盈率", 0.0),
    (None, "x", 0.0),
]


def test_golden_rouge(spark):
    df = spark.createDataFrame([g[:2] for g in GOLDEN_ROUGE], "p string, r string")
    rows = df.select(
        rouge.rouge_l("p", "r").alias("v"), rouge.rouge_l_against("p", "r", "p").alias("both")
    ).collect()
    for row, (p, r, want) in zip(rows, GOLDEN_ROUGE):
        assert math.isclose(row.v, want, abs_tol=1e-9), (p, r)
        assert row.both.chosen == row.v


def table_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


tokens = st.lists(st.sampled_from("abcd"), max_size=90)


@settings(max_examples=300, deadline=None)
@given(tokens, tokens)
def test_common_length_is_that_of_the_full_table(a, b):
    assert rouge.common_length(a, b) == table_length(a, b) == rouge.common_length(b, a)


@settings(deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=200))
def test_rouge_of_equal_texts_is_one(a):
    assert rouge.f1(a, a) == 1.0


def test_long_texts_are_compared_whole():
    rng = random.Random(2)
    a = [rng.choice("abcdefgh") for _ in range(3000)]
    b = a[1000:] + a[:1000]
    assert rouge.common_length(a, b) >= 2000
    assert rouge.common_length(a + ["z"], b + ["z"]) == rouge.common_length(a, b) + 1


SUMMARY = [("m1", 0.2, 0.5), ("m2", 0.3, 0.5), ("m3", 0.3, 0.25), ("m4", 0.0, 0.0), ("m5", 0.1, 0.1)]


@pytest.fixture
def summary(spark):
    rows = [(m, r, r, w, 1.0, 1.0, 2.0) for m, r, w in SUMMARY]
    return spark.createDataFrame(rows, ["model", *ev.METRICS]).repartition(3)


def test_best_model_and_ties(summary):
    best = ev.best_models(summary).select("metric", "model", "value")
    assert sorted(map(tuple, best.collect())) == [
        ("rouge_l_mean", "m2", 0.3),
        ("win_rate", "m1", 0.5),
    ]


def test_adjacent_deltas(summary):
    rows = {r.model: r for r in ev.adjacent_deltas(summary).collect()}
    assert sorted(rows) == ["m2", "m3", "m4", "m5"]
    assert rows["m2"].base_model == "m1"
    assert math.isclose(rows["m2"].rouge_delta_pct, 50.0)
    assert math.isclose(rows["m3"].win_delta, -0.25)
    assert math.isclose(rows["m4"].rouge_delta_pct, -100.0)
    assert math.isclose(rows["m5"].rouge_delta_pct, 0.1 / 1e-8 * 100)


def test_results_document(summary):
    document = json.loads(ev.results_document(summary).first()["value"])
    assert list(document) == ["m1", "m2", "m3", "m4", "m5"]
    assert list(document["m1"]) == ev.METRICS
    assert document["m2"]["rouge_l_mean"] == 0.3


def test_scores_and_summary(spark):
    samples = spark.createDataFrame(
        [(1, "the cat sat", "a dog ran"), (2, "x y", "z w")],
        "sample_id long, chosen string, rejected string",
    )
    predictions = spark.createDataFrame(
        [
            (1, "a", "the cat sat", 1.0),
            (2, "a", "none of it", 2.0),
            (1, "b", "a dog ran far", 0.5),
            (3, "b", "no such sample", 0.5),
        ],
        "sample_id long, model string, answer string, elapsed_s double",
    )
    scores = ev.sample_scores(predictions, samples, ["sample_id", "model"])
    got = {(r.model, r.sample_id): r for r in scores.collect()}
    assert len(got) == 3
    assert (got[("a", 1)].rouge_l, got[("a", 1)].win) == (1.0, 1)
    assert (got[("a", 2)].rouge_l, got[("a", 2)].win) == (0.0, 0)  # two zeros: a loss
    assert (got[("b", 1)].win, got[("b", 1)].n_words) == (0, 4)
    a = ev.summarise(scores).filter("model = 'a'").first()
    assert (a.rouge_l_mean, a.rouge_l_max, a.win_rate) == (0.5, 1.0, 0.5)
    assert (a.avg_length, a.avg_latency, a.total_time) == (3.0, 1.5, 3.0)
    assert ev.summarise(scores.filter("false")).count() == 0


def test_model_filters_and_grid(spark):
    models = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "model string")
    manifest = spark.createDataFrame(
        [("m1", "config.json"), ("m1", "config.json"), ("m2", "notes.txt"), ("m3", "config.json")],
        "model string, file string",
    )
    complete = ev.complete_models(models, manifest)
    assert sorted(r.model for r in complete.collect()) == ["m1", "m3"]
    assert ev.only_models(complete, ["m3", "m9"]).collect()[0].model == "m3"
    assert ev.only_models(complete, []).count() == ev.only_models(complete).count() == 2
    grid = ev.question_grid(models, [("q", ""), ("r", "x")])
    assert sorted(map(tuple, grid.collect()))[1] == ("m1", 1, "r", "x")
    assert grid.count() == 6


def test_win_is_strict(spark):
    flags = spark.createDataFrame([(0.5, 0.4), (0.4, 0.4), (0.0, 0.0)], "a double, b double")
    assert [r.w for r in flags.select(ev.win_flag(F.col("a"), F.col("b")).alias("w")).collect()] == [
        1, 0, 0,
    ]
