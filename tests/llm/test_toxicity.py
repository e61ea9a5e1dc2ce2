import random

import pytest

from prefdata.llm import toxicity as T
from prefdata.llm.common import crc_fold
from .data import frame, prose


def corpus(spark, n=400):
    rng = random.Random(2)
    texts, toxic = [], []
    for i in range(n):
        words = prose(i, rng.randint(5, 60)).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["moronic", "Scumbag,", "qubl" + prose(rng.random(), 1)]))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    return texts, toxic, frame(spark, texts), labels


def test_held_out_labels_are_found(spark):
    texts, toxic, docs, labels = corpus(spark)
    rows = T.op6_toxicity(docs, labels).collect()
    assert len(rows) == len(texts)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and all(r["predicted"] == toxic[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_obfuscated_words_and_exceptions(spark):
    _, _, docs, labels = corpus(spark)
    model = T.train(docs, labels)
    weigh = T.Matcher(model["lexicon"], ("moronic acid",)).weigh
    for text in ("a M0R0N1C b", "a mоrоnіс b", "a ｍｏｒｏｎｉｃ b", "a mor­onic b", "(moronic)", "5cumb@g x"):
        assert weigh(text)[1] == 1, text
    for text in ("a moronic acid b", "oxymoronic", "10 50 3", "", "x 5 $ 7"):
        assert weigh(text)[1] == 0, text


def test_density_counts_not_length(spark):
    _, _, docs, labels = corpus(spark)
    score = T.scorer(T.train(docs, labels))
    values, _, _ = score([b"moronic", b"moronic " + prose(1, 50).encode(), b"moronic " + prose(1, 30000).encode(), b""])
    assert values[0] >= values[1] >= values[2] >= values[3]
    assert values[1] > 0.5 > values[3]


def test_defined_cases(spark):
    texts, _, docs, labels = corpus(spark, 100)
    odd = frame(spark, [None, ""]).selectExpr("cast(null as long) doc_id", "text", *[f"`{c}`" for c in docs.columns[2:]])
    all_docs = docs.union(odd).union(docs.limit(1))
    nulls = labels.union(spark.createDataFrame([(None, None, None), (3, None, None)], labels.schema))
    rows = T.op6_toxicity(all_docs, nulls).collect()
    assert len(rows) == 103
    empty = [r for r in rows if r["doc_id"] is None]
    assert len(empty) == 2 and all(r["score"] < 0.5 and r["held_out"] for r in empty)
    assert T.op6_toxicity(docs.limit(0), labels).count() == 0
    untaught = T.op6_toxicity(docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in untaught} == {0}
    kept = T.keep_clean(all_docs, T.train(docs, labels))
    assert kept.columns == docs.columns and 60 < kept.count() < 103


@pytest.mark.parametrize("key,fold", [("0", 0), ("17", 3)])
def test_fold_is_crc32(spark, key, fold):
    import zlib

    got = spark.sql(f"select {key}L doc_id").select(crc_fold("doc_id", 5)).first()[0]
    assert got == zlib.crc32(key.encode()) % 5


def test_short_words_and_many_terms(spark):
    """Whole words of three letters are terms, and no number of terms is left out."""
    rng = random.Random(2)
    bad = [f"{a}{b}x" for a in "bcdfg" for b in "aeiou"] + [f"vex{a}{b}ard" for a in "bcdfg" for b in "aeiou"]
    rows, labels = [], []
    for i in range(800):
        words = prose(i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            for word in rng.sample(bad, 12):
                words.insert(rng.randrange(len(words)), word)
        rows.append(" ".join(words))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows)
    model = T.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    terms = set(model["lexicon"])
    assert {w for w in bad if len(w) == 3} <= {t.strip() for t in terms if t.endswith(" ")}
    scores = T.scorer(model)
    matcher = T.Matcher(model["lexicon"], ())
    assert [h[3] for h in matcher.find(T.fold("a bax and baxter"))] == ["bax "]
    value = scores([b"you vexbaard and cox and dux", b"a harmless line of words"])[0]
    assert value[0] >= 0.5 > value[1]
    assert T.learn_lexicon(frame(spark, ["y" * 5000]).selectExpr("text", "1 AS label")) == {}


def test_hits_are_those_of_a_scan_of_all_terms(spark):
    rng = random.Random(6)
    letters = "aab"
    lexicon = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 6))): 4.0 for _ in range(12)}
    lexicon |= {"ab ": 5.0, "b ": 5.0}
    matcher = T.Matcher(lexicon, ("aaaa ab",))
    for seed in range(60):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(0, 12))]
        folded = T.fold(" ".join(words))
        excused = [(i, i + 8) for i in range(len(folded)) if folded.startswith(" aaaa ab ", i)]
        want = []
        for term, weight in lexicon.items():
            for i in range(len(folded)):
                end = i + len(term)
                if folded.startswith(" " + term, i) and not any(a <= i and end <= b for a, b in excused):
                    want.append((i, end, weight, term))
        assert sorted(matcher.find(folded)) == sorted(want)
