import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline as P
from prefdata.llm import mixing, quality, toxicity
from prefdata.llm.tokens import WordTokens, tokenizer_path
from .data import frame, prose
from .test_jaccard_join import by_hand, corpus, shingle_set
from .test_packing import check_pieces  # noqa: F401

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_queries_are_registered():
    names = entry_module.queries().keys()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names
    assert [n for n, _ in P.STAGES] == [
        "quality classifier", "toxicity", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing",
    ]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, kept[-1], SF_DIR).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
    for after in kept[1:-1]:
        assert after.dtypes == docs.dtypes
    rows = [df.collect() for df in kept]

    # Quality and toxicity: row by row, what the model says of each text.
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.train(docs, labels)
    rated = quality.assess(docs, model, F.col("source"), F.col("lang")).collect()
    assert {r["doc_id"] for r in rows[1]} == {r["doc_id"] for r in rated if r["_posterior"] >= 0.5}
    score = toxicity.scorer(toxicity.train(kept[1], labels))
    scores = score([(r["text"] or "").encode() for r in rows[1]])[0]
    assert {r["doc_id"] for r in rows[2]} == {r["doc_id"] for r, s in zip(rows[1], scores) if s < 0.5}

    # Near-duplicates: comparing all pairs.
    want = by_hand((r["doc_id"], r["text"]) for r in rows[2])
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(i for i, (_, c, _) in want.items() if i == c)

    # The mixture takes whole copies, near each source's target.
    taken = {r["doc_id"]: r["taken"] // max(1, r["size"]) for r in mixing.op9_mixing(kept[3]).collect()}
    assert Counter(r["doc_id"] for r in rows[4]) == Counter({i: n for i, n in taken.items() if n})

    # Packing: every copy's ids, cut and placed without gaps.
    words = WordTokens(tokenizer_path())
    text = {r["doc_id"]: r["text"] for r in rows[4]}
    for r in rows[5]:
        ids = np.frombuffer(words.of((text[r["doc_id"]] or "").encode()), "<u4")
        piece = ids[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["length"] == len(piece) <= 2048
    ids_in = sum(len(words.of((r["text"] or "").encode())) // 4 for r in rows[4])
    assert sum(r["length"] for r in rows[5]) == ids_in
    used = {}
    for r in rows[5]:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in used.values():
        ends = [o + n for o, n in sorted(own)]
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(used) <= -(-ids_in // 2048) * 1.03 + 1


def kept_by_five_words(rows):
    """Smallest ids of the components of texts that share 0.8 of their runs of five words, comparing all pairs."""
    sets = {i: shingle_set(t, 5) for i, t in rows}
    label = {i: i for i in sets}
    alike = lambda a, b: len(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    for i, j in [(i, j) for i in sets for j in sets if i < j and alike(sets[i], sets[j])]:
        low, high = sorted((label[i], label[j]))
        label = {k: low if v == high else v for k, v in label.items()}
    return sorted(i for i, c in label.items() if i == c)


def test_near_duplicates_by_five_words(spark):
    # 96 of 116 runs of five words are shared, and 97 of 117 of four words: under op3's 0.85.
    longer = [prose(500, 100), f"{prose(500, 100)} {prose(501, 20)}"]
    edges = [f"{prose(510 + n, 100)} {prose(520 + n, n)}" for n in range(23, 26)]  # 96 of 119, 120, 121
    texts = [*corpus(), *longer, *edges, *(prose(510 + n, 100) for n in range(23, 26))]
    docs = frame(spark, texts)
    got = P.one_of_each(spark, docs, SF_DIR)
    ids = sorted(r["doc_id"] for r in got.collect())
    assert ids == kept_by_five_words(enumerate(texts))
    assert texts.index(longer[0]) in ids and texts.index(longer[1]) not in ids
    assert got.dtypes == docs.dtypes


@pytest.mark.parametrize("name", [n for n in entry_module.queries() if n.startswith("op")])
def test_query_runs_on_a_whole_table(spark, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    table = {"op7": "embeddings", "op10": "embeddings", "op8": "pages"}.get(name.split("_")[0], "documents")
    n = duckdb.sql(f"select count(*) from '{SF_DIR}/{table}.parquet'").fetchall()[0][0]
    count = df.count()
    if name.split("_")[0] in ("op1", "op2", "op3", "op6", "op8", "op9"):
        assert count == n
    else:
        assert count > 0
