import json
import random

from pyspark.sql import functions as F

from prefdata.functions.chunking import pack, paragraphs
from prefdata.functions.replies import array_items, qa_pairs
from prefdata.operators import documents as docs

A, B, C, D = "a" * 60, "b" * 60, "c" * 30, "d" * 600
GOLDEN_CHUNKS = [
    (A + "\n\n" + B, 500, 50, [A + "\n" + B]),
    (A + "\n\n" + B, 121, 10, [A + "\n" + B]),
    (A + "\n\n" + B, 120, 10, [A, "a" * 9 + "\n" + B]),
    (A + "\n\n" + B, 100, 10, [A, "a" * 9 + "\n" + B]),
    (A + "\n\n" + B, 100, 0, [A, B]),
    (C, 500, 50, []),
    (C + "\n\n" + D, 500, 50, [C + "\n" + D]),
    (D + "\n\n" + C, 500, 50, [D, "d" * 49 + "\n" + C]),
    ("", 500, 50, []),
    (A + "\n" + B, 100, 10, [A + "\n" + B]),
]


def test_golden_chunks(spark):
    for text, size, overlap, want in GOLDEN_CHUNKS:
        df = spark.createDataFrame([(text,)], "text string")
        got = docs.document_chunks(df, size=size, overlap=overlap).orderBy("chunk_no")
        assert [r.chunk for r in got.collect()] == want
        assert [r.chunk_no for r in got.collect()] == list(range(len(want)))


def test_chunks_of_random_documents(spark):
    """Documents of up to 1,000 paragraphs, so that several blocks are folded."""
    rng = random.Random(7)
    rows = []
    for i in range(40):
        n = rng.choice([0, 1, 2, 5, 255, 256, 257, 512, 1000])
        rows.append((i, [f"{k}" + rng.choice("xyz") * rng.randint(1, 116) for k in range(n)]))
    df = spark.createDataFrame(rows, "id int, paras array<string>")
    for size, overlap in [(200, 20), (200, 0), (60, 100)]:
        got = df.select("id", "paras", pack("paras", size, overlap).alias("c")).collect()
        for r in got:
            check_chunks(r.paras, r.c, size, overlap)


def check_chunks(paras, chunks, size, overlap):
    """Every paragraph is in a chunk, in order; chunks are as long as the size allows."""
    assert all(len(c) >= 50 for c in chunks)
    at = 0  # paragraphs that the chunks so far end with
    for chunk in chunks:
        new = paras.index(chunk.split("\n")[-1]) + 1
        own = "\n".join(paras[at:new])
        assert chunk.endswith(own)
        # What is not new is the end of the text before, no longer than the overlap.
        carried = chunk.removesuffix(own)
        assert len(carried) <= overlap
        assert ("\n".join(paras[:at]) + "\n").endswith(carried)
        if overlap < 50:  # else a dropped short chunk may be carried whole
            body = len(carried) + sum(len(p) + 1 for p in paras[at:new])
            # Only the last newline, or a paragraph of its own, passes the size.
            assert new == at + 1 or body - 1 <= size
            # The next paragraph would not have fitted.
            assert new == len(paras) or body + len(paras[new]) > size
        at = new
    # Paragraphs without a chunk are too short for one.
    assert at == len(paras) or len("\n".join(paras[at:])) < 50


def test_paragraphs_are_stripped_and_not_empty(spark):
    df = spark.createDataFrame([("　 x \n\n \n\n\n y\nz ",)], "t string")
    assert df.select(paragraphs("t").alias("p")).first().p == ["x", "y\nz"]


def test_a_document_is_folded_once(spark, plan_of):
    df = spark.createDataFrame([("x", 1)], "text string, id int")
    plan = plan_of(docs.document_chunks(df, "id"))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("flatten(") == 1


TEN = "0123456789"
GOLDEN_REPLIES = [
    (f'Sure: [{{"question":" q ","answer":" {TEN} "}}] done', [("q", TEN)]),
    ('[{"question":"q","answer":"012345678"}]', []),
    ('[{"question":"q","answer":"see [1] for more"}]', []),
    ("no array", []),
    ('[{"question":"q"}]', []),
    (f'[{{"answer":"{TEN}"}},{{"question":"r","answer":"{TEN}"}}]', [("r", TEN)]),
    (f"[{{'question':'q','answer':'{TEN}'}}]", []),
    ("[]", []),
    (f'[{{"question":5,"answer":"{TEN}"}}]', []),
    (f'[{{"question":null,"answer":"{TEN}"}}]', []),
    (f'[{{"question":"q","answer":"{TEN}"}}, 5]', []),
    (f'[1] [{{"question":"q","answer":"{TEN}"}}]', []),
    (f'[{{"question":"q","answer":"{TEN}"}},{{"question":"r","answer":7}}]', []),
    (f'a\n[\n {{"question":"q\\n","answer":"{TEN}\\u4e2d"}}\n]', [("q", TEN + "中")]),
    ("", []),
    (None, []),
]


def test_golden_replies(spark):
    df = spark.createDataFrame(
        [(i, r) for i, (r, _) in enumerate(GOLDEN_REPLIES)], "id int, reply string"
    )
    got = {i: [] for i in range(len(GOLDEN_REPLIES))}
    for row in docs.qa_rows(df, "id").collect():
        assert row.input == ""
        got[row.id].append((row.instruction, row.output))
    for i, (reply, want) in enumerate(GOLDEN_REPLIES):
        assert got[i] == want, reply
    stats = docs.qa_stats(df).first()
    assert (stats.n_replies, stats.n_pairs) == (len(GOLDEN_REPLIES), 3)


def test_pairs_of_random_arrays(spark):
    rng = random.Random(3)
    values = ["q", " ", TEN, " " + TEN, "中" * 10, "short"]
    rows = []
    for i in range(200):
        items = []
        for _ in range(rng.randint(0, 4)):
            item = {k: rng.choice(values) for k in ("question", "answer", "extra")}
            item.pop(rng.choice(["question", "answer", "extra", "none"]), None)
            items.append(item)
        rows.append((i, json.dumps(items, ensure_ascii=bool(i % 2))))
    df = spark.createDataFrame(rows, "id int, reply string")
    parsed = df.withColumn("items", array_items("reply"))
    for r in parsed.select("reply", qa_pairs("items").alias("p")).collect():
        want = []
        for item in json.loads(r.reply):
            q, a = item.get("question", "").strip(), item.get("answer", "").strip()
            if q and len(a) >= 10:
                want.append((q, a))
        assert [tuple(p) for p in r.p] == want


def test_statistics(spark):
    df = spark.createDataFrame(
        [("x", D + "\n\n" + C), ("y", C), ("x", "")], "kind string, text string"
    )
    got = {r.kind: tuple(r)[1:] for r in docs.chunk_stats(df, "kind").collect()}
    assert got == {"x": (2, 632, 2), "y": (1, 30, 0)}
    total = docs.chunk_stats(df.withColumn("text", F.col("text"))).first()
    assert tuple(total) == (3, 662, 2)
