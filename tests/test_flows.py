import json

import pytest

from prefdata.operators import instructions as ins
from prefdata.plans import flows
from prefdata.sources import files, schemas


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [(i, f"q{i}", "", ("a long enough answer " if i % 4 else "short ") + str(i)) for i in range(40)],
        "id long, instruction string, input string, output string",
    ).repartition(3)


@pytest.fixture
def loader():
    """Model that makes its answer from the prompt, or fails on a word in it."""

    def of(make, fails_on=None):
        def load():
            def answer(batch):
                if fails_on and any(fails_on in p for p in batch):
                    raise RuntimeError("no answer")
                return [make(p) for p in batch]

            return answer

        return load

    return of


def lines(path):
    texts = [p.read_text(encoding="utf-8") for p in sorted(path.rglob("part-*"))]
    return [json.loads(line) for text in texts for line in text.splitlines()]


def test_instruction_data(source, tmp_path):
    sentiments = ins.normalize_sentiment(source.select("id", "input", "output"), "id")
    flows.instruction_data(
        {"instruction": source, "sentiment": sentiments}, "id", str(tmp_path / "o"),
        {"instruction": 12, "sentiment": 3},
    )
    rows = lines(tmp_path / "o")
    assert len(rows) == 15
    assert sum(r["source"] == "sentiment" for r in rows) == 3
    assert all(r["text"].startswith("指令: ") for r in rows)


def test_preference_data(spark, source, loader, tmp_path):
    path = str(tmp_path / "pairs")
    counts = flows.preference_data(
        source, "id", loader(lambda p: "rejected: " + p, "q5"), "m1", path, n=10, tasks=3
    )
    assert counts == {"asked": 9, "failed": 1, "accepted": 8, "skipped": 0}
    flows.preference_data(source, "id", loader(lambda p: "no"), "m2", path, n=10)
    rows = files.read_jsonl(spark, path, schemas.PREFERENCE + ", model STRING").collect()
    # Of the first 12 rows, 0, 4 and 8 are too short and 5 has no answer.
    assert sorted(int(r.chosen.split()[-1]) for r in rows) == [1, 2, 3, 6, 7, 9, 10, 11]
    assert {r.model for r in rows} == {"m1"}
    assert all(r.rejected == "rejected: " + r.prompt for r in rows)


def test_transcript_and_prompt_data(spark, source, tmp_path):
    mark = "\n\nAssistant:"
    dialogues = spark.createDataFrame(
        [(i, f"\n\nHuman: {i}{mark} " + "c" * (8 + i), f"{mark} " + "r" * 20) for i in range(9)],
        "id long, chosen string, rejected string",
    )
    flows.transcript_data(dialogues, "id", str(tmp_path / "t"), n=6)
    assert sorted(len(r["chosen"]) for r in lines(tmp_path / "t")) == [11, 12, 13]

    long = source.withColumn("input", ins.F.expr("IF(id = 2, repeat('x', 300), '')"))
    flows.prompt_data(long, "id", str(tmp_path / "p"), n=5)
    assert sorted(r["prompt"].split("\n")[0] for r in lines(tmp_path / "p")) == [
        f"指令: q{i}" for i in (0, 1, 3, 4)
    ]


def test_document_data(spark, loader, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text(("word " * 30 + "\n\n") * 8, encoding="utf-8")
    (folder / "b.md").write_text("too short", encoding="utf-8")
    (folder / "c.pdf").write_bytes(b"%PDF")

    def reply(prompt):
        return 'Here: [{"question": "How long?", "answer": "%d characters"}]' % len(prompt)

    rejects, counts = flows.document_data(
        spark, str(folder), loader(reply), "m", str(tmp_path / "rows")
    )
    assert counts == {"chunks": 3, "failed": 0, "rows": 3}
    rows = lines(tmp_path / "rows")
    assert len(rows) == 3
    assert {(r["instruction"], r["input"]) for r in rows} == {("How long?", "")}
    assert [r.extension for r in rejects.collect()] == [".pdf"]


def test_evaluation_data(spark, loader, tmp_path):
    pairs = spark.createDataFrame(
        [(i, f"p{i}", f"the good answer {i}", f"a bad reply {i}") for i in range(50)],
        "id long, prompt string, chosen string, rejected string",
    )
    models = {
        "worse": loader(lambda p: "a bad reply"),
        "better": loader(lambda p: "the good answer"),
        "unused": loader(lambda p: ""),
    }
    path = tmp_path / "results"
    summary = flows.evaluation_data(
        pairs, "id", models, str(path), n=20, names=["better", "worse"]
    )
    rows = summary.collect()
    assert [(r.model, r.win_rate, r.avg_length) for r in rows] == [
        ("better", 1.0, 3.0),
        ("worse", 0.0, 3.0),
    ]
    failing = {"better": loader(lambda p: "the good answer", "p3")}
    with pytest.raises(RuntimeError, match="have no answer: RuntimeError: no answer"):
        flows.evaluation_data(pairs, "id", failing, str(tmp_path / "failed"), n=50)
    written = json.loads("".join(p.read_text() for p in path.glob("part-*")))
    assert list(written) == ["better", "worse"] and written["better"]["win_rate"] == 1.0
