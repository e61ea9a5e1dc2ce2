import json
import os

import pytest
from pyspark.sql import functions as F

from prefdata.operators import documents as docs
from prefdata.operators import ordered
from prefdata.plans import flows
from prefdata.sources.named import write_named


def names_in(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, files in os.walk(folder) for f in files)


def test_a_file_per_name_in_order(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = [(f"{folder}/sub/{i % 7}.jsonl", i, f"line é {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "name string, no long, text string").repartition(5)
    for _ in range(2):  # files that are there are replaced
        assert write_named(df, "name", ["no"], folder, F.col("text")) == 500
        assert names_in(folder) == [f"sub/{i}.jsonl" for i in range(7)]
        for i in range(7):
            text = (tmp_path / "out" / "sub" / f"{i}.jsonl").read_text(encoding="utf-8")
            assert text == "".join(f"line é {k}\n" for k in range(i, 500, 7))
    assert write_named(df.limit(0), "name", ["no"], folder, F.col("text")) == 0


def test_a_failed_run_leaves_what_was_there(spark, tmp_path):
    folder = str(tmp_path / "out")
    os.makedirs(folder)
    (tmp_path / "out" / "3.jsonl").write_text("as it was")
    rows = [(f"{folder}/{i % 20}.jsonl", i) for i in range(200)]
    df = spark.createDataFrame(rows, "name string, no long")
    bad = F.when(F.col("no") == 133, F.raise_error(F.lit("broken off"))).otherwise(F.col("no").cast("string"))
    with pytest.raises(Exception, match="broken off"):
        write_named(df, "name", ["no"], folder, bad)
    assert names_in(folder) == ["3.jsonl"] and (tmp_path / "out" / "3.jsonl").read_text() == "as it was"


def test_document_rows_beside_their_documents(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, n in (("a.txt", 12), ("b.MD", 3)):
        (folder / name).write_text("\n\n".join(f"{name} paragraph {i} " + "word " * 30 for i in range(n)), encoding="utf-8")
    (folder / "short.txt").write_text("too short")

    def load():
        def answer(prompts):
            return ['[{"question": "What?", "answer": "%d characters"}]' % len(p) for p in prompts]

        return answer

    _, counts = flows.document_data(spark, str(folder), load, "m")
    assert names_in(folder) == ["a.txt", "a_sft_data.jsonl", "b.MD", "b_sft_data.jsonl", "short.txt"]
    rows = [json.loads(x) for f in ("a", "b") for x in (folder / f"{f}_sft_data.jsonl").read_text().splitlines()]
    assert len(rows) == counts["rows"] == counts["chunks"] > 4
    assert {tuple(r) for r in rows} == {("instruction", "input", "output")}


def test_refused_replies(spark):
    good = '[{"question": "q", "answer": "a long enough answer"}]'
    replies = [(0, good), (1, "no array"), (2, "[{]"), (3, None), (4, ""), (5, '[{"question": 5, "answer": "0123456789"}]')]
    df = spark.createDataFrame(replies, "id long, reply string")
    assert sorted(r.id for r in docs.refused_replies(df, "id").collect()) == [1, 2, 5]


def test_shuffle_needs_no_sample_and_keeps_its_order_in_files(spark, tmp_path, plan_of):
    keys = list(range(3000))
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long").repartition(5)
    orders = []
    for parts in (1, 3, 16):
        shuffled = ordered.seeded_shuffle(df, "k", parts=parts)
        plan = plan_of(shuffled)
        assert "rangepartitioning" not in plan and plan.count("Exchange") == 2  # one is the input's own
        path = str(tmp_path / str(parts))
        shuffled.write.json(path, ignoreNullFields=False)
        files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
        lines = [json.loads(x) for f in files for x in open(os.path.join(path, f))]
        orders.append([x["k"] for x in lines])
        assert orders[-1] == [r.k for r in shuffled.collect()]
        assert [x["shuffle_key"] for x in lines[:-1]] == sorted(x["shuffle_key"] for x in lines[:-1])
        sizes = [sum(1 for _ in open(os.path.join(path, f))) for f in files]
        assert max(sizes) < 1.5 * 3000 / parts
    assert orders[0] == orders[1] == orders[2] and sorted(orders[0][:-1]) == keys and orders[0][-1] is None
