import json

import pytest
from pyspark.sql import functions as F

from prefdata.functions import prompts
from prefdata.operators import generate, grpo, preference
from prefdata.sources import files, schemas, scratch, sinks


def test_strict_and_lenient_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    good = {"prompt": "p中", "chosen": None, "rejected": "r\n"}
    path.write_text(json.dumps(good, ensure_ascii=False) + "\n\n{broken\n", encoding="utf-8")
    lenient = files.read_jsonl(spark, str(path), schemas.PREFERENCE, strict=False)
    rows = lenient.collect()
    assert [r._corrupt_record for r in rows] == [None, "{broken"]
    assert tuple(rows[0])[:3] == ("p中", None, "r\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        files.read_jsonl(spark, str(path), schemas.PREFERENCE).collect()


def test_json_lines_sink_keeps_nulls_and_characters(spark, tmp_path):
    df = spark.createDataFrame([("中", None, '"')], schemas.PREFERENCE)
    for _ in range(2):
        sinks.write_jsonl(df, str(tmp_path / "out"))
    lines = [p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*")]
    assert "".join(lines) == '{"prompt":"中","chosen":null,"rejected":"\\""}\n'


def test_documents_by_extension(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo\n", encoding="utf-8")
    (tmp_path / "sub" / "b.tar.MD").write_text("# 中", encoding="utf-8")
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    (tmp_path / "d").write_text("none", encoding="utf-8")
    documents, rejects = files.read_documents(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: r for r in documents.collect()}
    assert {k: (r.extension, r.text) for k, r in got.items()} == {
        "a.txt": (".txt", "one\ntwo\n"),
        "b.tar.MD": (".md", "# 中"),
    }
    assert got["b.tar.MD"].output_name.endswith("/sub/b.tar_sft_data.jsonl")
    assert sorted((r.path.rsplit("/", 1)[1], r.extension) for r in rejects.collect()) == [
        ("c.pdf", ".pdf"),
        ("d", ""),
    ]


def test_models_do_not_overwrite_each_other(spark, tmp_path, plan_of):
    path = str(tmp_path / "pairs")
    df = spark.createDataFrame([("p", "c", "r")], schemas.PREFERENCE)
    for model, chosen in [("m1", "old"), ("m2", "two"), ("m1", "new")]:
        rows = df.selectExpr(f"'{model}' AS model", "prompt", f"'{chosen}' AS chosen", "rejected")
        sinks.write_per_model(rows, path)
    back = files.read_jsonl(spark, path, schemas.PREFERENCE + ", model STRING")
    assert sorted((r.model, r.chosen) for r in back.collect()) == [("m1", "new"), ("m2", "two")]
    assert "PartitionFilters: [isnotnull(model" in plan_of(back.filter("model = 'm1'"))


def test_write_only_where_no_finished_result_is(spark, tmp_path):
    path = tmp_path / "out"
    assert sinks.write_if_absent(spark.range(3), str(path))
    assert not sinks.write_if_absent(spark.range(9), str(path))
    assert spark.read.parquet(str(path)).count() == 3
    (path / "_SUCCESS").unlink()  # as an interrupted job would leave it
    assert sinks.write_if_absent(spark.range(9), str(path))
    assert spark.read.parquet(str(path)).count() == 9


def test_prefix_of_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    rows = files.read_prefix(spark, path, 12, "id").collect()
    assert sorted(r.id for r in rows) == list(range(12))


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_folder(spark).startswith(shared)
    stored = scratch.materialise(spark.range(5))
    assert stored.count() == 5 and shared in stored.inputFiles()[0]


@pytest.fixture
def load_upper():
    def load():
        def answer(batch):
            if any("bad" in p for p in batch):
                raise RuntimeError("no answer")
            return [p.upper() for p in batch]

        return answer

    return load


def test_a_failing_prompt_keeps_its_row(spark, load_upper):
    rows = [(i, "bad" if i == 7 else f"p{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, prompt string").repartition(2)
    out = generate.batch_generate(df, "id", load_upper, "upper", batch_size=6)
    got = {r.id: r for r in out.collect()}
    assert len(got) == 20
    assert got[7].text is None and got[7].error == "RuntimeError: no answer"
    assert got[3].text == "P3" and got[3].error is None and got[3].model == "upper"
    assert all(r.elapsed_s >= 0 for r in got.values())
    assert generate.answered(out).count() == 19


def test_too_few_answers_are_an_error(spark):
    df = spark.createDataFrame([("a", "p"), ("b", "q")], "key string, prompt string")
    out = generate.batch_generate(df, "key", lambda: lambda batch: [], "none").collect()
    assert sorted(r.key for r in out) == ["a", "b"]
    assert all("answers for" in r.error for r in out)


def test_row_local_steps_run_on_a_stream(spark, tmp_path):
    """Columns and predicates are the same on a streaming DataFrame."""
    rows = [("q" * 400, "", "x"), (" what? ", "", "A long answer with 12% and 34% and 56%.")]
    sinks.write_jsonl(spark.createDataFrame(rows, schemas.INSTRUCTION), str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.INSTRUCTION).json(str(tmp_path / "in"))
    prompt = prompts.inference_prompt("instruction", "input")
    scored = grpo.score(
        stream.select(prompt.alias("prompt"), stream.output.alias("completion"))
    ).filter(prompts.prompt_fits("prompt"))
    query = (
        scored.writeStream.format("memory")
        .queryName("scored")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = spark.table("scored").collect()
    assert len(got) == 1 and got[0].number_reward == 1.0


def test_generated_answers_become_pairs(spark, load_upper):
    source = spark.createDataFrame(
        [(i, f"question {i}", "", "answer " * 5) for i in range(6)],
        "id long, instruction string, input string, output string",
    )
    wanted = preference.generation_input(source, "id")
    rendered = wanted.select("id", prompts.inference_prompt("instruction", "input").alias("prompt"))
    answers = scratch.materialise(generate.batch_generate(rendered, "id", load_upper, "upper"))
    pairs = preference.preference_pairs(source, generate.answered(answers), "id")
    assert pairs.count() == 6
    assert pairs.first().rejected.startswith("指令: QUESTION")


def test_pairs_are_written_per_model_without_a_shuffle(spark, tmp_path):
    stored = str(tmp_path / "stored")
    spark.range(3000).selectExpr("id", "repeat('some text ', 20) as text").write.parquet(stored)
    rows, path = spark.read.parquet(stored), str(tmp_path / "out")
    shuffles = spark.sparkContext._jsc.sc().newShuffleId()
    for text, model in (("a", "first"), ("b", "second"), ("c", "second")):
        tagged = rows.withColumns({"mark": F.lit(text), "model": F.lit(model)})
        assert sinks.write_per_model(tagged, path, gather=False, compression="gzip") == 3000
    assert spark.sparkContext._jsc.sc().newShuffleId() == shuffles + 1
    back = spark.read.json(path)
    assert {(r["model"], r["mark"], r["n"]) for r in back.groupBy("model", "mark").agg(F.count("*").alias("n")).collect()} == {
        ("first", "a", 3000), ("second", "c", 3000)}
