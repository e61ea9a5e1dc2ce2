import random

import pytest

from prefdata.operators import generate as gen
from prefdata.operators import preference as pref
from prefdata.plans import flows
from prefdata.sources import files, schemas


class Log:
    """Every prompt that a model was asked, in files: tasks run in other processes."""

    def __init__(self, folder):
        folder.mkdir()
        self.folder = str(folder)

    def load(self, fails_at=None, stop_at=None):
        folder = self.folder

        def load():
            import uuid

            def answer(batch):
                if stop_at and any(stop_at in p for p in batch):
                    raise KeyboardInterrupt(stop_at)  # no failed answer: the task breaks off
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.writelines(p.replace("\n", "|") + "\n" for p in batch)
                if fails_at and any(fails_at in p for p in batch):
                    raise ValueError("no answer")
                return [f"answer to {p}" for p in batch]

            return answer

        return load

    def asked(self):
        import os

        return sorted(
            line.strip() for name in os.listdir(self.folder) for line in open(f"{self.folder}/{name}")
        )


def prompts(spark, ids, word="p"):
    return spark.createDataFrame([(i, f"{word}{i}") for i in ids], "id long, prompt string").repartition(3)


def test_no_prompt_is_asked_twice(spark, tmp_path):
    log, ledger = Log(tmp_path / "log"), str(tmp_path / "ledger")
    first = gen.generate_once(prompts(spark, range(30)), "id", log.load(), "m", ledger, slices=4)
    assert sorted(r.text for r in first.collect()) == sorted(f"answer to p{i}" for i in range(30))
    again = gen.generate_once(prompts(spark, range(20, 50)), "id", log.load(), "m", ledger, slices=4)
    assert sorted(r.id for r in again.collect()) == list(range(20, 50))
    assert log.asked() == sorted(f"p{i}" for i in range(50))
    # Another text, or another model, is another question.
    gen.generate_once(prompts(spark, [3], "q"), "id", log.load(), "m", ledger, slices=4)
    other = gen.generate_once(prompts(spark, [3]), "id", log.load(), "n", ledger, slices=4)
    assert [r.model for r in other.collect()] == ["n"]
    assert log.asked() == sorted([*(f"p{i}" for i in range(50)), "q3", "p3"])


def test_a_broken_run_is_taken_up(spark, tmp_path):
    log, ledger = Log(tmp_path / "log"), str(tmp_path / "ledger")
    rows = prompts(spark, range(60))
    last = rows.selectExpr("max_by(prompt, pmod(xxhash64(id), 6))").first()[0]  # in the last slice
    with pytest.raises(Exception, match=last):
        gen.generate_once(rows, "id", log.load(stop_at=last), "m", ledger, slices=6, batch_size=1)
    kept = {r.id for r in spark.read.parquet(ledger).collect()}
    assert 0 < len(kept) < 60
    asked_before = log.asked()
    done = gen.generate_once(rows, "id", log.load(), "m", ledger, slices=6, batch_size=1)
    assert sorted(r.id for r in done.collect()) == list(range(60))
    later = log.asked()
    for prompt in asked_before:
        later.remove(prompt)
    assert sorted(later) == sorted(f"p{i}" for i in range(60) if i not in kept)


def test_failed_prompts_are_answers_and_nothing_is_asked_of_no_prompts(spark, tmp_path):
    log, ledger = Log(tmp_path / "log"), str(tmp_path / "ledger")
    none = gen.generate_once(prompts(spark, []), "id", log.load(), "m", ledger)
    assert none.count() == 0 and none.columns == ["id", "model", "text", "elapsed_s", "error"]
    for _ in range(2):
        got = gen.generate_once(prompts(spark, range(5)), "id", log.load(fails_at="p3"), "m", ledger, batch_size=1)
        assert {r.id for r in got.filter("error IS NOT NULL").collect()} == {3}
    assert log.asked() == [f"p{i}" for i in range(5)]


def literal(rows, n):
    """Row after row until n are accepted."""
    out = []
    for i, chosen, rejected in rows:
        if len(out) == n:
            break
        if len(chosen) >= 20 and rejected != chosen and len(rejected) >= 10:
            out.append(i)
    return out


@pytest.mark.parametrize("share", [0.95, 0.5, 0.1, 0.0])
def test_as_many_triples_as_are_wanted(spark, share):
    rng = random.Random(7)
    rows = [
        (i, f"a long enough answer {i}" if rng.random() < 0.9 else "short", "x" * (10 if rng.random() < share else 3))
        for i in range(400)
    ]
    source = spark.createDataFrame(
        [(i, f"q{i}", "", chosen) for i, chosen, _ in rows] + [(None, "q", "", "without a key, but long enough")],
        "id long, instruction string, input string, output string",
    ).repartition(3)
    answers = spark.createDataFrame([(i, r) for i, _, r in rows], "id long, text string")
    seen = []

    def answer(asked):
        seen.extend(r.id for r in asked.select("id").collect())
        return answers.join(asked.select("id"), "id", "left_semi")

    for n in (12, 60):
        seen.clear()
        got = pref.first_accepted(source, "id", n, answer).collect()
        assert sorted(r.id for r in got) == literal(rows, n)
        assert len(seen) == len(set(seen))


def test_a_run_in_rounds_with_a_ledger(spark, tmp_path):
    log, path, ledger = Log(tmp_path / "log"), str(tmp_path / "pairs"), str(tmp_path / "ledger")
    source = spark.createDataFrame(
        [(i, f"q{i}", "", "a long enough answer" if i % 3 == 0 else "short") for i in range(90)],
        "id long, instruction string, input string, output string",
    )
    for _ in range(2):
        counts = flows.preference_data(source, "id", log.load(), "m", path, exactly=20, ledger=ledger)
        assert counts["accepted"] == 20 and counts["failed"] == 0
    rows = files.read_jsonl(spark, path, schemas.PREFERENCE + ", model STRING").collect()
    assert sorted(int(r.prompt.split("\n")[0].split("q")[1]) for r in rows) == list(range(0, 60, 3))
    assert len(log.asked()) == len(set(log.asked()))
