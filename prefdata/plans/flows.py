"""Whole runs, from source tables to written data sets.

A model is given as a function without arguments that loads it; see
``operators.generate``. Generated answers are written once before they are used.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.chunking import BLANK_LINES
from prefdata.functions.prompts import inference_prompt
from prefdata.functions.rewards import DEFAULT_REGISTRY, Scorer
from prefdata.operators import documents as docs
from prefdata.operators import evaluation as ev
from prefdata.operators import grpo
from prefdata.operators import instructions as ins
from prefdata.operators import preference as pref
from prefdata.operators.generate import Model, answered, batch_generate, generate_once
from prefdata.operators.ordered import first_rows, seeded_sample
from prefdata.sources import sinks
from prefdata.sources.files import output_name, read_documents
from prefdata.sources.named import write_named
from prefdata.sources.scratch import materialise, materialise_counted

Loader = Callable[[], Model]


def instruction_data(
    sources: dict[str, DataFrame],
    key: str,
    path: str,
    quotas: dict[str, int] = fixed.SFT_QUOTAS,
    seed: int = fixed.SEED,
) -> None:
    """Mixed and shuffled instruction rows with their training text, as JSON lines."""
    mixed = ins.render_training_text(ins.mix(sources, quotas, key, seed))
    sinks.write_jsonl(
        mixed.select("instruction", "input", "output", "source", "text"), path
    )


def preference_data(
    source: DataFrame,
    key: str,
    load_model: Loader,
    model_name: str,
    path: str,
    n: int | None = None,
    tasks: int | None = None,
    most_failed: float = 0.5,
    exactly: int | None = None,
    ledger: str | None = None,
) -> dict[str, int]:
    """Triples with answers of a model as the rejected side, in the model's folder.

    Only rows that are long enough get an answer, as that is the costly step. Gives the
    numbers of rows asked, failed, accepted and skipped; with a greater share of failed rows than
    ``most_failed`` the run stops. ``n``: as many triples at most, from one over-fetched prefix;
    ``exactly``: as many whenever the table holds them, in as many rounds as that takes.
    ``ledger``: a folder that keeps every answer, so that a run that was broken off asks only the rest.
    """
    asked: Counter = Counter()

    def answer(prompts: DataFrame) -> DataFrame:
        answers, seen = _ask(prompts, key, load_model, model_name, tasks, ledger)
        asked.update(asked=seen["asked"], failed=seen["failed"])
        _stop_if_many(asked, most_failed, seen["example"])
        return answered(answers)

    if exactly is not None:
        pairs = pref.first_accepted(source, key, exactly, answer)
    else:
        wanted = pref.generation_input(source, key, n)
        prompts = wanted.select(key, inference_prompt("instruction", "input").alias("prompt"))
        pairs = pref.preference_pairs(source, answer(prompts), key, n)
    accepted = sinks.write_per_model(
        pairs.select(
            "prompt", "chosen", "rejected", F.lit(model_name).alias("model")
        ),
        path,
    )
    skipped = asked["asked"] - asked["failed"] - accepted
    return {"asked": asked["asked"], "failed": asked["failed"], "accepted": accepted, "skipped": skipped}


def _ask(
    prompts: DataFrame, key: str, load_model: Loader, model_name: str, tasks: int | None = None,
    ledger: str | None = None,
) -> tuple[DataFrame, dict]:
    """Stored answers, and how many were asked and failed, with one error."""
    counts = {"asked": F.count(F.lit(1)), "failed": F.count("error"), "example": F.min("error")}
    if ledger is None:
        return materialise_counted(
            batch_generate(prompts, key, load_model, model_name, tasks=tasks), **counts
        )
    answers = generate_once(prompts, key, load_model, model_name, ledger, tasks=tasks)
    return answers, answers.agg(*[c.alias(name) for name, c in counts.items()]).first().asDict()


def _stop_if_many(seen: Mapping[str, int], most_failed: float, example: str | None) -> None:
    """Raises where too many prompts failed."""
    if seen["failed"] > most_failed * seen["asked"]:
        raise RuntimeError(f"{seen['failed']} of {seen['asked']} prompts have no answer: {example}")


def transcript_data(
    transcripts: DataFrame, key: str, path: str, n: int | None = None
) -> None:
    """Triples from all pairs of dialogues, or from the first ``n``, as JSON lines."""
    rows = transcripts if n is None else first_rows(transcripts, n, [key])
    sinks.write_jsonl(pref.transcript_pairs(rows), path)


def prompt_data(
    source: DataFrame, key: str, path: str, n: int | None = None
) -> None:
    """Short enough prompts of all instruction rows, or of the first ``n``, as JSON lines."""
    rows = source if n is None else first_rows(source, n, [key])
    sinks.write_jsonl(ins.prompt_set(rows), path)


def advantage_data(
    completions: DataFrame,
    group: str,
    sample: str,
    registry: Mapping[str, tuple[float, Scorer]] = DEFAULT_REGISTRY,
) -> DataFrame:
    """Rewards of every completion and its advantage inside its group.

    The rewards are stored, without the texts, before the two passes over each group:
    the rules run once.
    """
    names = [f"{name}_reward" for name in registry]
    scored = grpo.score(completions, registry).select(group, sample, *names, "reward")
    return grpo.group_advantage(materialise(scored), group, sample)


def document_data(
    spark: SparkSession,
    folder: str,
    load_model: Loader,
    model_name: str,
    path: str | None = None,
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    separator: str = BLANK_LINES,
    tasks: int | None = None,
    most_failed: float = 0.5,
    ledger: str | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Question/answer rows about the text files of a folder, in a folder of JSON lines.

    Without a ``path`` the rows of each file go to one file beside it, named after it; files that differ in
    their extension alone share one. All of them appear when all are written, and a file without rows gets none.

    Gives the rejected files, and the numbers of chunks asked and failed and of rows. With a greater
    share of failed chunks than ``most_failed`` the run stops. ``ledger``: as in ``preference_data``.
    """
    documents, rejects = read_documents(spark, folder)
    chunks = docs.document_chunks(
        documents, "path", size=size, overlap=overlap, separator=separator
    )
    requests = docs.qa_requests(chunks).withColumn(
        "chunk_id", F.concat_ws("#", "path", F.col("chunk_no").cast("string"))
    )
    replies, seen = _ask(requests, "chunk_id", load_model, model_name, tasks, ledger)
    _stop_if_many(seen, most_failed, seen["example"])
    if path is not None:
        rows = sinks.write_jsonl(docs.qa_rows(answered(replies), reply="text"), path)
    else:
        rows = _write_beside(docs.qa_rows(answered(replies), "chunk_id", reply="text"), folder)
    return rejects, {"chunks": seen["asked"], "failed": seen["failed"], "rows": rows}


def _write_beside(rows: DataFrame, folder: str) -> int:
    """Rows (chunk_id, instruction, input, output) in the files named after their documents."""
    source = F.regexp_extract("chunk_id", r"(?s)^(.*)#\d+$", 1)
    number = F.regexp_extract("chunk_id", r"(\d+)$", 1).cast("bigint")
    line = F.to_json(F.struct("instruction", "input", "output"), {"ignoreNullFields": "false"})
    named = rows.withColumns(
        {"_source": source, "_number": number, "_place": F.monotonically_increasing_id()}
    ).withColumn("_name", output_name("_source"))
    return write_named(named, "_name", ["_source", "_number", "_place"], folder, line)


def evaluation_data(
    pairs: DataFrame,
    key: str,
    models: dict[str, Loader],
    path: str,
    n: int = fixed.NUM_EVAL_SAMPLES,
    seed: int = fixed.SEED,
    names: list[str] | None = None,
    manifest: DataFrame | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Summary of each model on a seeded sample of triples; also written as JSON.

    An answer that fails ends the run: means over the answers that a model gave would make
    it look better than it is. With a ``manifest`` of (model, file), models without the required
    file are left out before they are asked. ``ledger``: as in ``preference_data``. Predictions are
    stored in buckets, model after model, beside the samples.
    """
    if manifest is not None:
        listed = manifest.filter(F.col("model").isin(list(models)))
        having = {r["model"] for r in ev.complete_models(listed, manifest).distinct().collect()}
        models = {name: load for name, load in models.items() if name in having}
    models = {name: load for name, load in models.items() if not names or name in names}
    if not models:
        raise ValueError("no model to evaluate")
    sample = materialise(
        seeded_sample(pairs, n, key, seed).select(
            F.col(key).alias("sample_id"), "prompt", "chosen", "rejected"
        )
    )
    stored = None
    for name, load in models.items():
        answers, seen = _ask(sample, "sample_id", load, name, ledger=ledger)
        _stop_if_many(seen, 0.0, seen["example"])
        predictions = answered(answers).withColumnRenamed("text", "answer")
        if stored is None:
            stored = ev.store_evaluation(
                predictions, sample.select("sample_id", "chosen", "rejected"), ["sample_id", "model"]
            )
        else:
            stored.append(predictions)
    summary = materialise(ev.summarise(stored.scores()))
    sinks.write_results(ev.results_document(summary), path)
    return ev.by_name(summary)


def evaluation_report(summary: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """What an evaluation ends with: the best model by each metric, and the change from each model to the
    next by name. Both are written as JSON lines, in ``best`` and ``deltas`` below ``path``."""
    best, deltas = ev.best_models(summary), ev.adjacent_deltas(summary)
    sinks.write_jsonl(best, f"{path}/best")
    sinks.write_jsonl(deltas, f"{path}/deltas")
    return best, deltas
