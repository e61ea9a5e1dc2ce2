"""Answers from a model that the caller supplies, and a ledger of those that were given."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.sources.scratch import exists, scratch_folder

Model = Callable[[Sequence[str]], Sequence[str]]

# What a broken run can lose is one of so many parts of its answers.
SLICES = 32


def batch_generate(
    prompts: DataFrame,
    key: str,
    load_model: Callable[[], Model],
    model_name: str,
    prompt: str = "prompt",
    batch_size: int = 32,
    tasks: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, ``keep``, model, text, elapsed_s, error) for each prompt.

    ``load_model`` runs once per task that has prompts and returns a function from prompts to answers.
    Where a batch fails its prompts are tried one by one, and a prompt that fails keeps
    its row, with ``text`` null and the ``error``. ``elapsed_s`` is the prompt's share
    of its batch.

    A slow model wants small tasks, that are cheap to repeat when an executor is lost:
    ``tasks`` spreads the prompts over that many by their key.

    Sampling models answer differently each time, so write the result to a table (see
    ``sources.scratch.materialise``) before it is filtered, joined or read twice.
    """
    kept = {name: prompts.schema[name].dataType.simpleString() for name in (key, *keep)}

    def answers(model: Model, batch: list[str]) -> list[tuple]:
        start = time.perf_counter()
        try:
            texts = list(model(batch))
            if len(texts) != len(batch):
                raise ValueError(f"{len(texts)} answers for {len(batch)} prompts")
        except Exception as e:
            if len(batch) == 1:
                elapsed = time.perf_counter() - start
                return [(None, elapsed, f"{type(e).__name__}: {e}")]
            return [row for one in batch for row in answers(model, [one])]
        share = (time.perf_counter() - start) / len(batch)
        return [(text, share, None) for text in texts]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for frame in frames:
            if model is None and len(frame):
                model = load_model()
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size]
                rows = answers(model, part[prompt].tolist())
                out = pd.DataFrame(rows, columns=["text", "elapsed_s", "error"])
                for place, name in enumerate(kept):
                    out.insert(place, name, part[name].to_numpy())
                out.insert(len(kept), "model", model_name)
                yield out

    columns = ", ".join(f"`{name}` {kind}" for name, kind in kept.items())
    schema = f"{columns}, model string, text string, elapsed_s double, error string"
    prompts = prompts.select(*kept, prompt)
    if tasks is not None:
        prompts = prompts.repartition(tasks, key)
    return prompts.mapInPandas(run, schema)


def generate_once(
    prompts: DataFrame,
    key: str,
    load_model: Callable[[], Model],
    model_name: str,
    ledger: str,
    prompt: str = "prompt",
    batch_size: int = 32,
    tasks: int | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """``batch_generate`` that can be broken off and run again: no prompt is asked twice.

    ``ledger`` is a folder with every answer that was given, by model and slice. The prompts are dealt into
    ``slices`` by a hash of their key; the answers of a slice are committed together, so that
    what a broken run loses is a slice at most. A run asks only the keys that the ledger doesn't
    have (an anti join within the slice); a slice without such keys costs nothing, and no
    model is loaded for it. An answer belongs to the key and the text of its prompt: a prompt
    that was changed is asked again. A prompt that failed is an answer, too.

    ``key`` tells the prompts apart; one run at a time writes to a ledger, and ``slices`` stays
    the same for all of them.
    """
    spark = prompts.sparkSession
    dealt = prompts.select(
        key, prompt, F.xxhash64(F.col(prompt)).alias("_print"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(slices)).cast("int").alias("_slice"),
    )
    folder = scratch_folder(spark)
    dealt.hint("rebalance", "_slice").write.partitionBy("_slice").parquet(folder)
    wanted = spark.read.schema(dealt.schema).parquet(folder)
    same = [key, "_print", "_slice"]
    missing = wanted
    if exists(spark, ledger):
        missing = wanted.join(_ledger(prompts, key, ledger, model_name), same, "left_anti")
    to_do = missing.groupBy("_slice").count().collect()  # a row per slice
    for s in sorted(row["_slice"] for row in to_do):
        answers = batch_generate(
            missing.filter(F.col("_slice") == s), key, load_model, model_name, prompt,
            batch_size, tasks, keep=("_print", "_slice"),
        )
        answers.write.mode("append").partitionBy("model", "_slice").parquet(ledger)
    if not exists(spark, ledger):  # nothing was ever asked
        return batch_generate(prompts.limit(0), key, load_model, model_name, prompt)
    given = _ledger(prompts, key, ledger, model_name).join(wanted.select(*same), same, "left_semi")
    return given.select(key, "model", "text", "elapsed_s", "error")


def _ledger(prompts: DataFrame, key: str, ledger: str, model_name: str) -> DataFrame:
    kind = prompts.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, _print long, text string, elapsed_s double, error string, model string, _slice int"
    )
    rows = prompts.sparkSession.read.schema(schema).parquet(ledger)
    return rows.filter(F.col("model") == model_name)


def answered(generations: DataFrame) -> DataFrame:
    """Rows without an error."""
    return generations.filter("error IS NULL")
