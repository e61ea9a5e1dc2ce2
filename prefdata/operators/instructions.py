"""Instruction data sets: normalise, mix, render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.prompts import inference_prompt, prompt_fits, training_text
from prefdata.functions.text import mentions_any, text_or_empty
from prefdata.operators.ordered import first_rows, seeded_shuffle


def normalize_sentiment(df: DataFrame, *keep: str) -> DataFrame:
    """(input, output) rows as instruction rows; other columns go, but for ``keep``."""
    return df.select(
        *keep,
        F.col("input").alias("instruction"),
        F.lit("").alias("input"),
        F.col("output"),
    )


def normalize_question(df: DataFrame, *keep: str) -> DataFrame:
    """(system_prompt, question, response) rows as instruction rows."""
    return df.select(
        *keep,
        F.col("question").alias("instruction"),
        text_or_empty("system_prompt").alias("input"),
        F.col("response").alias("output"),
    )


def concatenate(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept; a missing column is null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def source_quota(
    df: DataFrame, quotas: dict[str, int], key: str, source: str = "source"
) -> DataFrame:
    """First rows of each source in key order, as many as its quota."""
    return first_rows(df, quotas, [key], by=source)


def mix(
    sources: dict[str, DataFrame],
    quotas: dict[str, int],
    key: str,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Quota per source, all together, in a seeded order. Every source needs a quota."""
    if missing := sources.keys() - quotas.keys():
        raise ValueError(f"no quota for {sorted(missing)}")
    named = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    taken = source_quota(concatenate(*named), quotas, key)
    row_id = F.concat_ws(":", "source", F.col(key).cast("string"))
    return seeded_shuffle(taken.withColumn("row_id", row_id), "row_id", seed)


def render_training_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", training_text("instruction", "input", "output"))


def prompt_set(df: DataFrame, *keep: str) -> DataFrame:
    """Rendered prompts that are short enough."""
    prompts = df.select(*keep, inference_prompt("instruction", "input").alias("prompt"))
    return prompts.filter(prompt_fits("prompt"))


def topic_subset(df: DataFrame, columns: list[str], keywords: list[str]) -> DataFrame:
    """Rows that mention one of the keywords in one of the columns."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | mentions_any(name, keywords)
    return df.filter(hit)


def funnel_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Rows left after each stage in turn, in one pass: (stage_no, stage, n_rows)."""
    passed, counts = F.lit(True), []
    for i, (name, condition) in enumerate(stages.items()):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append((i, name, F.count_if(passed).cast("bigint").alias(f"_{i}")))
    totals = df.agg(*[c for _, _, c in counts])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("stage_no"),
                F.lit(name).alias("stage"),
                F.col(f"_{i}").alias("n_rows"),
            )
            for i, name, _ in counts
        ]
    )
    return totals.select(F.inline(rows))
