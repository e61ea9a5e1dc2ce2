"""Completions of a prompt: fan-out, rule rewards, comparison inside the group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.rewards import DEFAULT_REGISTRY, Scorer, weighted_sum
from prefdata.operators.skew import salted_join


def fan_out(
    prompts: DataFrame, k: int = fixed.COMPLETIONS_PER_PROMPT
) -> DataFrame:
    """``k`` rows per prompt, numbered by ``sample_id`` from 1."""
    numbers = F.sequence(F.lit(1).cast("bigint"), F.lit(k).cast("bigint"))
    return prompts.withColumn("sample_id", F.explode(numbers))


def score(
    df: DataFrame,
    registry: Mapping[str, tuple[float, Scorer]] = DEFAULT_REGISTRY,
    completion: str = "completion",
    prompt: str = "prompt",
    total: str = "reward",
) -> DataFrame:
    """One ``<name>_reward`` column per scorer, and their weighted sum."""
    parts = {name: F.col(f"{name}_reward") for name in registry}
    scored = df.withColumns(
        {
            f"{name}_reward": scorer(F.col(completion), F.col(prompt))
            for name, (_, scorer) in registry.items()
        }
    )
    return scored.withColumn(total, weighted_sum(parts, registry))


def group_advantage(
    df: DataFrame,
    group: str = "prompt_id",
    sample: str = "sample_id",
    reward: str = "reward",
    smallest_piece: int = 100_000,
) -> DataFrame:
    """Reward relative to the mean and spread of its group, as ``advantage``.

    A group of one has advantage 0; rows without a group are a group. Group figures are combined on the map side and
    joined back in pieces, so a group of any size is never held in one task.
    """
    # As JSON a null group is a key like any other.
    df = df.withColumn("_group", F.to_json(F.struct(group)))
    figures = df.groupBy("_group").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(reward).alias("_mean"),
        F.stddev_samp(reward).alias("_spread"),
    )
    joined = salted_join(
        df,
        figures.select("_group", "_mean", "_spread"),
        "_group",
        [group, sample],
        sizes=figures.select("_group", "n_rows"),
        smallest_piece=smallest_piece,
    )
    relative = (F.col(reward) - F.col("_mean")) / (
        F.col("_spread") + fixed.ADVANTAGE_EPSILON
    )
    return joined.withColumn(
        "advantage", F.when(F.col("_spread").isNull(), 0.0).otherwise(relative)
    ).drop("_group", "_mean", "_spread")
