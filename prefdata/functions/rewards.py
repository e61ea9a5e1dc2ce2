"""Rule rewards: each takes the columns of one completion and gives a double."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.text import number_mentions, strip, word_tokens

# A scorer gets (completion, prompt). Columns built from a pandas_udf fit too.
Scorer = Callable[[Column, Column], Column]


def length_reward(completion: Column, prompt: Column | None = None) -> Column:
    reward = F.lit(fixed.LENGTH_REWARD_BEYOND)
    for most, value in reversed(fixed.LENGTH_REWARDS):
        reward = F.when(F.length(strip(completion)) <= most, F.lit(value)).otherwise(reward)
    return reward


def number_reward(completion: Column, prompt: Column | None = None) -> Column:
    n, reward = number_mentions(completion), F.lit(0.0)
    for least, value in reversed(fixed.NUMBER_REWARDS):
        reward = F.when(n >= least, F.lit(value)).otherwise(reward)
    return reward


def no_repeat_reward(completion: Column, prompt: Column) -> Column:
    own = F.array_distinct(word_tokens(completion))
    shared = F.size(F.array_intersect(own, word_tokens(prompt)))
    overlap = F.try_divide(shared.cast("double"), F.size(own).cast("double"))
    reward = F.lit(fixed.NO_REPEAT_REWARD)
    for above, value in reversed(fixed.REPEAT_REWARDS):
        reward = F.when(overlap > above, F.lit(value)).otherwise(reward)
    return F.when(overlap.isNull(), F.lit(-1.0)).otherwise(reward)


def format_reward(completion: Column, prompt: Column | None = None) -> Column:
    last = F.right(strip(completion), F.lit(1))
    return (
        F.when(last == "", F.lit(-1.0))
        .when(last.isin(fixed.SENTENCE_ENDS), F.lit(0.5))
        .otherwise(F.lit(0.0))
    )


SCORERS: dict[str, Scorer] = {
    "length": length_reward,
    "number": number_reward,
    "no_repeat": no_repeat_reward,
    "format": format_reward,
}

# name -> (weight, scorer); order is the order of addition.
DEFAULT_REGISTRY: dict[str, tuple[float, Scorer]] = {
    name: (weight, SCORERS[name]) for name, weight in fixed.REWARD_WEIGHTS.items()
}


def weighted_sum(
    parts: Mapping[str, Column], registry: Mapping[str, tuple[float, Scorer]]
) -> Column:
    """Weighted rewards added from left to right."""
    total = None
    for name, (weight, _) in registry.items():
        term = F.lit(float(weight)) * parts[name]
        total = term if total is None else total + term
    return total
