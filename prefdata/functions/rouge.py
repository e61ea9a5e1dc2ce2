"""ROUGE-L F1.

The longest common subsequence has no affordable form as a Spark expression: a fold
over two token arrays costs one interpreted step, and one array copy, per token pair.
Here one Arrow batch of text is scored at a time, with one wide integer per text as
the row of the alignment table, so whole texts of any length are compared.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from prefdata.functions import fixed

_TOKEN = re.compile(fixed.ROUGE_TOKEN_PATTERN)


def rouge_tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence of two token lists."""
    if len(a) < len(b):
        a, b = b, a
    positions: dict[str, int] = {}
    bit = 1
    for token in a:
        positions[token] = positions.get(token, 0) | bit
        bit <<= 1
    free = every = bit - 1
    for found in [positions[token] for token in b if token in positions]:
        here = free & found
        if here:
            free = ((free + here) | (free - here)) & every
    return len(a) - free.bit_count()


def f1(prediction: list[str], reference: list[str]) -> float:
    common = common_length(prediction, reference)
    if common == 0:
        return 0.0
    precision, recall = common / len(prediction), common / len(reference)
    return 2 * precision * recall / (precision + recall)


@F.pandas_udf(DoubleType())
def rouge_l(prediction: pd.Series, reference: pd.Series) -> pd.Series:
    return pd.Series(
        [f1(rouge_tokens(p), rouge_tokens(r)) for p, r in zip(prediction, reference)],
        dtype="float64",
    )


@F.pandas_udf(
    StructType([StructField("chosen", DoubleType()), StructField("rejected", DoubleType())])
)
def rouge_l_against(
    answer: pd.Series, chosen: pd.Series, rejected: pd.Series
) -> pd.DataFrame:
    """Both scores of an answer in one pass.

    Models answer the same samples, so each text of a batch is tokenised once.
    """
    texts = pd.concat([answer, chosen, rejected]).unique()
    tokens = {text: rouge_tokens(text) for text in texts}
    rows = [
        (f1(tokens[a], tokens[c]), f1(tokens[a], tokens[r]))
        for a, c, r in zip(answer, chosen, rejected)
    ]
    return pd.DataFrame(rows, columns=["chosen", "rejected"], dtype="float64")
