"""Rendered prompts and training texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.text import strip, text_or_empty


def inference_prompt(
    instruction: Column | str, input_: Column | str, stripped: bool = True
) -> Column:
    """Prompt that ends where the answer begins.

    Data sets are rendered from stripped fields, interactive questions as typed.
    """
    clean = strip if stripped else text_or_empty
    return F.concat(
        F.lit(fixed.LABEL_INSTRUCTION),
        clean(instruction),
        F.lit(fixed.LABEL_INPUT),
        clean(input_),
        F.lit(fixed.LABEL_ANSWER),
    )


def training_text(
    instruction: Column | str, input_: Column | str, output: Column | str
) -> Column:
    """Prompt and answer as one text."""
    return F.concat(inference_prompt(instruction, input_), F.lit(" "), strip(output))


def qa_request(chunk: Column | str) -> Column:
    """Request for question/answer pairs about one chunk."""
    return F.concat(
        F.lit(fixed.QA_REQUEST_HEAD), text_or_empty(chunk), F.lit(fixed.QA_REQUEST_TAIL)
    )


def prompt_fits(prompt: Column | str, limit: int = fixed.MAX_PROMPT) -> Column:
    """Predicate on the rendered prompt."""
    return F.length(text_or_empty(prompt)) <= limit
