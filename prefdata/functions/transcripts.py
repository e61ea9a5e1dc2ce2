"""Dialogues held in one string, with a mark before each assistant turn."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.text import strip, text_or_empty


def _after_last_mark(text: Column) -> Column:
    return F.substring_index(text, fixed.ASSISTANT_MARK, -1)


def _has_mark(text: Column) -> Column:
    return F.contains(text, F.lit(fixed.ASSISTANT_MARK))


def dialogue_prompt(c: Column | str) -> Column:
    """Everything up to and including the last assistant mark."""
    text = text_or_empty(c)
    head = F.left(text, F.length(text) - F.length(_after_last_mark(text)))
    return F.when(_has_mark(text), head).otherwise(text)


def dialogue_reply(c: Column | str) -> Column:
    """Stripped text after the last assistant mark, empty where there is none."""
    text = text_or_empty(c)
    return F.when(_has_mark(text), strip(_after_last_mark(text))).otherwise("")
