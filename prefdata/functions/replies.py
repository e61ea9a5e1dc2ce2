"""Question/answer pairs out of a model reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.text import as_column, strip, text_or_empty


def array_span(reply: Column | str) -> Column:
    """Text from the first ``[`` to the first ``]`` after it, empty if there is none."""
    return F.regexp_extract(text_or_empty(reply), r"(?s)\[.*?\]", 0)


def array_items(reply: Column | str) -> Column:
    """Elements of the JSON array in a reply, null where the span is not JSON."""
    return F.try_variant_get(F.try_parse_json(array_span(reply)), "$", "array<variant>")


def qa_pairs(items: Column | str) -> Column:
    """Valid pairs among the elements, as an array of (question, answer).

    One element that is not an object, or has a question or answer that is not text,
    leaves no pair at all; an object that lacks a field is only left out itself.
    """
    items = as_column(items)

    def kind(item: Column, name: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(item, f"$.{name}", "variant"))

    def odd(item: Column) -> Column:
        return (
            ~F.startswith(F.schema_of_variant(item), F.lit("OBJECT"))
            | (F.coalesce(kind(item, "question"), F.lit("STRING")) != "STRING")
            | (F.coalesce(kind(item, "answer"), F.lit("STRING")) != "STRING")
        )

    def pair(item: Column) -> Column:
        return F.struct(
            strip(F.try_variant_get(item, "$.question", "string")).alias("question"),
            strip(F.try_variant_get(item, "$.answer", "string")).alias("answer"),
        )

    def valid(p: Column) -> Column:
        return (p["question"] != "") & (F.length(p["answer"]) >= fixed.MIN_ANSWER)

    none = F.array().cast("array<struct<question:string,answer:string>>")
    sound = items.isNotNull() & ~F.exists(items, odd)
    return F.when(sound, F.filter(F.transform(items, pair), valid)).otherwise(none)
