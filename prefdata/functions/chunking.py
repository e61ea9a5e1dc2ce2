"""Cutting a document into overlapping chunks of whole paragraphs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.text import as_column, strip

BLANK_LINES = r"\n{2,}"

# Paragraphs folded at a time. Appending to an array copies it, so chunks are gathered
# per block and the blocks are joined at the end: book-size texts stay affordable.
_BLOCK = 256


def paragraphs(c: Column | str, separator: str = BLANK_LINES) -> Column:
    """Stripped, non-empty paragraphs."""
    pieces = F.transform(F.split(strip(c), separator), strip)
    return F.filter(pieces, lambda p: p != "")


def pack(
    paras: Column | str,
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    shortest: int = fixed.MIN_CHUNK,
) -> Column:
    """Greedy packing of paragraphs; a new chunk starts with the tail of the last one.

    A paragraph is never cut, so a chunk may be longer than ``size``. Short chunks are
    dropped at the end, after their tail was carried on.
    """
    paras = as_column(paras)
    nothing = F.array().cast("array<string>")

    def add(state: Column, para: Column) -> Column:
        text = state["open"]
        fits = F.length(text) + F.length(para) <= size
        kept = F.right(text, F.lit(overlap)) if overlap > 0 else F.lit("")
        closes = ~fits & (text != "")
        return F.struct(
            state["blocks"].alias("blocks"),
            F.when(closes, F.concat(state["done"], F.array(strip(text))))
            .otherwise(state["done"])
            .alias("done"),
            F.concat(F.when(fits, text).otherwise(kept), para, F.lit("\n")).alias("open"),
        )

    # The inner fold carries the finished blocks along: it is then the whole next
    # state, and is not run once per field.
    def add_block(state: Column, block: Column) -> Column:
        return F.aggregate(
            F.slice(paras, block * _BLOCK + 1, F.lit(_BLOCK)),
            F.struct(
                state["blocks"].alias("blocks"),
                nothing.alias("done"),
                state["open"].alias("open"),
            ),
            add,
            lambda end: F.struct(
                F.concat(end["blocks"], F.array(end["done"])).alias("blocks"),
                end["open"].alias("open"),
            ),
        )

    last_block = F.floor((F.size(paras) - 1) / _BLOCK).cast("int")
    packed = F.aggregate(
        F.sequence(F.lit(0), F.greatest(last_block, F.lit(0))),
        F.struct(
            F.array().cast("array<array<string>>").alias("blocks"),
            F.lit("").alias("open"),
        ),
        add_block,
        lambda state: F.concat(
            F.flatten(state["blocks"]), F.array(strip(state["open"]))
        ),
    )
    return F.filter(packed, lambda chunk: F.length(chunk) >= shortest)
