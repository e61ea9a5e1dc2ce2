"""Documents to chunks, and model replies to instruction rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.chunking import BLANK_LINES, pack, paragraphs
from prefdata.functions.prompts import qa_request
from prefdata.functions.replies import array_items, qa_pairs
from prefdata.functions.text import char_count


def _with_chunks(
    df: DataFrame, text: str, size: int, overlap: int, separator: str
) -> DataFrame:
    # Two steps, so that the paragraphs are computed once per document.
    return df.withColumn("_paras", paragraphs(text, separator)).withColumn(
        "_chunks", pack("_paras", size, overlap)
    )


def document_chunks(
    df: DataFrame,
    *keep: str,
    text: str = "text",
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    separator: str = BLANK_LINES,
) -> DataFrame:
    """One row per chunk: (``keep``, chunk_no from 0, chunk)."""
    chunked = _with_chunks(df.select(*keep, text), text, size, overlap, separator)
    # Exploding without "outer" would make Spark test the size of the array first, and
    # so fold every document twice.
    return (
        chunked.select(*keep, F.posexplode_outer("_chunks").alias("_no", "chunk"))
        .filter("chunk IS NOT NULL")
        .select(*keep, F.col("_no").cast("bigint").alias("chunk_no"), "chunk")
    )


def chunk_stats(
    df: DataFrame,
    *by: str,
    text: str = "text",
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    separator: str = BLANK_LINES,
) -> DataFrame:
    """Documents, characters and chunks, in total or per ``by``."""
    return (
        _with_chunks(df.select(*by, text), text, size, overlap, separator)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_documents"),
            F.sum(char_count(text)).alias("n_chars"),
            F.sum(F.size("_chunks").cast("bigint")).alias("n_chunks"),
        )
    )


def qa_requests(chunks: DataFrame, chunk: str = "chunk") -> DataFrame:
    return chunks.withColumn("prompt", qa_request(chunk))


def _with_pairs(replies: DataFrame, reply: str) -> DataFrame:
    # Two steps, so that each reply is parsed once.
    return replies.withColumn("_items", array_items(reply)).withColumn(
        "_pairs", qa_pairs("_items")
    )


def refused_replies(replies: DataFrame, *keep: str, reply: str = "reply") -> DataFrame:
    """(``keep``, reply) of the replies that give no row although there is a text: what stands in them is no JSON
    array of objects with texts, or has no valid pair."""
    return (
        _with_pairs(replies.select(*keep, reply), reply)
        .filter((F.coalesce(F.length(reply), F.lit(0)) > 0) & (F.size("_pairs") == 0))
        .select(*keep, reply)
    )


def qa_rows(replies: DataFrame, *keep: str, reply: str = "reply") -> DataFrame:
    """Instruction rows out of replies; a reply without valid pairs gives none."""
    return (
        _with_pairs(replies.select(*keep, reply), reply)
        .select(*keep, F.inline_outer("_pairs"))
        .filter("question IS NOT NULL")
        .select(
            *keep,
            F.col("question").alias("instruction"),
            F.lit("").alias("input"),
            F.col("answer").alias("output"),
        )
    )


def qa_stats(replies: DataFrame, *by: str, reply: str = "reply") -> DataFrame:
    """Replies and pairs extracted from them."""
    return (
        _with_pairs(replies.select(*by, reply), reply)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_replies"),
            F.sum(F.size("_pairs").cast("bigint")).alias("n_pairs"),
        )
    )
