"""Inputs of the operators, derived from the test tables by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.operators.preference import stitch, turn_triples

# Turns looked at together. A conversation of any length is cut at this size.
TURN_BLOCK = 1024

# Turns are dealt to this many models.
MODELS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """Assistant turns right after a user turn: (conv_id, turn, prompt, completion).

    Turns are numbered without gaps; after a gap there is no pair. The last turn of a block
    is copied to the next block, so neighbours are always found within one block and a long conversation is
    shared out over tasks.
    """
    block = F.floor(F.col("turn") / TURN_BLOCK)
    is_last = F.col("turn") % TURN_BLOCK == TURN_BLOCK - 1
    blocks = F.when(is_last, F.array(block, block + 1)).otherwise(F.array(block))
    turns = Window.partitionBy("conv_id", "_block").orderBy("turn")
    return (
        conversations.filter(F.col("role").isin("user", "assistant"))
        .withColumn("_block", F.explode(blocks))
        .select(
            "conv_id",
            "turn",
            "role",
            F.col("text").alias("completion"),
            F.lag("turn").over(turns).alias("_turn"),
            F.lag("role").over(turns).alias("_role"),
            F.lag("text").over(turns).alias("prompt"),
        )
        .filter("role = 'assistant' AND _role = 'user' AND _turn = turn - 1")
        .select("conv_id", "turn", "prompt", "completion")
    )


def last_replies(conversations: DataFrame) -> DataFrame:
    """Final assistant reply of each conversation: (conv_id, text)."""
    return (
        conversations.filter("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max_by("text", "turn").alias("text"))
    )


def pair_instructions(conversations: DataFrame) -> DataFrame:
    """Turn pairs as instruction rows with a single key."""
    return turn_pairs(conversations).select(
        (F.shiftleft("conv_id", 32) + F.col("turn")).alias("id"),
        F.col("prompt").alias("instruction"),
        F.lit("").alias("input"),
        F.col("completion").alias("output"),
    )


def document_sentiments(documents: DataFrame) -> DataFrame:
    """Documents as (id, input, output) rows: tell the language of a text."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("input"),
        F.col("lang").alias("output"),
    )


def document_instructions(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        F.concat(F.lit("Write a text in "), "lang").alias("instruction"),
        F.col("source").alias("input"),
        F.col("text").alias("output"),
    )


def document_generations(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One answer per document: the next document, or a copy where labelled toxic."""
    following = documents.select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("_next")
    )
    return (
        documents.select("doc_id", F.col("text").alias("_own"))
        .join(following, "doc_id")
        .join(labels.select("doc_id", "toxic"), "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.col("toxic") == 1, F.col("_own"))
            .otherwise(F.col("_next"))
            .alias("text"),
        )
    )


def document_completions(documents: DataFrame) -> DataFrame:
    """Documents as completions, each prompted by its last line."""
    return documents.select(
        "doc_id",
        F.substring_index("text", "\n", -1).alias("prompt"),
        F.col("text").alias("completion"),
    )


def document_posts(documents: DataFrame) -> DataFrame:
    """Documents as posts: each line is a comment, scored by its length."""
    comments = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            line.alias("body"), F.length(line).cast("bigint").alias("score")
        ),
    )
    return documents.select(
        "doc_id",
        F.col("lang").alias("title"),
        F.col("source").alias("selftext"),
        comments.alias("comments"),
    )


def marked_turns(conversations: DataFrame) -> DataFrame:
    """Turns with their marks: (conv_id, turn, text)."""
    mark = (
        F.when(F.col("role") == "assistant", fixed.ASSISTANT_MARK)
        .when(F.col("role") == "user", fixed.HUMAN_MARK)
        .otherwise("\n\nSystem:")
    )
    return conversations.select(
        "conv_id", "turn", F.concat(mark, F.lit(" "), "text").alias("text")
    )


def transcripts(conversations: DataFrame) -> DataFrame:
    """Whole dialogues with marks: (conv_id, text)."""
    return stitch(marked_turns(conversations), "conv_id", "turn", "text", "")


def transcript_triples(conversations: DataFrame, shortest: int | None = None) -> DataFrame:
    """A dialogue as chosen, the one of the next conversation as rejected, turn by turn."""
    following = F.col("conv_id") + 1
    turns = marked_turns(conversations)
    return turn_triples(turns, "conv_id", "turn", "text", following, shortest=shortest)


def transcript_rows(conversations: DataFrame) -> DataFrame:
    """Pairs of whole dialogues: (conv_id, chosen, rejected), as they are published."""
    whole = transcripts(conversations)
    following = whole.select((F.col("conv_id") - 1).alias("conv_id"), F.col("text").alias("rejected"))
    return whole.select("conv_id", F.col("text").alias("chosen")).join(following, "conv_id")


def scored_comments(conversations: DataFrame) -> DataFrame:
    return turn_pairs(conversations).select(
        "conv_id",
        F.col("turn").alias("position"),
        F.col("completion").alias("body"),
        "prompt",
    )


def replies(conversations: DataFrame) -> DataFrame:
    """Model replies, good and bad, for every turn pair: (conv_id, turn, kind, reply)."""

    def one(answer) -> F.Column:
        item = F.struct(F.col("prompt").alias("question"), answer.alias("answer"))
        return F.to_json(F.array(item))

    good = one(F.col("completion"))
    kinds = {
        "good": F.concat(F.lit("Sure: "), good, F.lit(" done [1]")),
        "bracket": one(F.concat("completion", F.lit(" [1]"))),
        "cut_off": F.replace(good, F.lit("}]"), F.lit("")),
        "short": one(F.lit("012345678")),
        "two": F.concat(
            F.lit('[{"answer":"0123456789"},'), F.substring(good, 2, 1 << 30)
        ),
        "number": F.concat(F.lit('[{"question":5},'), F.substring(good, 2, 1 << 30)),
        "null": F.concat(F.lit('[{"question":null},'), F.substring(good, 2, 1 << 30)),
        "quotes": F.lit("[{'question':'q','answer':'0123456789'}]"),
    }
    rows = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), reply.alias("reply"))
            for kind, reply in kinds.items()
        ]
    )
    return turn_pairs(conversations).select("conv_id", "turn", F.inline(rows))


def samples(conversations: DataFrame) -> DataFrame:
    """Last reply of a conversation as chosen, that of the next one as rejected."""
    last = last_replies(conversations)
    following = last.select(
        (F.col("conv_id") - 1).alias("conv_id"), F.col("text").alias("rejected")
    )
    return last.join(following, "conv_id").select(
        F.col("conv_id").alias("sample_id"), F.col("text").alias("chosen"), "rejected"
    )


def model_name(turn: str = "turn"):
    return F.concat(F.lit("turn_"), (F.col(turn) % MODELS).cast("string"))


def predictions(conversations: DataFrame) -> DataFrame:
    """Every reply as the answer of the model named after its turn."""
    return turn_pairs(conversations).select(
        F.col("conv_id").alias("sample_id"),
        "turn",
        model_name().alias("model"),
        F.col("completion").alias("answer"),
        (F.length("completion") / F.lit(100.0)).alias("elapsed_s"),
    )


def manifest(conversations: DataFrame) -> DataFrame:
    """(model, file): a model has its configuration if it ever spoke as the system, or as
    the user right after it: turns 0 and 1 of the conversations, and those that share their models."""
    file = F.when(F.col("turn") % MODELS < 2, "config.json").otherwise("notes.txt")
    return conversations.select(model_name().alias("model"), file.alias("file"))
