"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from prefdata.functions import fixed
from prefdata.functions import text as T
from prefdata.functions.prompts import inference_prompt, prompt_fits
from prefdata.functions.rewards import SCORERS
from prefdata.functions.rouge import rouge_l
from prefdata.operators import documents as docs
from prefdata.operators import evaluation as ev
from prefdata.operators import generate as gen
from prefdata.operators import grpo
from prefdata.operators import instructions as ins
from prefdata.operators import ordered
from prefdata.operators import preference as pref
from prefdata.operators.large_documents import chunks_of_lines
from prefdata.operators.skew import spread
from prefdata.plans import flows, inputs
from prefdata.sources import files, schemas, sinks
from prefdata.sources.scratch import materialise, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINES = r"\n+"
PREFIX_ROWS = 300
QUOTAS = {"instruction": 200, "sentiment": 50}
TEXTS_JOINED = 10
PAIRS_WANTED = 500
PAIRS_ACCEPTED = 700
KEYWORDS = ["that", "nicht", "avec"]
MODELS_WANTED = ["turn_1", "turn_2", "turn_3"]
QUESTIONS = [
    ("What is a dividend?", ""),
    ("How does a bond differ from a share?", ""),
    ("What does diversification mean?", "I have just begun to invest"),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "conversations")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


# Sources and sinks


@query
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_folder(spark)
    sinks.write_jsonl(inputs.document_instructions(_documents(spark, sf_dir)), path)
    return files.read_jsonl(spark, path, "doc_id BIGINT, " + schemas.INSTRUCTION)


@query
def jsonl_lenient(spark, sf_dir):
    """Lines of French documents are cut off; they come back whole in ``_corrupt_record``."""
    path = scratch_folder(spark)
    whole = F.to_json(F.struct("doc_id", "lang", "source"))
    cut = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"))
    line = F.when(F.col("lang") == "fr", cut).otherwise(whole)
    _documents(spark, sf_dir).select(line.alias("value")).write.text(path)
    return files.read_jsonl(spark, path, "doc_id BIGINT, lang STRING, source STRING", strict=False)


@query
def text_files_kinds(spark, sf_dir):
    """Text files are read, and named for their output; German ones are of another kind."""
    path = scratch_folder(spark)
    rows = _documents(spark, sf_dir).select("lang", "text")
    german = F.col("lang") == "de"
    rows.filter(~german).write.partitionBy("lang").text(path)
    rows.filter(german).write.mode("append").partitionBy("lang").json(path)
    read, rejects = files.read_documents(spark, path)
    lang = F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang")
    name = F.regexp_extract("output_name", r"/part-[^/_]*(_[^/]*)$", 1)
    found = read.select(lang, "extension", F.lit("read").alias("kind"), name.alias("output"))
    other = rejects.select(lang, "extension", F.lit("rejected").alias("kind"), F.lit("").alias("output"))
    return found.union(other.filter("lang <> ''")).distinct()


@query
def prefix_scan(spark, sf_dir):
    return files.read_prefix(
        spark, f"{sf_dir}/documents.parquet", PREFIX_ROWS, "doc_id"
    ).select("doc_id", "lang", "source", "text")


@query
def text_files_scan(spark, sf_dir):
    path = scratch_folder(spark)
    (
        _documents(spark, sf_dir)
        .select("lang", "text")
        .write.option("maxRecordsPerFile", 1000)
        .partitionBy("lang")
        .text(path)
    )
    found, _ = files.read_documents(spark, path)
    body = F.regexp_replace("text", r"\n\z", "")
    return found.select(
        F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang"),
        "extension",
        F.explode(F.split(body, "\n")).alias("line"),
    )


@query
def partitioned_pairs(spark, sf_dir):
    path = scratch_folder(spark)
    schema = "doc_id BIGINT, " + schemas.PREFERENCE

    def write(rows: DataFrame, model: str) -> None:
        # A join's tasks and stored files are large, so that a model's rows need no shuffle to be written.
        sinks.write_per_model(rows.withColumn("model", F.lit(model)), path, gather=False, compression="lz4")

    write(_pairs(spark, sf_dir), "first")
    pairs = files.read_jsonl(spark, f"{path}/model=first", schema)
    write(pairs, "second")
    swapped = pairs.withColumns(
        {"chosen": F.col("rejected"), "rejected": F.col("chosen")}
    )
    write(swapped, "second")
    return files.read_jsonl(spark, path, f"{schema}, model STRING")


@query
def eval_results_json(spark, sf_dir):
    path = scratch_folder(spark)
    sinks.write_results(ev.results_document(_summary(spark, sf_dir)), path)
    parsed = spark.read.text(path).select(
        F.from_json("value", schemas.EVAL_RESULTS).alias("results")
    )
    back = parsed.select(F.explode("results").alias("model", "metrics"))
    return _rounded(back.select("model", "metrics.*"), *ev.METRICS)


@query
def write_if_absent(spark, sf_dir):
    path = scratch_folder(spark)
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    first = sinks.write_if_absent(documents, path)
    again = sinks.write_if_absent(documents.filter("doc_id < 0"), path)
    return spark.read.parquet(path).select(
        "*", F.lit(first).alias("wrote_first"), F.lit(again).alias("wrote_again")
    )


# Projections and predicates


@query
def strip_text(spark, sf_dir):
    padded = F.concat(F.lit("\t\xa0 "), "text", F.lit("\u3000\x1f\n"))
    return _documents(spark, sf_dir).select("doc_id", T.strip(padded).alias("text"))


@query
def answer_stats(spark, sf_dir):
    return spread(_documents(spark, sf_dir), "doc_id").select(
        "doc_id",
        T.preview("text", 100).alias("preview"),
        T.has_digit("text").alias("has_digit"),
        T.char_count("text").alias("n_chars"),
        T.word_count("text").alias("n_words"),
    )


@query
def normalize_sentiment(spark, sf_dir):
    rows = inputs.document_sentiments(_documents(spark, sf_dir))
    return ins.normalize_sentiment(rows, "id")


@query
def normalize_question(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(
        "doc_id",
        F.nullif("source", F.lit("src0")).alias("system_prompt"),
        F.concat(F.lit("What is written in "), "lang").alias("question"),
        F.col("text").alias("response"),
    )
    return ins.normalize_question(rows, "doc_id")


@query
def render_prompt(spark, sf_dir):
    rows = inputs.pair_instructions(_conversations(spark, sf_dir))
    prompt = inference_prompt("instruction", "input")
    return rows.select("id", prompt.alias("prompt"))


@query
def render_sft_text(spark, sf_dir):
    rows = inputs.pair_instructions(_conversations(spark, sf_dir))
    return ins.render_training_text(rows).select("id", "text")


@query
def grpo_prompts(spark, sf_dir):
    rows = inputs.pair_instructions(_conversations(spark, sf_dir))
    return ins.prompt_set(rows, "id")


@query
def topic_subset(spark, sf_dir):
    found = ins.topic_subset(spread(_documents(spark, sf_dir), "doc_id"), ["text"], KEYWORDS)
    return found.select("doc_id", "lang")


# Mixing


@query
def source_quota(spark, sf_dir):
    return ordered.first_rows(
        ins.concatenate(*[
            df.withColumn("source", F.lit(name))
            for name, df in _mix_sources(spark, sf_dir).items()
        ]),
        QUOTAS,
        ["id"],
        by="source",
    ).select("source", "id", "instruction", "output")


@query
def sft_mix(spark, sf_dir):
    mixed = ins.mix(_mix_sources(spark, sf_dir), fixed.SFT_QUOTAS, "id")
    return ins.render_training_text(mixed).select("shuffle_key", "row_id", "text")


@query
def seeded_sample(spark, sf_dir):
    sample = ordered.seeded_sample(
        _documents(spark, sf_dir), fixed.NUM_EVAL_SAMPLES, "doc_id"
    )
    return sample.select("shuffle_key", "doc_id", "text")


def _mix_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sentiments = inputs.document_sentiments(_documents(spark, sf_dir))
    return {
        "instruction": inputs.pair_instructions(_conversations(spark, sf_dir)),
        "sentiment": ins.normalize_sentiment(sentiments, "id"),
    }


# Preference triples


@query
def transcript_stitch(spark, sf_dir):
    return inputs.transcripts(_conversations(spark, sf_dir))


@query
def hh_parse(spark, sf_dir):
    return inputs.transcript_triples(_conversations(spark, sf_dir))


@query
def hh_pairs(spark, sf_dir):
    return inputs.transcript_triples(
        _conversations(spark, sf_dir), fixed.MIN_TRANSCRIPT_REPLY
    )


@query
def hh_parse_rows(spark, sf_dir):
    return pref.parse_transcripts(inputs.transcript_rows(_conversations(spark, sf_dir)), "conv_id")


@query
def hh_pairs_rows(spark, sf_dir):
    return pref.transcript_pairs(inputs.transcript_rows(_conversations(spark, sf_dir)), "conv_id")


@query
def prefix_by_text(spark, sf_dir):
    """Keys that all begin alike, as addresses do."""
    keyed = _documents(spark, sf_dir).select(
        F.concat(F.lit("https://www.example.org/"), "source", F.lit("/"), "lang", F.lit("/"),
                 F.lpad("doc_id", 9, "0")).alias("url"),
        "doc_id", "text",
    )
    return ordered.first_rows(keyed, PREFIX_ROWS, ["url"])


def _pair_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = spread(_documents(spark, sf_dir), "doc_id")
    labels = inputs.table(spark, sf_dir, "labels")
    return (
        inputs.document_instructions(documents),
        inputs.document_generations(documents, labels),
    )


def _pairs(spark: SparkSession, sf_dir: str, n: int | None = None) -> DataFrame:
    return pref.preference_pairs(*_pair_inputs(spark, sf_dir), "doc_id", n)


def _candidates(source: DataFrame, generations: DataFrame) -> DataFrame:
    return source.join(generations, "doc_id").select(
        "doc_id",
        "instruction",
        "input",
        T.strip("output").alias("chosen"),
        T.strip("text").alias("rejected"),
    )


@query
def pref_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query
def pref_pairs_first(spark, sf_dir):
    return _pairs(spark, sf_dir, PAIRS_WANTED)


@query
def pref_pairs_accepted(spark, sf_dir):
    """As many triples as are wanted, however many rows that takes."""
    source, generations = _pair_inputs(spark, sf_dir)

    def answer(prompts: DataFrame) -> DataFrame:
        return generations.join(prompts.select("doc_id"), "doc_id", "left_semi")

    return pref.first_accepted(source, "doc_id", PAIRS_ACCEPTED, answer)


@query
def pref_pairs_counts(spark, sf_dir):
    source, generations = _pair_inputs(spark, sf_dir)
    n_read = pref.over_fetch(PAIRS_WANTED)
    read = materialise(ordered.first_rows(source, n_read, ["doc_id"]))
    answers = generations.join(read.select("doc_id"), "doc_id", "left_semi")
    return pref.preference_counts(
        _candidates(read, answers), "doc_id", PAIRS_WANTED
    )


@query
def funnel_counts(spark, sf_dir):
    return ins.funnel_counts(
        _candidates(*_pair_inputs(spark, sf_dir)),
        {
            "read": F.lit(True),
            "chosen long enough": pref.chosen_long_enough(),
            "rejected usable": pref.rejected_usable(),
            "prompt fits": prompt_fits(inference_prompt("instruction", "input")),
        },
    )


@query
def score_pairs(spark, sf_dir):
    comments = inputs.scored_comments(_conversations(spark, sf_dir))
    scored = grpo.score(comments, completion="body", total="score")
    pairs = pref.score_pairs(scored, "conv_id")
    return _rounded(pairs, "chosen_score", "rejected_score")


@query
def post_pairs(spark, sf_dir):
    posts = inputs.document_posts(_documents(spark, sf_dir))
    return pref.post_pairs(posts, "doc_id")


# Rewards


def _completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(_documents(spark, sf_dir), "doc_id")
    return inputs.document_completions(documents)


def _one_reward(name: str) -> Query:
    def run(spark, sf_dir):
        value = SCORERS[name](F.col("completion"), F.col("prompt"))
        return _completions(spark, sf_dir).select("doc_id", value.alias("reward"))

    run.__name__ = f"reward_{name}"
    return run


for _name in SCORERS:
    query(_one_reward(_name))


@query
def reward_combined(spark, sf_dir):
    scored = grpo.score(_completions(spark, sf_dir))
    return _rounded(scored.drop("prompt", "completion"), "reward")


@F.pandas_udf(DoubleType())
def _comma_rate(completion: pd.Series, prompt: pd.Series) -> pd.Series:
    return completion.str.count(",") / (1.0 + prompt.str.len())


@query
def reward_custom(spark, sf_dir):
    registry = {"length": (0.5, SCORERS["length"]), "commas": (0.25, _comma_rate)}
    scored = grpo.score(_completions(spark, sf_dir), registry)
    return _rounded(scored.drop("prompt", "completion"), "commas_reward", "reward")


@query
def prompt_fanout(spark, sf_dir):
    return grpo.fan_out(grpo_prompts(spark, sf_dir))


@query
def group_advantage(spark, sf_dir):
    pairs = inputs.turn_pairs(_conversations(spark, sf_dir))
    scored = pairs.select(
        F.col("conv_id").alias("prompt_id"),
        F.col("turn").alias("sample_id"),
        SCORERS["length"](F.col("completion")).alias("reward"),
    )
    return _rounded(grpo.group_advantage(scored), "advantage")


# Documents


@query
def doc_chunks(spark, sf_dir):
    documents = spread(_documents(spark, sf_dir), "doc_id")
    return docs.document_chunks(documents, "doc_id", separator=LINES)


@query
def doc_chunks_blank_lines(spark, sf_dir):
    documents = spread(_documents(spark, sf_dir), "doc_id")
    return docs.document_chunks(documents, "doc_id")


@query
def doc_chunks_large(spark, sf_dir):
    """Ten documents after another are one text; five of them are a piece."""
    lines = _documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("_line", "text"))
    lines = lines.select(
        F.floor(F.col("doc_id") / TEXTS_JOINED).alias("key"),
        F.floor(F.col("doc_id") / (TEXTS_JOINED // 2)).alias("piece"),
        (F.shiftleft("doc_id", 31) + F.col("_line")).alias("position"), "text",
    )
    chunks = chunks_of_lines(lines, by_line=True)
    return chunks.select(F.col("key").alias("text_no"), "chunk_no", "chunk")


@query
def qa_refused(spark, sf_dir):
    refused = docs.refused_replies(inputs.replies(_conversations(spark, sf_dir)), "conv_id", "turn", "kind")
    return refused.drop("reply")


@query
def chunk_stats(spark, sf_dir):
    documents = spread(_documents(spark, sf_dir), "doc_id")
    return docs.chunk_stats(documents, "lang", separator=LINES)


@query
def render_qa_prompt(spark, sf_dir):
    return docs.qa_requests(doc_chunks(spark, sf_dir)).drop("chunk")


@query
def qa_extract(spark, sf_dir):
    replies = inputs.replies(_conversations(spark, sf_dir))
    return docs.qa_rows(replies, "conv_id", "turn", "kind")


@query
def qa_stats(spark, sf_dir):
    replies = inputs.replies(_conversations(spark, sf_dir))
    return docs.qa_stats(replies, "kind")


# Generation


TOO_LONG = 250


def _echo_model():
    def answer(prompts):
        if any(len(p) > TOO_LONG for p in prompts):
            raise ValueError("prompt too long")
        return ["You said: " + p for p in prompts]

    return answer


@query
def batch_generate(spark, sf_dir):
    prompts = render_prompt(spark, sf_dir)
    answers = materialise(gen.batch_generate(prompts, "id", _echo_model, "echo"))
    return answers.drop("elapsed_s")


# Evaluation


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _conversations(spark, sf_dir)
    return ev.store_evaluation(
        inputs.predictions(conversations),
        inputs.samples(conversations),
        ["sample_id", "turn"],
    ).scores()


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.summarise(_scores(spark, sf_dir))


@query
def rouge_l_scores(spark, sf_dir):
    conversations = _conversations(spark, sf_dir)
    replies = inputs.turn_pairs(conversations)
    score = rouge_l("completion", "prompt")
    return _rounded(replies.select("conv_id", "turn", score.alias("rouge_l")), "rouge_l")


@query
def win_flag(spark, sf_dir):
    scores = _scores(spark, sf_dir).drop("answer", "elapsed_s")
    return _rounded(scores, "rouge_l", "rouge_l_rejected")


@query
def eval_summary(spark, sf_dir):
    return ev.by_name(_rounded(_summary(spark, sf_dir), *ev.METRICS))


@query
def eval_filtered(spark, sf_dir):
    conversations = _conversations(spark, sf_dir)
    wanted = ev.only_models(inputs.predictions(conversations), MODELS_WANTED)
    complete = ev.complete_models(wanted, inputs.manifest(conversations))
    stored = ev.store_evaluation(
        complete, inputs.samples(conversations), ["sample_id", "turn"]
    )
    return _rounded(ev.summarise(stored.scores()), *ev.METRICS)


@query
def eval_best_model(spark, sf_dir):
    return ev.best_models(_rounded(_summary(spark, sf_dir), *ev.METRICS))


@query
def eval_adjacent_delta(spark, sf_dir):
    deltas = ev.adjacent_deltas(_summary(spark, sf_dir))
    return _rounded(deltas, "rouge_delta_pct", "win_delta")


@query
def model_question_grid(spark, sf_dir):
    models = inputs.predictions(_conversations(spark, sf_dir)).select("model").distinct()
    return ev.question_grid(models, QUESTIONS)


QUERIES["rouge_l"] = QUERIES.pop("rouge_l_scores")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewards of every completion and its advantage inside its prompt's group."""
    pairs = inputs.turn_pairs(_conversations(spark, sf_dir))
    named = pairs.withColumnsRenamed({"conv_id": "prompt_id", "turn": "sample_id"})
    return flows.advantage_data(named, "prompt_id", "sample_id")
