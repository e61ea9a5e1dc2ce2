"""Predictions of several models against chosen and rejected answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefdata.functions import fixed
from prefdata.functions.rouge import rouge_l_against
from prefdata.functions.text import word_count
from prefdata.operators.skew import frequent_keys, salted_join
from prefdata.sources.buckets import BUCKET_BYTES, Buckets, bucket_count, write_buckets
from prefdata.sources.scratch import materialise

METRICS = [
    "rouge_l_mean",
    "rouge_l_max",
    "win_rate",
    "avg_length",
    "avg_latency",
    "total_time",
]


def only_models(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Rows of the named models; no names, all models."""
    return df.filter(F.col("model").isin(names)) if names else df


def complete_models(
    models: DataFrame, manifest: DataFrame, file: str = "config.json"
) -> DataFrame:
    """Rows of the models that have the required file in a (model, file) manifest."""
    having = manifest.filter(F.col("file") == file).select("model").distinct()
    return models.join(having, "model", "left_semi")


def question_grid(models: DataFrame, questions: list[tuple[str, str]]) -> DataFrame:
    """Every model with each of a few given (instruction, input) questions."""
    listed = F.array(
        *[
            F.struct(F.lit(q).alias("instruction"), F.lit(x).alias("input"))
            for q, x in questions
        ]
    )
    return (
        models.select("model", F.posexplode(listed).alias("question_no", "_q"))
        .withColumn("question_no", F.col("question_no").cast("bigint"))
        .select("model", "question_no", "_q.instruction", "_q.input")
    )


@dataclass(frozen=True)
class Evaluation:
    """Predictions and samples stored in buckets of ``sample_id``."""

    predictions: Buckets
    samples: Buckets
    prediction_id: list[str]

    def append(self, predictions: DataFrame) -> None:
        """The predictions of further models."""
        self.predictions.append(predictions)

    def scores(self) -> DataFrame:
        """``sample_scores`` of what is stored; bucket meets bucket, without a shuffle.

        Predictions of one sample are as many as there are models. Where a bucket is so large that
        some samples must have more, their predictions are counted once, in place; those of
        frequent samples are read by files and joined salted.
        """
        predictions, samples = self.predictions.read(), self.samples.read()
        if self.predictions.largest() <= 4 * BUCKET_BYTES:
            return _scored(predictions.hint("merge").join(samples, "sample_id"), predictions.columns)
        sizes = materialise(predictions.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_rows")))
        frequent = frequent_keys(sizes, "sample_id")
        few = predictions.join(F.broadcast(frequent), "sample_id", "left_anti")
        many = self.predictions.read_files().join(F.broadcast(frequent), "sample_id", "left_semi")
        pairs = few.hint("merge").join(samples, "sample_id").unionByName(
            salted_join(many, samples, "sample_id", self.prediction_id, sizes)
        )
        return _scored(pairs, predictions.columns)


def store_evaluation(
    predictions: DataFrame, samples: DataFrame, prediction_id: list[str], buckets: int | None = None
) -> Evaluation:
    """Write both sides once; every metric is then read from there.

    ``predictions``: (sample_id, model, answer, elapsed_s and the columns of
    ``prediction_id``, which tell predictions apart); ``samples``: (sample_id, chosen,
    rejected), one row per sample.
    """
    n = buckets or bucket_count(predictions.sparkSession)
    return Evaluation(
        write_buckets(predictions, "sample_id", n), write_buckets(samples, "sample_id", n), prediction_id
    )


def sample_scores(
    predictions: DataFrame, samples: DataFrame, prediction_id: list[str]
) -> DataFrame:
    """ROUGE-L against both answers, win flag and words of each prediction; see ``store_evaluation``.

    For one look at predictions that are not kept; counting them for the join reads them twice.
    """
    pairs = salted_join(predictions, samples, "sample_id", prediction_id)
    return _scored(pairs, predictions.columns)


def _scored(pairs: DataFrame, keep: list[str]) -> DataFrame:
    scores = pairs.withColumn(
        "_scores", rouge_l_against("answer", "chosen", "rejected")
    )
    return scores.select(
        *keep,
        F.col("_scores.chosen").alias("rouge_l"),
        F.col("_scores.rejected").alias("rouge_l_rejected"),
        win_flag(F.col("_scores.chosen"), F.col("_scores.rejected")).alias("win"),
        word_count("answer").alias("n_words"),
    )


def win_flag(chosen_score, rejected_score):
    """1 where the chosen answer is strictly nearer."""
    return F.when(chosen_score > rejected_score, 1).otherwise(0).cast("bigint")


def summarise(scores: DataFrame) -> DataFrame:
    """One row per model with its six metrics."""
    return scores.groupBy("model").agg(
        F.avg("rouge_l").alias("rouge_l_mean"),
        F.max("rouge_l").alias("rouge_l_max"),
        F.avg(F.col("win").cast("double")).alias("win_rate"),
        F.avg("n_words").alias("avg_length"),
        F.avg("elapsed_s").alias("avg_latency"),
        F.sum("elapsed_s").alias("total_time"),
    )


def by_name(summary: DataFrame) -> DataFrame:
    return summary.orderBy("model")


def best_models(
    summary: DataFrame, metrics: tuple[str, ...] = ("rouge_l_mean", "win_rate")
) -> DataFrame:
    """(metric, model, value) of the best model; a tie goes to the first name."""
    long = summary.unpivot(["model"], list(metrics), "metric", "value")
    rank = Window.partitionBy("metric").orderBy(F.desc("value"), "model")
    return (
        long.withColumn("_rank", F.row_number().over(rank))
        .filter("_rank = 1")
        .drop("_rank")
    )


def adjacent_deltas(summary: DataFrame) -> DataFrame:
    """Each model against the one before it by name.

    The window has no partition: it runs on the summary, one row per model.
    """
    by_name = Window.orderBy("model")
    before = summary.select(
        "model",
        "rouge_l_mean",
        "win_rate",
        F.lag("model").over(by_name).alias("base_model"),
        F.lag("rouge_l_mean").over(by_name).alias("_rouge"),
        F.lag("win_rate").over(by_name).alias("_win"),
    )
    base = F.greatest(F.col("_rouge"), F.lit(fixed.DELTA_FLOOR))
    return before.filter("base_model IS NOT NULL").select(
        "base_model",
        "model",
        ((F.col("rouge_l_mean") - F.col("_rouge")) / base * 100).alias("rouge_delta_pct"),
        (F.col("win_rate") - F.col("_win")).alias("win_delta"),
    )


def results_document(summary: DataFrame) -> DataFrame:
    """The summary as one JSON object, model to metrics, in the column ``value``."""
    entries = F.sort_array(
        F.collect_list(F.struct("model", F.struct(*METRICS).alias("metrics")))
    )
    return summary.agg(F.to_json(F.map_from_entries(entries)).alias("value"))
