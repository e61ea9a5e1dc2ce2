"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prefdata.llm import (
    ann,
    html_extract,
    jaccard_join,
    mixing,
    near_dedup,
    ngram_lm,
    periodic_runs,
    quality,
    sos_packing,
    token_output,
    topk,
    toxicity,
    whitening,
)
from prefdata.llm.common import table


def _of(operator: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*[table(spark, sf_dir, name) for name in names])

    return run


QUERIES = {
    "op1_quality": _of(quality.op1_quality, "documents", "labels"),
    "op2_ngram_lm": _of(ngram_lm.op2_lm, "documents"),
    "op3_jaccard_join": _of(jaccard_join.op3_jaccard_join, "documents"),
    "op4_packing": _of(sos_packing.op4_packing, "documents"),
    "op5_token_output": _of(token_output.op5_token_output, "documents"),
    "op6_toxicity": _of(toxicity.op6_toxicity, "documents", "labels"),
    "op7_topk": _of(topk.op7_topk, "embeddings"),
    "op8_html": _of(html_extract.op8_html, "pages"),
    "op9_mixing": _of(mixing.op9_mixing, "documents"),
    "op10_ann": _of(ann.op10_ann, "embeddings"),
    "op11_near_dedup": _of(near_dedup.op11_near_dedup, "embeddings"),
    "op12_whitening": _of(whitening.op12_whitening, "embeddings"),
    "op13_periodic_runs": _of(periodic_runs.op13_periodic_runs, "documents"),
}

# What these operators compute (learned scores, packings, flows, extracted texts) SQL cannot
# express, or not on whole tables; tests compare them with brute force.
ORACLE: dict[str, str] = {}
