"""Quality by hierarchical empirical Bayes: what a text shows, and where it comes from.

A text's evidence is the log-likelihood ratio of a naive Bayes model over counted features
(share of capitals and signs, repeated words and lines, word lengths ...), fitted by one
grouped aggregation over labelled texts. A site is a host and a path below it. The expected
number of good documents per path, host and in all gives a posterior of each: a path's rate is
shrunk towards its host's and a host's towards the global rate, so sites with few documents
stay near the level above. The strength of the shrinking comes from the spread of the rates
(method of moments). A document's posterior joins both: its own odds, times the site's odds
against the global odds.

Defined cases: a null text is the empty text; a null host or path is a site of its own;
repeated rows count each, and equal rows have equal scores; without labels of both kinds the evidence
is 0 and the prior decides; an empty table gives an empty result; a null doc_id never teaches;
other columns are kept (``keep_good``) or not looked at, whatever their names.
"""

import math
import re
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import labelled_sample, map_batches, store, table, text_bytes

MAX_TRAINING_ROWS = 20_000  # labelled rows that teach
MAX_EVIDENCE = 12.0  # log-odds that a text can show at most
STRENGTH = (2.0, 1e4)  # prior documents that a site's parent counts for

_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_INNER_CAPITAL = re.compile(rb"[A-Za-z][A-Z]")
_DIGITS = b"0123456789"
_SIGNS = b"!#$%&*+/<=>@[\\]^_`{|}~"
_SHARES = np.array([0.001, 0.01, 0.03, 0.07, 0.15, 0.3, 0.5, 0.8])
FEATURES = ("capitals", "digits", "signs", "echo", "variety", "top_word", "word_length", "lines")
# Three features look at repetition; together they count for one and a half.
WEIGHTS = (1.0, 1.0, 1.0, 0.5, 0.5, 0.5, 1.0, 1.0)
FEW_WORDS = 16  # too few to tell repetition from chance
FEW_LINES = 4


def features(text: bytes) -> list[int]:
    """A small number for each of ``FEATURES``."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0] * len(FEATURES)
    size = len(text)
    letters = size - len(text.translate(None, _LETTERS))
    signs = size - len(text.translate(None, _SIGNS))
    counts = Counter(words)
    lines = text.split(b"\n")
    size_class = min(int(math.log2(n)), 12)
    shares = np.searchsorted(
        _SHARES,
        [
            2 * len(_INNER_CAPITAL.findall(text)) / max(1, letters),
            (size - len(text.translate(None, _DIGITS))) / size,
            signs / size,
            sum(map(eq, words, words[1:])) / n,
            len(counts) / n,
            max(counts.values()) / n,
        ],
    ).tolist()
    # Variety and top word go by the length; of few words neither says anything.
    for k in (4, 5):
        shares[k] += 16 * size_class
    word_length = min(int((size - n - signs) / n), 20)
    if n < FEW_WORDS:
        shares[3:], word_length = [0, 0, 0], 0
    repeated = 1 - len(set(lines)) / len(lines) if len(lines) >= FEW_LINES else 0
    return [*shares, word_length, int(np.searchsorted(_SHARES, repeated))]


def train(
    docs: DataFrame, labels: DataFrame, teach: Column | None = None, max_rows: int = MAX_TRAINING_ROWS
) -> dict:
    """Log-likelihood ratio of every value of every feature, and the share of good texts."""
    sample = labelled_sample(docs, labels, "quality", max_rows, teach)

    def count(batches):
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                values = features(text)
                yield {
                    "feature": list(range(len(values))),
                    "value": values,
                    "label": [label] * len(values),
                }

    # The result has a row for each value of a feature and label: a few hundred.
    rows = (
        map_batches(
            sample.select(text_bytes().alias("text"), "label"),
            count,
            "feature int, value int, label int",
        )
        .groupBy("feature", "value")
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
        .collect()
    )
    good = sum(r["good"] for r in rows if r["feature"] == 0)
    bad = sum(r["bad"] for r in rows if r["feature"] == 0)
    # An unseen value says nothing, and a rare one little: half a row of each kind is added,
    # in proportion to the kinds.
    share = (good + 1) / (good + bad + 2)
    ratios = {
        (r["feature"], r["value"]): math.log((r["good"] + share) / (good + 1))
        - math.log((r["bad"] + 1 - share) / (bad + 1))
        for r in rows
    }
    return {"ratios": ratios if good and bad else {}, "good": share if good + bad else 0.5}


def evidence_of(model: dict):
    """Function from texts to log-likelihood ratios."""
    ratios = model["ratios"]

    def evidence(texts: list[bytes]) -> np.ndarray:
        sums = [
            sum(w * ratios.get(x, 0.0) for w, x in zip(WEIGHTS, enumerate(features(t)))) for t in texts
        ]
        return np.clip(np.array(sums, dtype=float), -MAX_EVIDENCE, MAX_EVIDENCE)

    return evidence


def _evidence(model: dict):
    """The evidence of a text (UTF-8) as a function of columns."""
    from pyspark.sql.functions import pandas_udf

    state = []

    @pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        if not state:
            state.append(evidence_of(model))
        return pd.Series(state[0](list(texts)))

    return evidence


def with_evidence(docs: DataFrame, model: dict, name: str = "_evidence") -> DataFrame:
    """All columns, and the evidence of ``text``."""
    return docs.withColumn(name, _evidence(model)(text_bytes()))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(_host, _path, host_rate, path_rate) from (_host, _path, _good): one row per path.

    ``_good`` is a document's probability by its text alone. Documents are added up per path
    on the map side first, so a host with a third of all rows is a few rows per task.
    """
    paths = store(
        scored.groupBy("_host", "_path").agg(
            F.count(F.lit(1)).alias("n"), F.sum("_good").alias("good")
        )
    )
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    if not total[0]:
        rate = F.lit(None).cast("double")
        return paths.select("_host", "_path", rate.alias("host_rate"), rate.alias("path_rate"))
    world = min(max(total[1] / total[0], 1e-6), 1 - 1e-6)
    host_strength = _strength(hosts, "host_n", "host_good", F.lit(world))
    host_rate = (F.col("host_good") + host_strength * world) / (F.col("host_n") + host_strength)
    hosts = hosts.withColumn("host_rate", host_rate)
    joined = paths.join(hosts, "_host")
    path_strength = _strength(joined, "n", "good", F.col("host_rate"))
    path_rate = (F.col("good") + path_strength * F.col("host_rate")) / (F.col("n") + path_strength)
    return store(
        joined.select("_host", "_path", "host_rate", path_rate.alias("path_rate"))
    )


def _strength(sites: DataFrame, n: str, good: str, rate: Column) -> float:
    """Documents that the level above counts for: small where rates differ much between sites."""
    gap = F.col(good) / F.col(n) - rate
    row = sites.agg(
        F.sum(F.col(n) * gap * gap).alias("seen"),
        F.sum(rate * (1 - rate)).alias("chance"),
        F.sum(n).alias("n"),
        F.count(F.lit(1)).alias("sites"),
        F.avg(rate * (1 - rate)).alias("spread"),
    ).first()
    low, high = STRENGTH
    # E[sum n * gap^2] = sum of rate (1 - rate) + n * variance between the sites.
    between = max(0.0, row["seen"] - row["chance"]) / row["n"]
    return high if between <= 0 else min(max(row["spread"] / between - 1, low), high)


def _site(column: Column) -> Column:
    """Null and text never meet: a text gets a sign in front."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def _assessed(docs: DataFrame, model: dict, host: Column, path: Column, keep: Column) -> DataFrame:
    """(doc, evidence, host_rate, path_rate, posterior) of every row; ``doc`` is ``keep``.

    Texts are looked at once: their evidence is stored with what is kept of the row, and both the sites
    and the rows' posteriors are made from there.
    """
    base = math.log(model["good"] / (1 - model["good"]))
    rows = docs.select(
        keep.alias("doc"), _site(host).alias("_host"), _site(path).alias("_path"),
        _evidence(model)(text_bytes()).alias("evidence"),
    )
    rows = store(rows)
    sites = site_posteriors(
        rows.select("_host", "_path", (1 / (1 + F.exp(-(F.col("evidence") + base)))).alias("_good"))
    )
    # sites is a stored table, so Spark knows its size: small ones are broadcast, others
    # joined by a shuffle in which AQE splits frequent sites.
    rate = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_rate")))
    odds = F.col("evidence") + F.log(rate / (1 - rate))
    return rows.join(sites, ["_host", "_path"], "left").select(
        "doc", "evidence", "host_rate", "path_rate", (1 / (1 + F.exp(-odds))).alias("posterior")
    )


def assess(docs: DataFrame, model: dict, host: Column, path: Column) -> DataFrame:
    """All columns of ``docs`` and ``_evidence``, ``_host_rate``, ``_path_rate``, ``_posterior``; a column
    of ``docs`` that has one of these names is left out."""
    added = ("evidence", "host_rate", "path_rate", "posterior")
    kept = [c for c in docs.columns if c.lower() not in {f"_{name}" for name in added}]
    rated = _assessed(docs, model, host, path, F.struct(*[F.col(f"`{c}`") for c in kept]))
    return rated.select("doc.*", *[F.col(name).alias(f"_{name}") for name in added])


def keep_good(docs: DataFrame, model: dict, host: Column, path: Column, threshold: float = 0.5) -> DataFrame:
    """The rows with a posterior of at least ``threshold``, with the columns they had."""
    rated = _assessed(docs, model, host, path, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return rated.filter(F.col("posterior") >= threshold).select("doc.*")


def op1_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Posterior of every document; host: its source, path: its language there.

    Labels with crc32(doc_id) mod 5 = 0 are held out.
    """
    from prefdata.llm.common import crc_fold

    held_out = crc_fold("doc_id", 5) == 0
    model = train(docs, labels, ~held_out)
    rated = _assessed(docs, model, F.col("source"), F.col("lang"), F.struct("doc_id", held_out.alias("held_out")))
    return rated.select(
        "doc.doc_id",
        "doc.held_out",
        "evidence",
        "host_rate",
        "path_rate",
        F.col("posterior").alias("score"),
        (F.col("posterior") >= 0.5).cast("int").alias("predicted"),
    )
