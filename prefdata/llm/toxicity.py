"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

The lexicon is learned: from labelled texts come word beginnings that occur in toxic
texts and hardly elsewhere, weighted by their log-odds. Texts are folded before matching
(case, homoglyphs, digit and sign substitutions). Hits inside exception phrases don't
count. The weight of the hits is divided by the text's length, and the share of toxic
texts among labelled ones of that density is the score.

Defined cases: a null text is the empty text and has density 0, like any text without
hits; repeated rows are scored each; a null doc_id is scored and never teaches; without
labelled rows every score is the prior of one half toxic in a hundred; an empty table gives
an empty result; other columns of the input are not looked at.
"""

import math
import re
import unicodedata
import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import crc_fold, labelled_sample, map_batches, text_bytes

# Letters that look like Latin ones, and signs that stand for letters.
CYRILLIC = "аеорсухкмтвнійѕԁӏ"
CYRILLIC_AS = "aeopcyxkmtbhijsdl"
GREEK = "αεορυχκτνιη"
GREEK_AS = "aeopyxktvin"
SIGNS = "013457@$"
SIGNS_AS = "oieastas"
QUOTES = "\"'`´‘’“”«»„()[]{}<>*_~|.,;:!?¡¿-–—/\\"

# Phrases whose words are harmless, in folded form.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "idiot proof")

MAX_TRAINING_ROWS = 20_000  # labelled rows that teach
MAX_HELD = 100_000  # places that a task holds before it passes them on, about
MIN_WEIGHT = 3.0  # log-odds of a term, less one standard error
MIN_PLACES = 5  # places of a term in toxic texts
CHANCE_WEIGHT = 4.0  # weight in a text that counts for nothing
SHORT, LONG = 4, 32  # letters of a term that is the beginning of words

_TABLE = {ord(a): b for a, b in zip(CYRILLIC + GREEK + SIGNS, CYRILLIC_AS + GREEK_AS + SIGNS_AS)}
_TABLE |= {ord(q): " " for q in QUOTES} | dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
_NUMBER = re.compile(r"(?<!\w)[\d@$]+(?!\w)")
_WIDE = re.compile("[！-～\U0001d400-\U0001d7ff]")


def fold(text: str) -> str:
    """Lower case without look-alikes; words are divided by single blanks, one on each side."""
    if not text.isascii() and _WIDE.search(text):
        text = unicodedata.normalize("NFKC", text)
    text = _NUMBER.sub(" ", text.lower()) if _NUMBER.search(text) else text.lower()
    return f" {' '.join(text.translate(_TABLE).split())} "


def _contexts(batches):
    """Distinct (word, word before) of the folded texts, among toxic and other texts."""
    held: dict[tuple[str, str], int] = {}
    for batch in batches:
        texts, labels = batch.column("text").to_pylist(), batch.column("label").to_pylist()
        for text, label in zip(texts, labels):
            words = fold(text.decode()).split()
            kind = 2 if label else 1
            for pair in set(zip(words, ["", *words])):
                held[pair] = held.get(pair, 0) | kind
            if len(held) > MAX_HELD:
                yield _listed(held)
                held = {}
    if held:
        yield _listed(held)


def _listed(held: dict) -> dict:
    return {
        "word": [w for w, _ in held],
        "before": [xxhash.xxh3_64_intdigest(b.encode()) >> 1 for _, b in held],
        "kind": list(held.values()),
    }


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Weight of each term, from (text, label).

    A term is a word's beginning with a weight of at least ``MIN_WEIGHT`` that no single
    longer beginning could replace, and of which no part is a term. Words of fewer than ``SHORT``
    letters are terms as a whole: they end with a blank. What counts is after
    how many different words it stands in toxic and in other texts, as copies of a text
    repeat its words in the same places; there have to be ``MIN_PLACES`` in toxic texts. The weight
    less its standard error decides what is chance, at any size of the sample, and no term beyond is
    left out: the lexicon is bounded by the words of the sample.
    """
    one_per_text = sample.select(text_bytes().alias("text"), "label").dropDuplicates()
    sizes = one_per_text.groupBy("label").count().collect()
    n = {bool(r["label"]): r["count"] for r in sizes}
    n_toxic, n_other = n.get(True, 0), n.get(False, 0)
    words = (
        map_batches(one_per_text, _contexts, "word string, before long, kind int")
        .groupBy("word", "before")
        .agg(F.bit_or("kind").alias("kind"))
        .groupBy("word")
        .agg(F.count_if(F.col("kind") >= 2).alias("toxic"), F.count_if(F.col("kind") % 2 == 1).alias("other"))
    )
    # A longer word is its first LONG letters.
    lengths = F.sequence(F.lit(SHORT), F.least(F.greatest(F.length("word"), F.lit(SHORT)), F.lit(LONG)))
    beginnings = F.transform(lengths, lambda k: F.substring("word", 1, k))
    whole = F.array(F.concat("word", F.lit(" ")))
    starts = (
        words.select(
            F.explode(F.when(F.length("word") < SHORT, whole).otherwise(beginnings)).alias("term"), "toxic", "other"
        )
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(F.col("toxic") >= MIN_PLACES)
    )
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("other") + 0.5) / (n_other + 1))
    # Shares of toxic and other texts, with half a place added to each. The rows are words of at most
    # MAX_TRAINING_ROWS texts that pass the test.
    found = (
        starts.withColumn("weight", F.log(odds))
        .filter(F.col("weight") - F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5)) >= MIN_WEIGHT)
        .collect()
    )
    longer = {}
    for row in found:
        parent = row["term"][:-1]
        longer[parent] = max(longer.get(parent, 0), row["toxic"])
    closed = [r for r in found if longer.get(r["term"], 0) < 0.9 * r["toxic"]]
    lexicon = {}
    for row in sorted(closed, key=lambda r: (len(r["term"]), r["term"])):
        starts_of = (row["term"][:k] for k in range(1, len(row["term"])))
        if not any(s in lexicon for s in starts_of):
            lexicon[row["term"]] = row["weight"]
    return lexicon


class Matcher:
    """Sum of the weights of a lexicon's terms in a text, without exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(f" {term}", (len(term) + 1, weight, term))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None, phrase))
        self.empty = not (lexicon or exceptions)
        if not self.empty:
            self.automaton.make_automaton()

    def find(self, folded: str) -> list[tuple[int, int, float, str]]:
        """(start, end, weight, term) of the hits that no exception phrase holds."""
        hits, excused = [], []
        for end, (size, weight, term) in () if self.empty else self.automaton.iter(folded):
            (excused if weight is None else hits).append((end - size + 1, end, weight, term))
        if excused:
            hits = [h for h in hits if not any(x[0] <= h[0] and h[1] <= x[1] for x in excused)]
        return hits

    def weigh(self, text: str) -> tuple[float, int, int]:
        """Weight of all hits, number of hits, words."""
        folded = fold(text)
        hits = self.find(folded)
        return math.fsum(h[2] for h in hits), len(hits), folded.count(" ") - 1


def density(weight: float, n_words: int) -> float:
    """Weight per hundred words, beyond what one weak term brings by chance.

    The ten words added keep a text of few words from being all density.
    """
    return 100 * max(0.0, weight - CHANCE_WEIGHT) / (n_words + 10)


_STEPS = np.array([0.0, *(2.0**k for k in range(-5, 11))])


def learn_shares(sample: DataFrame, lexicon: dict, exceptions: tuple[str, ...]) -> list[float]:
    """Share of toxic texts at each step of density, rising (pool adjacent violators)."""

    def steps(batches):
        matcher = Matcher(lexicon, exceptions)
        for batch in batches:
            found = [
                density(w, n)
                for w, _, n in (matcher.weigh(t.decode()) for t in batch.column("text").to_pylist())
            ]
            yield {
                "step": np.searchsorted(_STEPS, found, "right").astype(np.int32) - 1,
                "label": batch.column("label"),
            }

    rows = (
        map_batches(sample.select(text_bytes().alias("text"), "label"), steps, "step int, label int")
        .groupBy("step")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
        .collect()
    )
    n, toxic = np.zeros(len(_STEPS)), np.zeros(len(_STEPS))
    for row in rows:
        n[row["step"]], toxic[row["step"]] = row["n"], row["toxic"]
    blocks = []  # [toxic, n, steps]
    for t, m in zip(toxic, n):
        # A prior of one row: clean where nothing was found, toxic where something was.
        blocks.append([t + (0.005 if not blocks else 0.9), m + 1, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] > blocks[-1][0] * blocks[-2][1]:
            t2, m2, s2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + m2, blocks[-1][2] + s2]
    return [t / m for t, m, s in blocks for _ in range(s)]


def train(
    docs: DataFrame,
    labels: DataFrame,
    teach=None,
    max_rows: int = MAX_TRAINING_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> dict:
    """Lexicon, shares and exceptions, from at most ``max_rows`` labelled texts."""
    sample = labelled_sample(docs, labels, "toxic", max_rows, teach)
    lexicon = learn_lexicon(sample)
    return {
        "lexicon": lexicon,
        "shares": learn_shares(sample, lexicon, exceptions),
        "exceptions": exceptions,
    }


def scorer(model: dict):
    """Function from texts to (scores, weights, hits)."""
    matcher = Matcher(model["lexicon"], model["exceptions"])
    shares = np.array(model["shares"])

    def score(texts: list[bytes]) -> tuple[np.ndarray, list[float], list[int]]:
        weighed = [matcher.weigh(t.decode()) for t in texts]
        dense = np.array([density(w, n) for w, _, n in weighed])
        step = np.searchsorted(_STEPS, dense, "right") - 1
        # Within a step the score rises a little with the density, without leaving the step.
        edge = np.append(_STEPS[1:], 2 * _STEPS[-1])[step]
        within = np.minimum(1, (dense - _STEPS[step]) / (edge - _STEPS[step]))
        upper = np.append(shares[1:], shares[-1])[step]
        rise = np.where(step > 0, within * (upper - shares[step]), 0)
        return np.clip(shares[step] + rise, 0, 1), [w for w, _, _ in weighed], [h for _, h, _ in weighed]

    return score


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, hits, weight) for every row."""

    def run(batches):
        scores = scorer(model)
        for batch in batches:
            value, weight, hits = scores(batch.column("text").to_pylist())
            yield {"doc_id": batch.column("doc_id"), "score": value, "hits": hits, "weight": weight}

    return map_batches(
        docs.select("doc_id", text_bytes().alias("text")),
        run,
        "doc_id long, score double, hits int, weight double",
    )


def keep_clean(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below ``threshold``, with the columns they had."""
    from pyspark.sql.functions import pandas_udf

    state = []

    @pandas_udf("double")
    def toxic_score(texts: pd.Series) -> pd.Series:
        if not state:
            state.append(scorer(model))
        return pd.Series(state[0](list(texts))[0])

    return docs.filter(toxic_score(text_bytes()) < threshold)


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; labels of the fold 0 of 5 are held out."""
    model = train(docs, labels, crc_fold("doc_id", 5) != 0)
    return score(docs, model).select(
        "doc_id",
        (crc_fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "hits",
    )
