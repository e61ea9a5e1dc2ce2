"""Small tables with nulls, empty and long texts, repeated rows and columns with clashing names."""

import random

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, score double, component string, _copies int, word string"
)


def rows_of(texts, sources=None):
    """(doc_id, text, ...) with values in the extra columns that no operator may take for its own."""
    out = []
    for i, text in enumerate(texts):
        source = sources[i] if sources else f"s{i % 3}"
        out.append((i, text, "en", source, len(text or ""), -7, 99.0, "x", 5, "w"))
    return out


def frame(spark, texts, sources=None):
    return spark.createDataFrame(rows_of(texts, sources), DOCS)


def prose(seed, n_words):
    rng = random.Random(seed)
    syllables = ["an", "er", "the", "on", "in", "ti", "re", "st", "ou", "ha"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n_words)]
    return " ".join(words)


def edited(text, seed, edits):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)
