"""Queries on tables where one conversation, source or text has a third of the rows."""

import os
import random

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

NAMES = [
    "render_prompt",
    "transcript_stitch",
    "hh_parse",
    "hh_pairs",
    "eval_best_model",
    "score_pairs",
    "group_advantage",
    "win_flag",
    "eval_summary",
    "eval_filtered",
    "source_quota",
    "sft_mix",
    "seeded_sample",
    "pref_pairs",
    "pref_pairs_first",
    "pref_pairs_counts",
    "partitioned_pairs",
    "doc_chunks",
    "chunk_stats",
]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A conversation of 4,500 turns among 9,000 others, and as many copies of a text."""
    rng = random.Random(11)
    words = ["ant", "bee", "cat", "dog", "eel", "fox", "12%", "vélo", "中文", "end."]

    def words_of(n):
        return " ".join(rng.choice(words) for _ in range(n))

    sizes = {0: 4500, **{c: rng.randint(1, 9) for c in range(1, 1800)}}

    def role(c, t):
        if c % 4 == 3:  # begins with a system turn
            return "system" if t == 0 else ("user", "assistant")[(t - 1) % 2]
        return ("user", "assistant")[t % 2]

    turns = [
        (c, t, role(c, t), words_of(rng.randint(1, 12)))
        for c, n in sizes.items()
        for t in range(n)
    ]
    copy = "\n".join(words_of(12) for _ in range(12))
    texts = [
        copy if i % 3 == 0 else "\n\n".join(words_of(rng.randint(1, 15)) for _ in range(i % 9))
        for i in range(1500)
    ]
    folder = str(tmp_path_factory.mktemp("skewed"))
    frames = {
        "conversations": pd.DataFrame(turns, columns=["conv_id", "turn", "role", "text"]),
        "documents": pd.DataFrame(
            {
                "doc_id": range(1500),
                "text": texts,
                "lang": ["en" if i % 3 == 0 else "fr" for i in range(1500)],
                "source": ["src0" if i % 3 == 0 else f"src{i % 7}" for i in range(1500)],
                "n_chars": [len(t) for t in texts],
            }
        ),
        "labels": pd.DataFrame(
            {"doc_id": range(0, 1500, 4), "quality": 1, "toxic": [i % 2 for i in range(375)]}
        ),
    }
    con = duckdb.connect()
    for name, frame in frames.items():
        path = os.path.join(folder, f"{name}.parquet")
        frame.to_parquet(path)
        con.sql(f"CREATE VIEW {name} AS FROM '{path}'")
    return folder, con


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(spark, tables, name):
    folder, con = tables
    df = entry_module.queries()[name](spark, folder)
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(names).collect())))
    sql = entry_module.oracle_sql()[name]
    assert got == sorted(map(repr, con.sql(sql).select(*names).fetchall()))
    assert got
