import random
import re

import pytest

from prefdata.operators import preference as pref

MARK = "\n\nAssistant:"
TWO_TURNS = f"\n\nHuman: a{MARK} b\n\nHuman: c{MARK} d "
GOLDEN_TRANSCRIPTS = [
    (TWO_TURNS, TWO_TURNS[:-3], "d"),
    ("no marker", "no marker", ""),
    ("x" + MARK, "x" + MARK, ""),
    ("", "", ""),
    (MARK + MARK + "😀 z", MARK + MARK, "😀 z"),
]


def test_golden_transcripts(spark):
    df = spark.createDataFrame(
        [(i, t, t) for i, (t, _, _) in enumerate(GOLDEN_TRANSCRIPTS)],
        "id int, chosen string, rejected string",
    )
    for r in pref.parse_transcripts(df, "id").collect():
        _, prompt, reply = GOLDEN_TRANSCRIPTS[r.id]
        assert (r.prompt, r.chosen, r.rejected) == (prompt, reply, reply)


def test_reply_length_limit(spark):
    rows = [(MARK + "x" * i, MARK + "y" * j) for i in (10, 11) for j in (10, 11)]
    df = spark.createDataFrame(rows, "chosen string, rejected string")
    assert [tuple(r) for r in pref.transcript_pairs(df).collect()] == [
        (MARK, "x" * 11, "y" * 11)
    ]


RUN = """
WITH flags AS (SELECT id, length(chosen) >= 20 AS long,
    length(chosen) >= 20 AND length(rejected) >= 10 AS good FROM pairs),
had AS (SELECT *, count(*) FILTER (good) OVER (ORDER BY id) - good::INT AS before FROM flags)
SELECT count(*) FILTER (good AND before < {n}), count(*) FILTER (NOT good AND id < coalesce(
  (SELECT min(id) FROM had WHERE long AND before >= {n}), 1000000)) FROM had"""


def counts_by_sql(lengths, n):
    """Accepted and skipped rows from running counts."""
    import duckdb
    import pandas as pd

    rows = [(i, "c" * a, "r" * b) for i, (a, b) in enumerate(lengths)]
    pairs = pd.DataFrame(rows, columns=["id", "chosen", "rejected"]).astype({"id": "int64"})  # noqa: F841
    pairs = pairs.astype({"chosen": "string", "rejected": "string"})
    return duckdb.sql(RUN.format(n=n)).fetchall()[0]


def pair_frame(spark, lengths):
    rows = [(i, "c" * a, "r" * b) for i, (a, b) in enumerate(lengths)]
    return spark.createDataFrame(rows, "id long, chosen string, rejected string")


@pytest.mark.parametrize(
    "lengths, n, accepted, skipped",
    [
        ([(30, 30), (19, 30), (30, 9), (30, 10), (5, 30), (30, 30), (5, 30)], 2, [0, 3], 3),
        ([(30, 30), (5, 5)], 5, [0], 1),
        ([(20, 10), (5, 30), (5, 30)], 1, [0], 2),
    ],
)
def test_golden_counts(spark, lengths, n, accepted, skipped):
    assert counts_by_sql(lengths, n) == (len(accepted), skipped)
    got = pref.preference_counts(pair_frame(spark, lengths), "id", n).first()
    assert (got.accepted, got.skipped) == (len(accepted), skipped)


def test_counts_of_random_runs(spark):
    rng = random.Random(5)
    for _ in range(6):
        lengths = [
            (rng.choice([5, 19, 20, 30]), rng.choice([0, 9, 10, 40]))
            for _ in range(rng.randint(1, 40))
        ]
        n = rng.randint(1, 8)
        got = pref.preference_counts(pair_frame(spark, lengths), "id", n).first()
        assert (got.accepted, got.skipped) == counts_by_sql(lengths, n)


def test_pairs_from_generated_answers(spark):
    source = spark.createDataFrame(
        [
            (0, " q0 ", None, "c" * 30 + "\n"),
            (1, "q1", "x", "c" * 19 + "  "),
            (2, "q2", "x", "d" * 20),
            (3, "q3", "x", "e" * 20),
            (4, "q4", "x", "f" * 20),
            (5, "q5", "x", "g" * 20),
            (6, "q6", "x", "h" * 20),
        ],
        "id long, instruction string, input string, output string",
    )
    generations = spark.createDataFrame(
        [(0, " r" * 10), (1, "r" * 30), (2, "d" * 20 + " "), (3, "r" * 9), (4, "r" * 10)]
        + [(5, None), (6, "r" * 11)],
        "id long, text string",
    )
    every = pref.preference_pairs(source, generations, "id")
    assert sorted(r.id for r in every.collect()) == [0, 4, 6]
    first = every.orderBy("id").first()
    assert (first.prompt, first.chosen) == ("指令: q0\n输入: \n回答:", "c" * 30)
    assert first.rejected == (" r" * 10).strip()
    # Two wanted: the prefix has two rows, of which one is good.
    assert pref.over_fetch(2) == 2
    assert [r.id for r in pref.preference_pairs(source, generations, "id", 2).collect()] == [0]
    assert [r.id for r in pref.preference_pairs(source, generations, "id", 5).collect()] == [
        0, 4,
    ]


COMMENTS = [
    ("one", 0, "good", 1523),
    ("one", 1, "medium", 89),
    ("one", 2, "bad", -12),
    ("tie", 0, "a", 5),
    ("tie", 1, "b", 5),
    ("first", 0, "x", 1),
    ("first", 1, "y", 7),
    ("first", 2, "z", 7),
    ("first", 3, "w", 1),
    ("single", 0, "s", 3),
]


def test_pairs_from_scores(spark):
    df = spark.createDataFrame(COMMENTS, "post string, position long, body string, score long")
    rows = pref.score_pairs(df.repartition(3), "post").collect()
    assert sorted((r.post, r.chosen, r.rejected) for r in rows) == [
        ("first", "y", "w"),
        ("one", "good", "bad"),
    ]


def test_pairs_from_posts_are_the_same_and_need_no_shuffle(spark, plan_of):
    posts = {}
    for post, _, body, score in COMMENTS:
        posts.setdefault(post, []).append((body, score))
    df = spark.createDataFrame(
        [(p, "text", c) for p, c in posts.items()] + [("none", None, []), ("null", "", None)],
        "title string, selftext string, comments array<struct<body:string,score:bigint>>",
    )
    pairs = pref.post_pairs(df, "title")
    assert sorted(map(tuple, pairs.collect())) == [
        ("first", "指令: first\n输入: text\n回答:", "y", "w"),
        ("one", "指令: one\n输入: text\n回答:", "good", "bad"),
    ]
    assert "Exchange" not in plan_of(pairs)


def test_stitching_does_not_depend_on_the_parts(spark):
    rows = [(0, i, f"t{i}") for i in range(25)] + [(1, 0, "only"), (2, 10**9, "x"), (2, 7, "y")]
    df = spark.createDataFrame(rows, "conv long, turn long, text string").repartition(5)
    for size in (2, 7, 10_000):
        got = {r.conv: r.text for r in pref.stitch(df, "conv", "turn", "text", "|", size).collect()}
        assert got == {0: "|".join(f"t{i}" for i in range(25)), 1: "only", 2: "y|x"}


def test_triples_by_turn_are_those_of_the_whole_texts(spark, monkeypatch):
    rng = random.Random(3)
    marks = [MARK + " ", "\n\nHuman: ", "\n\nSystem: "]
    dialogues = [
        [rng.choice(marks) + rng.choice(["a", f"b{MARK} c", " d ", "e" * 12]) for _ in range(n)]
        for n in [1, 1, 2, 3, 5, 8, 13, 40, 900]
    ]
    dialogues.append(["\n\nHuman: x"] * 4)
    turns = [(c, 3 * t, text) for c, d in enumerate(dialogues) for t, text in enumerate(d)]
    df = spark.createDataFrame(turns, "c long, t long, text string").repartition(6)
    pairs = [(c, "".join(a), "".join(b)) for c, (a, b) in enumerate(zip(dialogues, dialogues[1:]))]
    whole = spark.createDataFrame(pairs, "c long, chosen string, rejected string")
    for shortest, part_size in ((None, 1024), (3, 1024), (None, 2), (3, 7)):
        want = pref.parse_transcripts(whole, "c")
        if shortest is not None:
            want = want.filter(pref.replies_long_enough(shortest))
        pieces = pref.turn_triples(
            df, "c", "t", "text", pref.F.col("c") + 1, shortest=shortest, part_size=part_size
        )
        got = {}
        for r in sorted(pieces.collect(), key=lambda r: (r.c, r.t)):
            prompt, _, _ = got.get(r.c, ("", None, None))
            got[r.c] = (prompt + r.prompt, r.chosen, r.rejected)
        assert got == {r.c: (r.prompt, r.chosen, r.rejected) for r in want.collect()}


def test_turns_of_a_long_dialogue_never_meet_by_its_key_alone(spark, tmp_path):
    """Whatever carries texts of turns is dealt by (dialogue, range)."""
    rows = [(0 if i % 3 == 0 else i, i, f"{MARK} t{i}") for i in range(3000)]
    path = str(tmp_path / "turns")
    spark.createDataFrame(rows, "c long, t long, text string").write.parquet(path)
    df = spark.read.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        triples = pref.turn_triples(df, "c", "t", "text", pref.F.col("c") + 1, part_size=64)
        explain = triples._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert triples.filter("c = 0").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    sections = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: (\S+, \S+)", explain)
    with_turns = [how for columns, how in sections if "text#" in columns]
    assert with_turns and all(re.match(r"hashpartitioning\(c#\d+L?, _part#", how) for how in with_turns)


def test_a_comment_that_is_there_twice_is_one(spark):
    df = spark.createDataFrame(COMMENTS + COMMENTS, "post string, position long, body string, score long")
    want = [("first", "y", "w"), ("one", "good", "bad")]
    assert sorted((r.post, r.chosen, r.rejected) for r in pref.score_pairs(df, "post").collect()) == want
    same_place = spark.createDataFrame(
        [("p", 1, "best", 5), ("p", 1, "worst", 3), ("p", 2, "mid", 4)],
        "post string, position long, body string, score long",
    )
    assert [(r.chosen, r.rejected) for r in pref.score_pairs(same_place, "post").collect()] == [("best", "worst")]


def test_comments_without_a_score_are_left_out(spark):
    rows = COMMENTS + [("one", 3, "none", None), ("none", 0, "x", None), ("none", 1, "y", 1)]
    df = spark.createDataFrame(rows, "post string, position long, body string, score long")
    want = [("first", "y", "w"), ("one", "good", "bad")]
    assert sorted((r.post, r.chosen, r.rejected) for r in pref.score_pairs(df, "post").collect()) == want
    posts = df.groupBy("post").agg(
        pref.F.expr("array_sort(collect_list(struct(position, body, score))) AS comments")
    ).selectExpr("post AS title", "'' AS selftext", "transform(comments, c -> struct(c.body, c.score)) AS comments")
    got = pref.post_pairs(posts, "title").collect()
    assert sorted((r.title, r.chosen, r.rejected) for r in got) == want
