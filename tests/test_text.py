from pyspark.sql import functions as F

from prefdata.functions import prompts, text
from prefdata.functions.fixed import WHITE_SPACE


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_white_space_is_the_whole_unicode_set():
    assert set(WHITE_SPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_strip_matches_every_space_character(spark):
    rows = [(f"{c}a{c} b{c}{c}",) for c in WHITE_SPACE] + [(WHITE_SPACE,), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = [(r.t or "", r.v) for r in df.select("t", text.strip("t").alias("v")).collect()]
    assert got == [(t, t.strip()) for t, _ in got]


def test_word_count_splits_at_any_white_space(spark):
    samples = ["", "  ", "a", "a b　c\x1cd", " x y\n\nz ", "é中 文 w", "a" * 500]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = df.select("t", text.word_count("t").alias("n")).collect()
    assert [r.n for r in got] == [len(r.t.split()) for r in got]


def test_preview_digit_and_length(spark):
    assert one(spark, text.preview(F.lit("ab\ncd"), 4)) == "ab c"
    assert one(spark, text.has_digit(F.lit("x３")))
    assert not one(spark, text.has_digit(F.lit("xyz")))
    assert one(spark, text.char_count(F.lit("a😀中"))) == 3


def test_cjk_and_words_are_separate_tokens_only_from_the_left(spark):
    assert one(spark, text.word_tokens(F.lit("abc中文"))) == ["abc中文"]
    assert one(spark, text.word_tokens(F.lit("中文abc"))) == ["中文", "abc"]


def test_number_mentions(spark):
    cases = {"0.25": 1, "15.25": 2, "5": 0, "1.5": 1, "12\n元": 1, "7 %": 1, "３５％": 1}
    for value, n in cases.items():
        assert one(spark, text.number_mentions(F.lit(value))) == n, value


def test_keywords_are_whole_words_in_any_case(spark):
    df = spark.createDataFrame(
        [("A Bond.",), ("bonds",), ("vagabond",), ("c++!",), ("BOND",), (None,)], "t string"
    )
    hit = text.mentions_any("t", ["bond", "c++"])
    assert [bool(r.v) for r in df.select(hit.alias("v")).collect()] == [
        True, False, False, True, True, False,
    ]
    nested = spark.createDataFrame([("vagabond",), ("vagabonds",), ("xbond",)], "t string")
    hit = text.mentions_any("t", ["bond", "vagabond"])
    assert [r.v for r in nested.select(hit.alias("v")).collect()] == [True, False, False]


def test_prompts(spark):
    q, x = F.lit(" q "), F.lit(None).cast("string")
    assert one(spark, prompts.inference_prompt(q, x)) == "指令: q\n输入: \n回答:"
    assert one(spark, prompts.inference_prompt(q, x, False)) == "指令:  q \n输入: \n回答:"
    assert one(spark, prompts.training_text(q, x, F.lit("o\n"))) == "指令: q\n输入: \n回答: o"
    request = one(spark, prompts.qa_request(F.lit("some {chunk} $1 text")))
    assert "\nsome {chunk} $1 text\n" in request and '{"question": "问题1"' in request
    assert one(spark, prompts.prompt_fits(F.lit("x" * 300)))
    assert not one(spark, prompts.prompt_fits(F.lit("x" * 301)))
