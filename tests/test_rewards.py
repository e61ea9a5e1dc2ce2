import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from prefdata.operators import grpo

P = "指令: What is PE\n输入: \n回答:"
GOLDEN = [
    ("p", "x" * 9, -1, 0, 0.5, 0, -0.3),
    ("p", "x" * 10, 0, 0, 0.5, 0, 0.1),
    ("p", "x" * 49, 0, 0, 0.5, 0, 0.1),
    ("p", "x" * 50, 1, 0, 0.5, 0, 0.5),
    ("p", "x" * 500, 1, 0, 0.5, 0, 0.5),
    ("p", "x" * 501, 0.5, 0, 0.5, 0, 0.3),
    ("p", "x" * 800, 0.5, 0, 0.5, 0, 0.3),
    ("p", "x" * 801, 0, 0, 0.5, 0, 0.1),
    (P, "市盈率通常在 15-25 倍，约 3.5%。", 0, 1, 0.5, 0.5, 0.45),
    ("a b c d e", "a b c d e", -1, 0, -0.5, 0, -0.5),
    ("a b c d", "a b c d e", -1, 0, 0, 0, -0.4),
    ("a b c", "a b c d e", -1, 0, 0.5, 0, -0.3),
    ("q", "", -1, 0, -1, -1, -0.7),
    ("q", "  \n", -1, 0, -1, -1, -0.7),
    ("q", "...", -1, 0, -1, 0.5, -0.55),
    ("q", "0.25", -1, 0.5, 0.5, 0, -0.15),
    ("q", "5", -1, 0, 0.5, 0, -0.3),
    ("q", "15.25 ok", -1, 0.5, 0.5, 0, -0.15),
    ("q", "３５％ ok", -1, 0.5, 0.5, 0, -0.15),
    ("q", "12\n元", -1, 0.5, 0.5, 0, -0.15),
]


def test_golden_rewards(spark):
    df = spark.createDataFrame(
        [(i, g[0], g[1]) for i, g in enumerate(GOLDEN)],
        "id long, prompt string, completion string",
    )
    for row in grpo.score(df).collect():
        want = GOLDEN[row.id]
        got = (row.length_reward, row.number_reward, row.no_repeat_reward, row.format_reward)
        assert got == want[2:6], want
        assert math.isclose(row.reward, want[6], abs_tol=1e-9), want
        assert -0.7 - 1e-9 <= row.reward <= 0.85 + 1e-9


def test_missing_completion_counts_as_empty(spark):
    df = spark.createDataFrame([(None, None)], "prompt string, completion string")
    assert math.isclose(grpo.score(df).first().reward, -0.7, abs_tol=1e-9)


def test_rewards_need_no_python(spark, plan_of):
    df = spark.createDataFrame([("p", "c")], "prompt string, completion string")
    assert "Python" not in plan_of(grpo.score(df))
    assert "Exchange" not in plan_of(grpo.score(df))


def test_own_scorer_in_the_registry(spark):
    @F.pandas_udf(DoubleType())
    def shouting(completion: pd.Series, prompt: pd.Series) -> pd.Series:
        return completion.str.isupper().astype("float64")

    df = spark.createDataFrame([("p", "HI"), ("p", "hi")], "prompt string, completion string")
    scored = grpo.score(df, {"shouting": (2.0, shouting)}).orderBy("completion").collect()
    assert [r.reward for r in scored] == [2.0, 0.0]


def test_fan_out(spark):
    rows = grpo.fan_out(spark.range(3)).collect()
    assert sorted((r.id, r.sample_id) for r in rows) == [
        (i, k) for i in range(3) for k in range(1, 5)
    ]


@pytest.mark.parametrize("smallest_piece", [100_000, 1])
def test_advantage_of_a_frequent_group(spark, smallest_piece):
    """A third of the rows in one group, with and without cutting the group."""
    rewards = pd.DataFrame({"sample_id": range(300)})
    rewards["prompt_id"] = [0 if i % 3 == 0 else i for i in range(300)]
    rewards.loc[rewards.sample_id % 7 == 1, "prompt_id"] = 1000
    rewards["reward"] = [[-1.0, 0.0, 0.5, 1.0][i * i % 4] for i in range(300)]
    df = spark.createDataFrame(rewards)
    got = grpo.group_advantage(df, smallest_piece=smallest_piece).toPandas()
    assert len(got) == 300
    by = rewards.groupby("prompt_id").reward
    want = ((rewards.reward - by.transform("mean")) / (by.transform("std") + 1e-4)).fillna(0)
    got = got.set_index("sample_id").advantage.sort_index()
    assert (got - want.set_axis(rewards.sample_id)).abs().max() < 1e-9
    assert abs(got.sum()) < 1e-6


def test_advantage_has_no_window_and_broadcasts_only_the_frequent_keys(spark, plan_of):
    df = spark.range(10).selectExpr("id % 3 AS prompt_id", "id AS sample_id", "1.0D AS reward")
    assert "Window" not in plan_of(grpo.group_advantage(df))


def test_rows_without_a_group_are_a_group(spark):
    rows = [(1, 1, 0.0), (1, 2, 1.0), (None, 1, 2.0), (None, 2, 4.0)]
    df = spark.createDataFrame(rows, "prompt_id long, sample_id long, reward double")
    got = {(r.prompt_id, r.sample_id): r.advantage for r in grpo.group_advantage(df).collect()}
    assert len(got) == 4 and got[None, 1] == pytest.approx(-1 / (2**0.5 + 1e-4))
