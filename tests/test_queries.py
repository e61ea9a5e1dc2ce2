"""Every registered query against its SQL, on the smallest tables."""

import os
import subprocess
import sys
from glob import glob

import duckdb
import pytest

import __spark_entry__ as entry_module
from prefdata.plans.oracle import ORACLE
from prefdata.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The queries of the subpackage llm have tests of their own.
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

WITH_PYTHON = {
    "reward_custom",
    "rouge_l",
    "win_flag",
    "eval_summary",
    "eval_filtered",
    "eval_best_model",
    "eval_adjacent_delta",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert ORACLE.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, plan_of, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan or name in WITH_PYTHON
    names = sorted(df.columns)
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == names
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types

    def key(row):
        return [(v is None, str(v)) for v in row]

    got = sorted((tuple(r) for r in df.select(names).collect()), key=key)
    want = sorted(relation.select(*names).fetchall(), key=key)
    assert got == want
    assert got


def test_queries_without_a_library_that_only_the_subpackage_needs():
    """The queries of the first folders are there, with a warning."""
    code = (
        "import sys; sys.modules['xxhash'] = sys.modules['ahocorasick'] = None\n"
        "import __spark_entry__ as e; assert 'hh_parse' in e.queries() and 'op3_jaccard_join' not in e.queries()"
    )
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    there = os.path.isdir(os.path.join(root, "prefdata", "llm"))
    assert run.returncode == 0 and ("are left out" in run.stderr) == there, run.stderr


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert rows.columns == [
        "prompt_id", "sample_id", "length_reward", "number_reward", "no_repeat_reward",
        "format_reward", "reward", "advantage",
    ]
    assert rows.count() > 0
