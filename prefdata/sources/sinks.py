"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from prefdata.sources.scratch import is_complete


def write_jsonl(df: DataFrame, path: str) -> int:
    """JSON lines, replacing what is there; nulls are written, text is not escaped. Gives the rows written,
    counted by the job that writes them."""
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def write_per_model(
    df: DataFrame, path: str, model: str = "model", gather: bool = True, compression: str = "none"
) -> int:
    """One folder per model; only the folders of the models in ``df`` are replaced. Gives the rows written.

    The rebalance hint gathers the rows of a model into few files and splits a model
    that has a large share of them. Without ``gather`` rows are written where they lie and nothing is shuffled:
    for stored tables, whose tasks are large, and few models. ``compression``: codec of the files.
    """
    seen = Observation()
    rows = df.hint("rebalance", model) if gather else df
    (
        rows.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .option("compression", compression)
        .partitionBy(model)
        .json(path)
    )
    return seen.get["n"]


def write_results(document: DataFrame, path: str) -> None:
    """A table of one text column, as text."""
    document.write.mode("overwrite").text(path)


def write_if_absent(df: DataFrame, path: str) -> bool:
    """Write Parquet unless a finished result is there; says whether it wrote.

    What an interrupted job left behind is replaced.
    """
    if is_complete(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True
