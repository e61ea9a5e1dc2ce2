"""Vectors of a table as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, zero: bool) -> DataFrame:
    """(vec_id long, v array<double>) of the rows that can be compared.

    Left out are rows with a null id, null vectors, vectors with a null or non-finite
    component, empty ones, zero vectors unless ``zero``, and vectors whose length is not
    the most frequent one.
    """
    rows = df.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    top = float(np.finfo(np.float64).max)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= top))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    if not zero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    common = lengths.first()
    return rows.filter(F.size("v") == F.lit(common["n"] if common else 0))


def is_finite(vector: Column) -> Column:
    """Whether a vector (array<double>) has components, all of them finite numbers; never null."""
    top = float(np.finfo(np.float64).max)
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= top))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def finite(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, v array<double>) of the rows whose vector has components, all of them finite numbers."""
    rows = df.select(key, F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(is_finite(F.col("v")))


def one_length(rows: DataFrame) -> int:
    """The length of all vectors v, 0 without rows; several lengths are an error that names them."""
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().limit(10).collect()]
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(lengths)}")
    return lengths[0] if lengths else 0


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
