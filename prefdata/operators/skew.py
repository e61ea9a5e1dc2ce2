"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Inputs below this size are shared out over all cores before row-local work.
SMALL_INPUT_BYTES = 256 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition a small scan, so that its row-local CPU work uses all cores.

    Small is a matter of bytes, as Spark estimates them for the scan: however many cores
    there are, a large table is not shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_INPUT_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def frequent_keys(
    sizes: DataFrame, key: str, parts: int = 10_000, smallest_piece: int = 100_000
) -> DataFrame:
    """(key, _pieces) of the keys with more than 1/``parts`` of all rows and ``smallest_piece``: fewer
    than ``parts`` for any data."""
    share = sizes.agg(
        F.greatest(F.sum("n_rows") / parts, F.lit(float(smallest_piece))).alias("share")
    ).scalar()
    return (
        sizes.withColumn("_share", share)
        .filter(F.col("n_rows") > F.col("_share"))
        .select(key, F.ceil(F.col("n_rows") / F.col("_share")).alias("_pieces"))
    )


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    sizes: DataFrame | None = None,
    how: str = "inner",
    parts: int = 10_000,
    smallest_piece: int = 100_000,
) -> DataFrame:
    """Join ``rows`` with a ``lookup`` that has one row per ``key``.

    A key with more than 1/``parts`` of all rows (and more than ``smallest_piece``) is
    cut into pieces of about that share, by a hash of ``spread_by`` (columns that
    identify a row), and its lookup row is copied once per piece. Fewer than ``parts``
    keys can be that frequent, so the broadcast list of them is bounded whatever the
    data. ``sizes`` (``key``, ``n_rows``) may be passed where the counts are known; they
    need not be exact.
    """
    if sizes is None:
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    frequent = F.broadcast(frequent_keys(sizes, key, parts, smallest_piece))
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    salted_rows = rows.join(frequent, key, "left").withColumn(
        "_piece", F.pmod(F.xxhash64(*spread_by), pieces)
    )
    salted_lookup = lookup.join(frequent, key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1))
    )
    return (
        salted_rows.drop("_pieces")
        .join(salted_lookup.drop("_pieces"), [key, "_piece"], how)
        .drop("_piece")
    )
