"""Tables stored in buckets of a key: two of them are joined where they lie, without a shuffle."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from prefdata.sources.scratch import scratch_folder

# Bytes that a bucket may hold; in one with several times as many some keys are looked at one by one.
BUCKET_BYTES = 128 << 20


@dataclass(frozen=True)
class Buckets:
    """A table in the session's catalog and the folder with its files."""

    spark: SparkSession
    name: str
    path: str
    key: str
    n: int

    def read(self) -> DataFrame:
        """By buckets: what lies in one is one task."""
        return self.spark.table(self.name)

    def read_files(self) -> DataFrame:
        """By files, which are split where they are large."""
        return self.spark.read.schema(self.read().schema).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        """More rows, for example those of another model."""
        _write(df, self.name, self.path, self.key, self.n, "append")

    def largest(self) -> int:
        """Bytes of the largest bucket, from the names and sizes of the files alone."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
        sizes: dict[str, int] = {}
        for file in files:
            found = re.search(r"_(\d+)(?:\.[^_]*)?$", file.getPath().getName())
            if found:
                sizes[found[1]] = sizes.get(found[1], 0) + file.getLen()
        return max(sizes.values(), default=0)


def bucket_count(spark: SparkSession) -> int:
    """As many as the session's shuffles have partitions: a join of buckets stands in for one."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_buckets(df: DataFrame, key: str, n: int | None = None) -> Buckets:
    """Store ``df`` in ``n`` buckets of ``key``; tables that are to be joined need the same ``n``."""
    spark, path = df.sparkSession, scratch_folder(df.sparkSession)
    table = Buckets(spark, f"prefdata_{uuid.uuid4().hex}", path, key, n or bucket_count(spark))
    _write(df, table.name, path, key, table.n, "overwrite")
    return table


def write_rows(df: DataFrame, key: str, n: int) -> Buckets:
    """``write_buckets`` for rows of some megabytes each: a file has few of them, so they are stored by the task that
    makes them and never shuffled."""
    spark, path = df.sparkSession, scratch_folder(df.sparkSession)
    table = Buckets(spark, f"prefdata_{uuid.uuid4().hex}", path, key, n)
    rows = df.write.mode("overwrite").option("compression", "zstd").option("path", path)
    rows.bucketBy(n, key).saveAsTable(table.name, format="parquet")
    return table


def _write(df: DataFrame, name: str, path: str, key: str, n: int, mode: str) -> None:
    # A bucket's rows meet in few tasks, so that there are few files; a large bucket is shared out.
    rows = df.hint("rebalance", key)
    rows.write.mode(mode).bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name, format="parquet")
