"""The shared folder for results that cut lineage or are read back."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


_written: dict[str, list[str]] = {}  # by application


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a session whose executors are threads of the driver may do without that setting; it
    gets its warehouse. Elsewhere a folder below the driver's own would be lost to the executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir names no shared folder, and executors of {master} need one")
    return spark.conf.get("spark.sql.warehouse.dir")


def scratch_folder(spark: SparkSession) -> str:
    """A new path in the shared folder; ``remove_scratch`` clears what a session wrote."""
    shared = shared_folder(spark)
    path = f"{shared.rstrip('/')}/prefdata-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete the scratch paths of this application; nothing may read them any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _written.pop(spark.sparkContext.applicationId, []):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write once, and read from there: the plan behind ``df`` is never run again."""
    spark = df.sparkSession
    path = path or scratch_folder(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(
    df: DataFrame, path: str | None = None, **counts: Column
) -> tuple[DataFrame, dict]:
    """``materialise`` and aggregates of the rows, taken by the job that writes them.

    They are taken after the last shuffle, in the tasks whose output is committed, so that a task that
    is run again does not count twice.
    """
    seen = Observation()
    stored = materialise(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), path)
    return stored, seen.get


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True where a job has written ``path`` to its end."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")
