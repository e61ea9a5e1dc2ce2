"""One JSON-lines file per document, published when all of them are written."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "prefdata_named"


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has staged, by the names that they are to have."""

    files: dict[str, str]


class NamedFiles(DataSource):
    """Writes (name, value) rows, sorted by name within a task, as lines of the file ``name``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, value string"

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["staging"])


class NamedWriter(DataSourceWriter):
    """Tasks write below a hidden staging folder; the commit moves what the successful ones have written.

    A task that is run twice stages twice, under names of its own; only the files it reports are moved.
    Until the commit, and after an abort, no file has its name.
    """

    def __init__(self, staging: str):
        self.staging = staging

    def write(self, rows: Iterator) -> Written:
        files, out, open_name = {}, None, None
        own = posixpath.join(self.staging, uuid.uuid4().hex)
        try:
            for row in rows:
                if row["name"] != open_name:
                    if out is not None:
                        out.close()
                    open_name = row["name"]
                    if open_name in files:
                        raise ValueError(f"rows of {open_name} are not together")
                    files[open_name] = f"{own}-{len(files)}"
                    system, path = _place(files[open_name])
                    system.create_dir(posixpath.dirname(path), recursive=True)
                    out = system.open_output_stream(path)
                out.write(row["value"].encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        for message in messages:
            for name, staged in message.files.items() if message else ():
                system, path = _place(name)
                system.create_dir(posixpath.dirname(path), recursive=True)
                system.move(_place(staged)[1], path)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, path = _place(self.staging)
        if system.get_file_info(path).type.name != "NotFound":
            system.delete_dir(path)


def _place(uri: str):
    """The file system of a path or URI (as Spark writes them, too), and the path there."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def write_named(df: DataFrame, name: str, order: list[str], staging: str, line: Column) -> int:
    """``line`` of each row in the file that the column ``name`` holds; gives the number of rows.

    The rows of a file are written by one task, one after another, in ``order``. ``staging`` is a folder on the
    file system of the files. Files that are there are replaced; a failed run changes none of them.
    """
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    seen = Observation()
    rows = (
        df.select(F.col(name).alias("name"), line.alias("value"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
        .repartition("name")
        .sortWithinPartitions("name", *[f"_{i}" for i in range(len(order))])
        .select("name", "value")
        .observe(seen, F.count(F.lit(1)).alias("n"))
    )
    folder = posixpath.join(staging, f".prefdata-{uuid.uuid4().hex}")
    rows.write.format(FORMAT).mode("append").option("staging", folder).save()
    return seen.get["n"]
