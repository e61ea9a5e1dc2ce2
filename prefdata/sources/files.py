"""Readers: JSON lines, text files, prefixes of stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.functions.text import as_column
from prefdata.operators.ordered import first_rows

TEXT_EXTENSIONS = [".txt", ".md"]
PIECE_BYTES = 8 << 20  # of a text file that is read in pieces
OUTPUT_SUFFIX = "_sft_data.jsonl"


def read_jsonl(
    spark: SparkSession, path: str, schema: str, strict: bool = True
) -> DataFrame:
    """JSON lines with a given schema; blank lines are skipped.

    Strict: a bad line fails the job. Otherwise it becomes a row of nulls that holds the
    line in ``_corrupt_record``.
    """
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return (
        spark.read.schema(schema + ", _corrupt_record STRING")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_prefix(spark: SparkSession, path: str, n: int, key: str) -> DataFrame:
    """First ``n`` rows of a Parquet table in key order."""
    return first_rows(spark.read.parquet(path), n, [key])


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Whole text files under a folder, and the files of other kinds.

    Documents: (path, extension, output_name, text), from ``.txt`` and ``.md`` files.
    Rejects: (path, extension); their content is never read.
    """
    listed = spark.read.option("recursiveFileLookup", "true")
    rejects = (
        listed.format("binaryFile")
        .load(path)
        .select("path", extension("path").alias("extension"))
        .filter(~F.col("extension").isin(TEXT_EXTENSIONS))
    )
    file_path = F.col("_metadata.file_path")
    documents = (
        listed.option("pathGlobFilter", "*.{[tT][xX][tT],[mM][dD]}")
        .text(path, wholetext=True)
        .select(
            file_path.alias("path"),
            extension(file_path).alias("extension"),
            output_name(file_path).alias("output_name"),
            F.col("value").alias("text"),
        )
    )
    return documents, rejects


def read_lines(spark: SparkSession, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(path, piece, position, text): the lines of the text files below a folder, in pieces.

    Files are read in splits, so one of any size is many tasks. A piece is a range of a split with about
    ``piece_bytes``; its number is where it begins in its file, and a line's position its number in
    the piece. Lines end with a newline; a carriage return is part of its line.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{[tT][xX][tT],[mM][dD]}")
        .option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
            F.col("value").alias("text"),
        )
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, piece, at, position = None, 0, 0, 0
        for batch in batches:
            paths, starts = batch.column("path").to_pylist(), batch.column("start").to_pylist()
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            pieces, positions = [], []
            for place in range(len(paths)):
                if (paths[place], starts[place]) != split:
                    split = (paths[place], starts[place])
                    piece = at = starts[place]
                    position = 0
                elif at - piece >= piece_bytes:
                    piece, position = at, 0
                pieces.append(piece)
                positions.append(position)
                at, position = at + (sizes[place] or 0) + 1, position + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(pieces, pa.int64()), pa.array(positions, pa.int64()), batch.column("text")],
                names=["path", "piece", "position", "text"],
            )

    return lines.mapInArrow(number, "path string, piece long, position long, text string")


def _extension_as_written(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/.][^/]*(\.[^./]*)$", 1)


def extension(path: Column | str) -> Column:
    """Extension in lower case, with its dot; empty if there is none."""
    return F.lower(_extension_as_written(as_column(path)))


def output_name(path: Column | str) -> Column:
    """Where the rows made from a file go, unless the caller says otherwise."""
    path = as_column(path)
    stem = F.left(path, F.length(path) - F.length(_extension_as_written(path)))
    return F.concat(stem, F.lit(OUTPUT_SUFFIX))
